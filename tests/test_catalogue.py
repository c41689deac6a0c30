import duckdb
import pytest

from trackframe.plans import catalogue

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def as_rows(df, columns):
    cells = df[columns].astype(object)
    return sorted(str([None if v is None or v != v else float(v) if isinstance(v, float) else v for v in row]) for row in cells.values.tolist())


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query_matches_its_oracle(spark, oracle, name):
    expected = oracle.execute(catalogue.oracle_sql()[name]).fetchdf()
    found = catalogue.queries()[name](spark, DATA).toPandas()
    columns = sorted(expected.columns)
    assert sorted(found.columns) == columns
    assert as_rows(found, columns) == as_rows(expected, columns)


@pytest.mark.parametrize("name", sorted(set(catalogue.queries()) - set(catalogue.oracle_sql())))
def test_query_without_oracle_repeats_itself(spark, name):
    a, b = (catalogue.queries()[name](spark, DATA).toPandas() for _ in range(2))
    assert len(a) > 0 and as_rows(a, list(a.columns)) == as_rows(b, list(a.columns))


def test_entry_points(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns == ["video", "n"]
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_jump_detection_needs_one_exchange(spark):
    from trackframe.operators.detect import jump_outliers

    rows = spark.createDataFrame([(1, 0, 0, "a", 1.0, 1.0, 0.9)], "video long, frame long, individual int, bodypart string, x double, y double, likelihood double")
    plan = jump_outliers(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_filters_reach_the_scan(spark, tmp_path):
    from trackframe.sources import readers, sinks

    rows = spark.createDataFrame([(v, f, float(f)) for v in (1, 2) for f in range(10)], "video long, frame long, x double")
    sinks.write_predictions(rows, str(tmp_path / "p"))
    found = readers.frame_range(readers.predictions(spark, str(tmp_path / "p")), 1, 2, 5)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(video" in plan and "GreaterThanOrEqual(frame,2)" in plan and found.count() == 3
