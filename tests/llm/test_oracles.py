import duckdb
import pytest

from trackframe.llm import queries

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_its_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    expected = con.execute(queries.oracle_sql()[name]).fetchdf()
    found = queries.queries()[name](spark, DATA).toPandas()
    columns = sorted(expected.columns)
    assert sorted(found.columns) == columns
    as_rows = lambda df: sorted(map(str, df[columns].astype(object).values.tolist()))
    assert as_rows(found) == as_rows(expected)
