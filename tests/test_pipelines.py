import numpy as np
import pyarrow.feather
import pytest
import yaml
from pyspark.sql import functions as F

from trackframe import __main__ as cli
from trackframe.functions import nested, texts
from trackframe.operators import evaluate, reconcile, sampling, select, series, trajectory
from trackframe.plans import pipelines, report
from trackframe.sources import sinks

LABELS = "video string, image string, x double, y double"


def tables(spark):
    """Three videos: a is analyzed and has labels, b is analyzed and quiet, c was never analyzed."""
    path = [("a", f, 0, "nose", 100.0 * (f in (7, 8, 9, 20)), 0.0, 0.9) for f in range(30)] + [("b", f, 0, "nose", 1.0, 1.0, 0.9) for f in range(30)]
    return {
        "videos": spark.createDataFrame([(v, i, f"/v/{v}.mp4", g) for i, (v, g) in enumerate((("a", "g1"), ("b", "g1"), ("c", "g2")))], "video string, ord long, path string, group string"),
        "predictions": spark.createDataFrame(path, "video string, frame long, individual int, bodypart string, x double, y double, likelihood double"),
        "human": spark.createDataFrame([("a", "img1.png", 1.0, 2.0), ("c", "img5.png", float("nan"), None)], LABELS),
        "machine": spark.createDataFrame([("a", 0, "img1.png"), ("a", 0, "img2.png"), ("a", 1, "img3.png")], "video string, iteration int, image string"),
        "refined": spark.createDataFrame([("a", "img2.png", None, None)], LABELS),
        "disk": spark.createDataFrame([("a", "img1.png"), ("a", "img2.png"), ("a", "img3.png"), ("c", "img5.png"), ("c", "img6.png")], "video string, image string"),
        "counts": spark.createDataFrame([(v, 30) for v in "abc"], "video string, frame_count long"),
    }


@pytest.fixture
def project(spark):
    return pipelines.Project(**tables(spark))


def pairs(df):
    return sorted(tuple(r) for r in df.collect())


def test_outliers_end_to_end(project):
    run = pipelines.extract_outliers(project, frames_per_video=2)
    assert pairs(run.frames) == [("a", 7), ("a", 21)] and run.cleared.count() == 0  # 7, 10, 20 and 21 jump
    assert pairs(run.outcomes) == [("a", "ok", 2), ("b", "error", 0), ("c", "not_analyzed", 0)]
    assert run.summary().describe() == "2 frames of 1 videos; 1 not analyzed, 1 failed"
    assert report.failure_lines(run.outcomes.collect()) == ["b: error", "c: not analyzed"]
    assert pairs(pipelines.extract_outliers(project, overwrite=True).cleared) == [("a", "img2.png")]  # img1 has a human label


def test_outliers_by_request_and_mode(spark, project):
    only_b = spark.createDataFrame([("/v/./b.mp4",), ("/v/zzz.mp4",)], "path string")
    assert pairs(pipelines.extract_outliers(project, only_b, "list", frames=[3, 4]).frames) == [("b", 3), ("b", 4)]
    assert pipelines.extract_outliers(project, only_b, overwrite=True).cleared.count() == 0
    assert pairs(pipelines.extract_outliers(project, only_b, reset=True).cleared) == [("a", "img2.png")]
    for bad in ({"overwrite": True, "reset": True}, {"selector": "kmeans"}, {"algorithm": "nope"}, {"bodyparts": ("tail",)}, {"frames_per_video": 0}):
        with pytest.raises(ValueError):
            pipelines.extract_outliers(project, **bad)
    for path in ("/v/zzz.mp4", "/v/c.mp4"):
        with pytest.raises(ValueError):
            pipelines.extract_outliers(project, spark.createDataFrame([(path,)], "path string"))


def test_frames_end_to_end(spark, project):
    run = pipelines.extract_frames(project, ceiling=4)
    assert {v: sum(1 for r in run.frames.collect() if r.video == v) for v in "abc"} == {"a": 0, "b": 4, "c": 2}  # a is in refinement
    assert pairs(run.outcomes) == [("b", "ok", 4), ("c", "ok", 2)] and run.cleared.count() == 0
    again = pipelines.extract_frames(project, ceiling=4, overwrite=True)
    assert pairs(again.cleared) == [("c", "img5.png"), ("c", "img6.png")] and pairs(again.outcomes) == [("b", "ok", 4), ("c", "ok", 4)]
    assert pairs(pipelines.extract_frames(project, ceiling=4, budget=5).outcomes) == [("b", "ok", 4)]
    c = spark.createDataFrame([("/v/c.mp4",)], "path string")
    assert pairs(pipelines.extract_frames(project, c, ceiling=4, budget=3, balanced=True).outcomes) == [("c", "ok", 2)]
    assert pairs(pipelines.extract_frames(project, c, ceiling=4, exclusive=True).outcomes) == [("c", "ok", 2)]
    with pytest.raises(ValueError, match="budget of 900"):
        pipelines.extract_frames(project, ceiling=4, budget=900)
    with pytest.raises(ValueError, match="in refinement"):
        pipelines.extract_frames(project, spark.createDataFrame([("/v/a.mp4",)], "path string"), overwrite=True)


def test_command_line(spark, tmp_path, capsys):
    for name, df in tables(spark).items():
        df.write.parquet(str(tmp_path / "p" / name))
    folder = str(tmp_path / "p")
    assert cli.main(["outliers", folder, "--count", "2", "--out", str(tmp_path / "o")]) == 1  # b yields none
    assert pairs(spark.read.parquet(str(tmp_path / "o"))) == [("a", 7), ("a", 21)]
    assert cli.main(["frames", folder, "--count", "4", "--budget", "5"]) == 0
    assert cli.main(["pending", folder, "--iteration", "0"]) == 0 and cli.main(["purge", folder]) == 0
    out = capsys.readouterr().out
    assert "4 frames of 1 videos" in out and "a: 1" in out and "would delete 5" in out
    assert cli.main(["outliers", folder, "--overwrite", "--reset"]) == 1 and cli.main(["outliers"]) == 2


def test_uniform_counts_agree_with_one_count(spark):
    pool = spark.createDataFrame([(v, f) for v, n in (("a", 17), ("b", 3), ("c", 40)) for f in range(0, 3 * n, 3)], "video string, frame long")
    for k in (1, 2, 5, 17):
        own = spark.createDataFrame([(v, k) for v in "abc"], "video string, picks long")
        assert pairs(select.uniform_counts(pool, own)) == pairs(select.uniform_selection(pool, k))


def test_unlikely_far_positions_are_flagged(spark):
    t = np.arange(120)
    x = 50 + 20 * np.sin(t / 6)
    x[60] += 500
    rows = [("v", int(i), 0, "nose", float(v), float(v), 0.001 if i == 60 else 0.9) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "video string, frame long, individual int, bodypart string, x double, y double, likelihood double")
    for found in (trajectory.arma_deviation(df, 3, 1), trajectory.ar1_deviation(df)):
        assert found.where("deviation is not null and not isnan(deviation)").orderBy(F.col("deviation").desc()).first().frame == 60
    assert 60 in [r.frame for r in trajectory.fitting_outliers(df, 1, 60.0).collect()]


def test_fit_against_plain_least_squares():
    rng = np.random.default_rng(2)
    x = np.zeros(4000)
    for t in range(2, len(x)):
        x[t] = 0.6 * x[t - 1] + 0.25 * x[t - 2] + rng.normal()
    x += 30
    own = trajectory.arma_residuals(x, np.ones(len(x), dtype=bool), 2, 0)
    y = x - x.mean()
    a = np.linalg.lstsq(np.c_[y[1:-1], y[:-2]], y[2:], rcond=None)[0]
    assert np.allclose(a, (0.6, 0.25), atol=0.05)
    assert np.corrcoef(own[10:], (y[2:] - np.c_[y[1:-1], y[:-2]] @ a)[8:])[0, 1] > 0.999 and abs(own[10:].std() - 1) < 0.05


def test_errors_name_what_clashes(spark):
    videos = spark.createDataFrame([("/x/a.mp4",), ("/y/a.avi",), ("/y/a.avi",)], "path string")
    with pytest.raises(ValueError, match="/x/a.mp4 and /y/a.avi"):
        reconcile.require_unique_stems(videos)
    rows = spark.createDataFrame([("v", 0, "nose")], "video string, frame long, bodypart string")
    with pytest.raises(ValueError, match="'tail'"):
        series.bodypart_projection(rows, ["tail"])
    assert series.bodypart_projection(rows.limit(0), ["tail"]).count() == 0


def test_evaluation_is_written_with_its_note(spark, tmp_path):
    tidy = spark.createDataFrame([("test", "v", "i1", "0", "nose", 1.0, 2.0, 0.9, 1.5, 2.0, 0.5, True, True)], "split string, video string, image string, individual string, bodypart string, pred_x double, pred_y double, pred_likelihood double, gt_x double, gt_y double, error_px double, above_pcutoff boolean, matched boolean")
    splits = [{"split": s, "images": 3, "rmse_px": v, "rmse_px_above": None, "map": 71.2349, "mar": 80.0} for s, v in (("train", 1.00049), ("test", 2.5))]
    record = sinks.evaluation_record(splits, [{"bodypart": "nose", "rmse_px": 3.14159}], shuffle=1)
    assert record["metrics"]["train"] == {"images": 3, "rmse_px": 1.0, "rmse_px_above": None, "map": 71.23, "mar": 80.0}
    assert record["generalization_gap_px"] == 1.5 and record["worst_keypoints"] == [{"bodypart": "nose", "rmse_px": 3.142}]
    table, note = sinks.write_evaluation(tidy, str(tmp_path), "snap", record)
    found = pyarrow.feather.read_table(table)
    assert found.schema.equals(sinks.EVALUATION_SCHEMA) and found.to_pylist()[0]["error_px"] == 0.5 and found.to_pylist()[0]["snapshot"] == "snap"
    assert yaml.safe_load(open(note)) == record | {"feather": "snap_evaluation.feather"}
    with pytest.raises(yaml.YAMLError):
        sinks.write_evaluation(tidy, str(tmp_path / "bad"), "snap", {"x": object()})
    assert not list((tmp_path / "bad").iterdir())


def test_labels_have_a_twin(spark, tmp_path):
    rows = spark.createDataFrame([("v", f"img{i}.png", float(i), 0.0) for i in range(4)], LABELS)
    path = str(tmp_path / "labels")
    assert sinks.rewrite_labels(rows, path) == 4 and spark.read.option("header", True).csv(f"{path}.csv").count() == 4
    assert sinks.rewrite_labels(spark.read.parquet(path).where("x > 1"), path) == 2 and spark.read.option("header", True).csv(f"{path}.csv").count() == 2
    assert sinks.rewrite_labels(spark.read.parquet(path).where("false"), path) == 0 and not any(tmp_path.iterdir())


def test_prediction_tables(spark, tmp_path):
    rows = spark.createDataFrame([(v, f, 1.0) for v in "ab" for f in range(3)], "video string, frame long, x double")
    about = spark.createDataFrame([("a", False), ("b", True)], "video string, cropped boolean")
    path = str(tmp_path / "p")
    sinks.write_prediction_tables(rows, about, path)
    sinks.write_prediction_tables(rows.where("video = 'b'"), about.where("video = 'b'").withColumn("cropped", F.lit(False)), path)
    assert spark.read.parquet(f"{path}/predictions").count() == 9
    assert pairs(spark.read.parquet(f"{path}/metadata")) == [("a", False), ("b", False)]


def test_purge_stays_below_the_labels(spark, tmp_path):
    top = tmp_path / "labeled-data"
    for name in ("a", "b", "c"):
        (top / name).mkdir(parents=True)
    (top / "a" / "img1.png").write_text("x")
    (tmp_path / "other").mkdir()
    (top / "link").symlink_to(tmp_path / "other")
    for bad in (tmp_path / "other", top, top / "link", top / ".." / "other"):
        with pytest.raises(ValueError):
            sinks.purge(spark, [str(top / "b"), str(bad)], execute=True, below=str(top))
    assert (top / "b").exists()
    assert sinks.purge(spark, [str(top / "b")], execute=True, below=str(top)) and not (top / "b").exists()
    assert [p.rsplit("/", 1)[1] for p in sinks.prune_empty(spark, str(top))][:1] == ["c"] and (top / "a").exists()


def test_nested_values(spark):
    row = spark.range(1).select(
        nested.ragged_slices(F.array(*map(F.lit, range(6))), F.array(*map(F.lit, (2, 0, 3, 4)))).alias("r"),
        nested.heads_by_frame(pose=F.array(F.lit(1), F.lit(2)), score=F.array(F.lit(0.5))).alias("h"),
        nested.plane_mean(F.array(F.array(F.lit(1.0), F.lit(3.0)), F.array(F.lit(5.0), F.lit(7.0)))).alias("m"),
        nested.stacked_planes(F.array(F.array(F.lit(1)), F.array(F.lit(2)))).alias("s"),
        nested.nested(F.create_map(F.lit("a"), F.create_map(F.lit("b"), F.lit(4))), "a", "c", default=9).alias("d"),
    ).first()
    assert row.r == [[0, 1], [], [2, 3, 4], [5]] and [tuple(x) for x in row.h] == [(1, 0.5), (2, None)] and row.m == [3.0, 5.0] and row.s == [1, 2] and row.d == 9


def test_lines_across_chunks(spark):
    chunks = spark.createDataFrame([("k", 0, "ab"), ("k", 1, "c\nd"), ("k", 2, "\n\nx"), ("m", 0, "one\n")], "key string, seq long, value string")
    assert pairs(texts.joined_lines(chunks)) == [("k", 0, "abc"), ("k", 1, "d"), ("k", 2, ""), ("k", 3, "x"), ("m", 0, "one")]


def test_reports_are_ordered(spark):
    coverage = spark.createDataFrame([("b", 1, 2, 9, 3), ("a", 4, 2, 8, 3), ("z", 0, 5, 5, 5)], "group string, existing long, added long, projected long, available long")
    assert [r.group for r in sampling.coverage_report(coverage).collect()] == ["z", "a", "b"]
    assert report.plan_lines([r.asDict() for r in coverage.collect()], 9, 17) == ["17 frames of 9 videos", "z: 0 + 5 frames, 5 videos", "a: 4 + 4 frames, 2 videos", "b: 1 + 8 frames, 2 videos"]
    snapshots = spark.createDataFrame([(10, "p10", False), (20, "p20", True), (30, "p30", False)], "epoch long, path string, best boolean")
    assert [evaluate.chosen_snapshot(snapshots, i).first().path for i in ("best", -1, 0)] == ["p20", "p30", "p10"] and evaluate.chosen_snapshot(snapshots, 7).count() == 0
    outputs = spark.createDataFrame([("w", "w.h5"), ("v", "v.h5")], "stem string, output string")
    assert [r.stem for r in reconcile.ordered_outputs(spark.createDataFrame([(0, "v"), (1, "w")], "ord long, stem string"), outputs).collect()] == ["v", "w"]
