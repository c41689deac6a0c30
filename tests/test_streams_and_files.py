import pytest
from pyspark.sql import functions as F

from trackframe import __main__ as cli
from trackframe.operators import progress as batch
from trackframe.plans.report import OutlierSummary, PurgeSummary, SplitMetrics, describe_gap
from trackframe.sources import config, readers, sinks
from trackframe.streaming import progress as streaming

MSG = "seq long, key long, kind string, count long"


def messages(spark):
    rows = [(i, i % 7, "done" if i % 40 == 0 else "progress", i * 3 % 101) for i in range(1, 300)]
    return spark.createDataFrame(rows, MSG)


def test_streaming_counts_equal_batch(spark, tmp_path):
    rows = messages(spark)
    rows.repartition(5).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(MSG).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    streaming.run_to_memory(streaming.latest_counts_stream(stream), "latest")
    assert sorted(map(tuple, spark.table("latest").collect())) == sorted(map(tuple, batch.latest_counts(rows).collect()))


def test_streaming_merge_and_filter(spark, tmp_path):
    rows = spark.createDataFrame([(1, 0, "loss", 3.0), (2, 0, "loss", 2.0), (3, 1, "loss", 1.0)], "seq long, epoch long, name string, value double")
    rows.write.parquet(str(tmp_path / "m"))
    streaming.run_to_memory(streaming.epoch_merge_stream(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "m"))), "merged")
    assert sorted(map(tuple, spark.table("merged").collect())) == sorted(map(tuple, batch.epoch_merge(rows).collect()))
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "a.txt").write_text("keep\nnotice: drop\nkeep too\n")
    streaming.run_to_memory(streaming.filtered_lines(spark.readStream.text(str(tmp_path / "t")), "notice:"), "lines", "append")
    assert sorted(r.value for r in spark.table("lines").collect()) == ["keep", "keep too"]


def test_streaming_stalls(spark, tmp_path):
    rows = spark.sql("SELECT * FROM VALUES (1L, 1L, timestamp_ntz'2024-01-01 00:00:00'), (2L, 1L, timestamp_ntz'2024-01-01 00:30:00'), (3L, 2L, timestamp_ntz'2024-01-01 00:31:00') AS t(seq, key, ts)")
    rows.coalesce(1).write.parquet(str(tmp_path / "s"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "s"))
    streaming.run_to_memory(streaming.stalls_stream(stream, 1200), "stalls", "append")
    found = [r for r in spark.table("stalls").collect() if r.silence is not None]
    assert [(r.key, r.silence) for r in found] == [(1, 1800.0)]


def test_windows_over_event_time(spark, tmp_path):
    rows = spark.sql("SELECT * FROM VALUES (1L, 1L, timestamp_ntz'2024-01-01 00:01:00'), (2L, 1L, timestamp_ntz'2024-01-01 00:02:00'), (3L, 1L, timestamp_ntz'2024-01-01 00:12:00') AS t(seq, key, ts)")
    rows.write.parquet(str(tmp_path / "w"))
    streaming.run_to_memory(streaming.windowed_counts(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "w"))), "windows")
    assert sorted(r.n for r in spark.table("windows").collect()) == [1, 2]


YAML = """scorer: me
iteration: 2
start: 0.1
numframes2pick: 20
cropping: true
x1: 0
x2: 64
y1: 0
y2: 48
TrainingFraction: [0.95]
video_sets:
  /d/b.mp4: {crop: "0, 640, 0, 480"}
  /d/a.mp4: {}
"""


def test_config(spark, tmp_path):
    path = tmp_path / "config.yaml"
    path.write_text(YAML)
    found = config.load_config(str(path), frames_per_video=5)
    assert (found.scorer, found.iteration, found.start, found.stop, found.frames_per_video, found.crop, found.cutoff) == ("me", 2, 0.1, 1.0, 5, (0, 64, 0, 48), 0.6)
    assert [tuple(r) for r in found.videos_frame(spark).orderBy("ord").collect()] == [(0, "/d/b.mp4", "0, 640, 0, 480"), (1, "/d/a.mp4", None)]
    assert config.load_config(str(path)).frames_per_video == 5 and found.project_path == str(tmp_path)
    with pytest.raises(ValueError):
        config.load_config(str(path), frames_per_video=0)
    for bad in ({"overwrite": True, "reset": True}, {"exclusive": True}, {"exclusive": True, "videos": ("a",), "reset": True}, {"budget": 0}, {"stride": 0}):
        with pytest.raises(ValueError):
            config.check_arguments(**bad)
    config.check_arguments(exclusive=True, videos=("a",), budget=5)


def test_listings(spark, tmp_path):
    (tmp_path / "labeled-data" / "v").mkdir(parents=True)
    for name in ("img1.png", "img2.png", "img1labeled.png", "x.png"):
        (tmp_path / "labeled-data" / "v" / name).write_bytes(b"1")
    for name in ("b.MP4", "a.avi", "c_labeled.mp4", "t.txt"):
        (tmp_path / name).write_bytes(b"1")
    assert [r.name for r in readers.directory_videos(spark, str(tmp_path)).collect()] == ["a.avi", "b.MP4"]
    assert sorted(map(tuple, readers.extracted_frames(spark, str(tmp_path / "labeled-data")).collect())) == [("v", "img1.png"), ("v", "img2.png")]
    (tmp_path / "log").write_text("\n".join(map(str, range(30))))
    assert readers.file_tail(spark, str(tmp_path / "log"), 2) == ["28", "29"]


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([(v, f, float(f)) for v in (1, 2) for f in range(4)], "video long, frame long, x double")
    path = str(tmp_path / "p")
    sinks.write_predictions(rows, path)
    sinks.write_predictions(rows.where("video = 1 and frame = 0"), path, "overwrite")
    assert spark.read.parquet(path).groupBy("video").count().orderBy("video").collect()[0]["count"] == 1
    assert spark.read.parquet(path).count() == 5
    sinks.write_predictions(rows, path)
    assert spark.read.parquet(path).count() == 13
    sinks.write_predictions(rows, path, "reset")
    assert spark.read.parquet(path).count() == 8
    table = str(tmp_path / "t")
    rows.write.parquet(table)
    assert sinks.swap_table(spark.read.parquet(table).where("frame > 1"), table) == 4 and spark.read.parquet(table).count() == 4
    assert sinks.swap_table(spark.read.parquet(table).where("false"), table) == 0 and not (tmp_path / "t").exists()
    sinks.write_with_provenance(rows, str(tmp_path / "e"), SplitMetrics("test", 2, 1.5, 1.0))
    assert "rmse_px" in spark.read.text(str(tmp_path / "e.provenance")).first().value
    assert sinks.purge(spark, [str(tmp_path / "e")]) and (tmp_path / "e").exists()
    sinks.purge(spark, [str(tmp_path / "e")], execute=True)
    assert not (tmp_path / "e").exists()
    sinks.append_metrics(rows.limit(2).select(F.col("frame")), str(tmp_path / "m"))
    assert spark.read.option("header", True).csv(str(tmp_path / "m")).count() == 2


def test_summaries_and_command_line(spark, tmp_path, capsys):
    assert OutlierSummary(3, 1, 0, 1200).describe() == "1,200 frames of 3 videos; 1 not analyzed, 0 failed" and OutlierSummary(0, 0, 1, 0).successful is False
    assert PurgeSummary(2, 1, 10, False).describe().startswith("would delete 10")
    assert describe_gap(SplitMetrics("train", 1, 3.0, 3.0), SplitMetrics("test", 1, 5.0, 5.0)) == "gap +2.00 px"
    assert cli.main(["query", "image_name", "/root/testdata/sf0.001", "--out", str(tmp_path / "o")]) == 0 and spark.read.parquet(str(tmp_path / "o")).count() > 0
    assert cli.main(["query", "no_such_query", "/x"]) == 2
    assert cli.main(["query", "image_name", "/no/such/folder"]) == 1
