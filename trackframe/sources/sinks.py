"""Writers. None overwrites a path that its own plan reads: tables are written beside the old ones and swapped in."""

from __future__ import annotations

import json
import os
import uuid
from dataclasses import asdict, is_dataclass

import pyarrow as pa
import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The columns of an evaluation table, in order. Fixed values.
EVALUATION_SCHEMA = pa.schema(
    [("snapshot", pa.string()), ("split", pa.string()), ("video", pa.string()), ("image", pa.string()), ("individual", pa.string()), ("bodypart", pa.string())]
    + [(c, pa.float64()) for c in ("pred_x", "pred_y", "pred_likelihood", "gt_x", "gt_y", "error_px")]
    + [("above_pcutoff", pa.bool_()), ("matched", pa.bool_())]
)


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def write_predictions(df: DataFrame, path: str, mode: str = "append") -> None:
    """Partitioned by video and sorted by frame within. Mode 'overwrite' replaces only the videos that `df` has, 'reset' all."""
    writer = df.repartition("video").sortWithinPartitions("video", "frame").write.partitionBy("video")
    if mode == "overwrite":
        writer.option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)
    else:
        writer.mode({"append": "append", "reset": "overwrite"}[mode]).parquet(path)


def swap_table(df: DataFrame, path: str) -> int:
    """Replaces the table at `path`, which `df` may read, by `df`; an empty one is deleted. Returns the rows. The old table is moved
    aside until the new one is in its place, so a crash leaves one of the two."""
    spark = df.sparkSession
    new = f"{path.rstrip('/')}-{uuid.uuid4().hex}"
    df.write.parquet(new)
    rows = spark.read.schema(df.schema).parquet(new).count()
    fs, old = _fs(spark, path)
    target, aside = _fs(spark, new)[1], _fs(spark, f"{new}-old")[1]
    if fs.exists(old):
        fs.rename(old, aside)
    if rows:
        fs.rename(target, old)
    else:
        fs.delete(target, True)
    fs.delete(aside, True)
    return rows


def rewrite_labels(labels: DataFrame, path: str) -> int:
    """Replaces a label table and its CSV twin at `path`.csv; both go when no row is left. Returns the rows."""
    rows = swap_table(labels, path)
    spark = labels.sparkSession
    fs, twin = _fs(spark, f"{path.rstrip('/')}.csv")
    if rows:
        spark.read.parquet(path).write.mode("overwrite").option("header", True).csv(f"{path.rstrip('/')}.csv")
    else:
        fs.delete(twin, True)
    return rows


def write_prediction_tables(predictions: DataFrame, metadata: DataFrame, path: str, mode: str = "append") -> None:
    """The prediction table with a CSV twin and the metadata (video, ...) of its videos, under one folder. Videos that `predictions`
    has are replaced in the metadata."""
    spark = predictions.sparkSession
    write_predictions(predictions, f"{path}/predictions", mode)
    predictions.write.mode("append" if mode == "append" else "overwrite").option("header", True).csv(f"{path}/csv")
    fs, old = _fs(spark, f"{path}/metadata")
    known = spark.read.parquet(f"{path}/metadata").join(metadata.select("video"), "video", "left_anti") if fs.exists(old) and mode != "reset" else None
    swap_table(metadata if known is None else known.unionByName(metadata), f"{path}/metadata")


def evaluation_record(splits: list[dict], worst: list[dict], **about) -> dict:
    """What is noted beside an evaluation: metrics by split (errors to 3 digits, precision and recall to 2), the gap of test over train
    and the worst keypoints."""
    digits = {"rmse_px": 3, "rmse_px_above": 3, "map": 2, "mar": 2}
    metrics = {m["split"]: {k: round(v, digits[k]) if k in digits and v is not None else v for k, v in m.items() if k != "split"} for m in splits}
    raw = {m["split"]: m.get("rmse_px") for m in splits}
    gap = round(raw["test"] - raw["train"], 3) if raw.get("test") is not None and raw.get("train") is not None else None
    return about | {"metrics": metrics, "generalization_gap_px": gap, "worst_keypoints": [{"bodypart": w["bodypart"], "rmse_px": round(w["rmse_px"], 3)} for w in worst]}


def write_evaluation(tidy: DataFrame, folder: str, snapshot: str, record: dict) -> tuple[str, str]:
    """<snapshot>_evaluation.feather with the fixed schema and its YAML beside it, both or neither; the rows of one evaluation, which are
    written as they stream from the cluster, a partition at a time."""
    os.makedirs(folder, exist_ok=True)
    table, note = (os.path.join(folder, f"{snapshot}_evaluation.{end}") for end in ("feather", "yaml"))
    rows = tidy.select(F.lit(snapshot).alias("snapshot"), *(F.col(f.name).cast("string" if pa.types.is_string(f.type) else "boolean" if pa.types.is_boolean(f.type) else "double") for f in EVALUATION_SCHEMA if f.name != "snapshot"))
    try:
        with pa.OSFile(table, "wb") as file, pa.ipc.new_file(file, EVALUATION_SCHEMA) as writer:
            part: list[dict] = []
            for row in rows.toLocalIterator():
                part.append(row.asDict())
                if len(part) == 10_000:
                    writer.write_batch(pa.RecordBatch.from_pylist(part, EVALUATION_SCHEMA))
                    part = []
            writer.write_batch(pa.RecordBatch.from_pylist(part, EVALUATION_SCHEMA))
        with open(note, "w") as file:
            yaml.safe_dump(record | {"feather": os.path.basename(table)}, file, sort_keys=False)
    except Exception:
        for path in (table, note):
            if os.path.exists(path):
                os.remove(path)
        raise
    return table, note


def write_with_provenance(df: DataFrame, path: str, provenance) -> None:
    """A table and a one-row JSON beside it, both or neither."""
    spark = df.sparkSession
    record = asdict(provenance) if is_dataclass(provenance) else dict(provenance)
    df.write.mode("errorifexists").parquet(path)
    try:
        spark.createDataFrame([(json.dumps(record, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path.rstrip('/')}.provenance")
    except Exception:
        fs, p = _fs(spark, path)
        fs.delete(p, True)
        raise


def purge(spark: SparkSession, directories: list[str], execute: bool = False, below: str | None = None) -> list[str]:
    """What a purge deletes; it does so only with `execute`. Every directory must lie below `below`, the project's folder of labels, and
    be no link; otherwise nothing is deleted at all."""
    for d in directories:
        fs, p = _fs(spark, d)
        local = d.removeprefix("file:")
        if below is not None:
            top = os.path.normpath(below.removeprefix("file:"))
            if os.path.commonpath([top, os.path.normpath(local)]) != top or os.path.normpath(local) == top:
                raise ValueError(f"{d} is not below {below}")
        if os.path.islink(local):
            raise ValueError(f"{d} is a link")
    if execute:
        for d in directories:
            fs, p = _fs(spark, d)
            fs.delete(p, True)
    return sorted(directories)


def prune_empty(spark: SparkSession, folder: str) -> list[str]:
    """Removes the empty directories right below `folder`; returns their paths."""
    fs, top = _fs(spark, folder)
    found = [s.getPath() for s in fs.listStatus(top) if s.isDirectory()] if fs.exists(top) else []
    gone = [p for p in found if not len(fs.listStatus(p))]
    for p in gone:
        fs.delete(p, False)
    return sorted(p.toUri().getPath() for p in gone)


def append_metrics(df: DataFrame, path: str) -> None:
    df.write.mode("append").option("header", True).csv(path)
