"""Views of the driver's tables as prediction, label and message tables, in Spark and as SQL for the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multi-animal predictions: two individuals with two bodyparts a frame."""
    rn = F.row_number().over(W.partitionBy("user_id").orderBy("ts", "event_id")) - 1
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value", "props").withColumn("rn", rn)
    return e.select(
        F.col("user_id").alias("video"), F.floor(F.col("rn") / 4).cast("long").alias("frame"), F.floor(F.col("rn") % 4 / 2).cast("int").alias("individual"),
        F.concat(F.lit("bp"), (F.col("rn") % 2).cast("string")).alias("bodypart"), F.col("value").alias("x"), F.get_json_object("props", "$.k").cast("double").alias("y"),
        ((F.col("event_id") * 37 % 100).cast("double") / F.lit(100.0)).alias("likelihood"), "event_id",
    )


def pred1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Single-animal predictions with one keypoint: a row a frame."""
    rn = F.row_number().over(W.partitionBy("user_id").orderBy("ts", "event_id")) - 1
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("video"), rn.cast("long").alias("frame"), F.lit(0).alias("individual"), F.lit("nose").alias("bodypart"), F.col("value").alias("x"),
        F.get_json_object("props", "$.k").cast("double").alias("y"), ((F.col("event_id") * 37 % 100).cast("double") / F.lit(100.0)).alias("likelihood"), "event_id",
    )


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = pred(spark, sf_dir)
    return p.select(
        "*", F.concat_ws("/", F.col("video").cast("string"), F.col("frame").cast("string")).alias("image"), (F.col("x") + F.col("event_id") % 7 - 3).alias("gt_x"),
        (F.col("y") + F.col("event_id") % 3 - 1).alias("gt_y"), F.when(F.col("event_id") % 5 == 0, 0).otherwise(2).alias("v"),
        F.when(F.col("video") % 5 == 0, "test").otherwise("train").alias("split"),
    )


def disk_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("source").alias("video"), F.col("doc_id").alias("image"))


def machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").where("doc_id % 3 <> 0")
    return d.select(F.col("source").alias("video"), (F.col("doc_id") % 2).cast("int").alias("iteration"), F.col("doc_id").alias("image"))


def human(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coordinates from two marks of which 0 stands for missing."""
    rows = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id")
    return rows.select(F.col("source").alias("video"), F.col("doc_id").alias("image"), F.nullif(F.col("quality"), F.lit(0)).cast("double").alias("x"), F.nullif(F.col("toxic"), F.lit(0)).cast("double").alias("y"))


def videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths by several naming conventions, with frames held, a ceiling of 20 and a few pins."""
    o = table(spark, sf_dir, "orders")
    m = F.format_string("M%02d", F.col("o_custkey") % 20)
    day, flat = F.date_format("o_orderdate", "yyyy-MM-dd"), F.date_format("o_orderdate", "yyyyMMdd")
    names = [
        F.concat(m, F.lit("_"), day), F.concat(day, F.lit("_"), m), F.concat(m, F.lit("_"), flat, F.lit("T093000")),
        F.concat(F.lit("15Jan"), F.substring(flat, 1, 4), F.lit("_"), m), F.concat(m, F.lit("_Jan_"), F.substring(flat, 1, 4)), F.concat(m, F.lit("_run1")),
    ]
    name = names[5]
    for i in range(5):
        name = F.when(F.col("o_orderkey") % 6 == i, names[i]).otherwise(name)
    directory = F.concat(F.lit("/data/d"), (F.col("o_orderkey") % 3).cast("string"))
    return o.select(
        F.col("o_orderkey").alias("ord"), directory.alias("directory"), F.concat(directory, F.lit("/"), name, F.lit(".mp4")).alias("path"), (F.col("o_custkey") % 21).alias("existing"),
        (F.col("o_orderkey") % 97 == 0).alias("pinned"),
    )


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampling candidates: an order is a video, its customer's number modulo 20 the group."""
    v = table(spark, sf_dir, "orders")
    return v.select(
        F.col("o_orderkey").alias("video"), F.col("o_orderkey").alias("ord"), F.concat(F.lit("g"), F.lpad((F.col("o_custkey") % 20).cast("string"), 2, "0")).alias("group"),
        (F.col("o_custkey") % 21).alias("existing"), (F.col("o_orderkey") % 97 == 0).alias("pinned"),
    )


def thumbs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("label").alias("video"), F.col("vec_id").alias("frame"), F.col("embedding").cast("array<double>").alias("features"))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(F.col("event_id").alias("seq"), "ts", F.col("user_id").alias("key"), F.when(F.col("event_id") % 50 == 0, "done").otherwise("progress").alias("kind"), F.floor("value").cast("long").alias("count"))


SQL = {
    "e": "SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS rn FROM events",
    "pred": """SELECT user_id AS video, rn // 4 AS frame, CAST((rn % 4) // 2 AS INTEGER) AS individual, 'bp' || (rn % 2) AS bodypart, value AS x,
      CAST(json_extract_string(props, '$.k') AS DOUBLE) AS y, CAST(event_id * 37 % 100 AS DOUBLE) / 100.0::DOUBLE AS likelihood, event_id FROM e""",
    "pred1": """SELECT user_id AS video, rn AS frame, 0 AS individual, 'nose' AS bodypart, value AS x, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS y,
      CAST(event_id * 37 % 100 AS DOUBLE) / 100.0::DOUBLE AS likelihood, event_id FROM e""",
    "truth": """SELECT *, video || '/' || frame AS image, x + event_id % 7 - 3 AS gt_x, y + event_id % 3 - 1 AS gt_y, CASE WHEN event_id % 5 = 0 THEN 0 ELSE 2 END AS v,
      CASE WHEN video % 5 = 0 THEN 'test' ELSE 'train' END AS split FROM pred""",
    "tidy": """SELECT split, video, image, individual, bodypart, x AS pred_x, y AS pred_y, likelihood AS pred_likelihood, CASE WHEN v > 0 THEN gt_x END AS gt_x, CASE WHEN v > 0 THEN gt_y END AS gt_y,
      CASE WHEN v > 0 THEN sqrt((x - gt_x) * (x - gt_x) + (y - gt_y) * (y - gt_y)) END AS error_px, likelihood >= 0.6::DOUBLE AS above_pcutoff, v > 0 AS matched FROM truth""",
    "disk_frames": "SELECT source AS video, doc_id AS image FROM documents",
    "machine": "SELECT source AS video, CAST(doc_id % 2 AS INTEGER) AS iteration, doc_id AS image FROM documents WHERE doc_id % 3 <> 0",
    "human": "SELECT source AS video, doc_id AS image, nullif(quality, 0) AS x, nullif(toxic, 0) AS y FROM labels JOIN documents USING (doc_id)",
    "finite": "SELECT DISTINCT video, image FROM human WHERE x IS NOT NULL OR y IS NOT NULL",
    "videos": """SELECT o_orderkey AS ord, '/data/d' || (o_orderkey % 3) AS directory, '/data/d' || (o_orderkey % 3) || '/' || CASE o_orderkey % 6
        WHEN 0 THEN m || '_' || strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d') || '_' || m
        WHEN 2 THEN m || '_' || strftime(o_orderdate, '%Y%m%d') || 'T093000' WHEN 3 THEN '15Jan' || strftime(o_orderdate, '%Y') || '_' || m
        WHEN 4 THEN m || '_Jan_' || strftime(o_orderdate, '%Y') ELSE m || '_run1' END || '.mp4' AS path, o_custkey % 21 AS existing, o_orderkey % 97 = 0 AS pinned
      FROM (SELECT *, 'M' || lpad(CAST(o_custkey % 20 AS VARCHAR), 2, '0') AS m FROM orders)""",
    "candidates": """SELECT o_orderkey AS video, o_orderkey AS ord, 'g' || lpad(CAST(o_custkey % 20 AS VARCHAR), 2, '0') AS "group", o_custkey % 21 AS existing, o_orderkey % 97 = 0 AS pinned,
      greatest(0, 20 - o_custkey % 21) AS cap FROM orders""",
    "counts": "SELECT video, count(DISTINCT frame) AS frame_count FROM pred GROUP BY video",
    "msgs": "SELECT event_id AS seq, ts, user_id AS key, CASE WHEN event_id % 50 = 0 THEN 'done' ELSE 'progress' END AS kind, CAST(floor(value) AS BIGINT) AS count FROM events",
    "outliers": """SELECT DISTINCT video, frame FROM (SELECT video, frame, bodypart, sum(s) AS s FROM (SELECT video, frame, bodypart,
        coalesce((x - lag(x) OVER w) ** 2, 0) + coalesce((y - lag(y) OVER w) ** 2, 0) AS s FROM pred WINDOW w AS (PARTITION BY video, individual, bodypart ORDER BY frame))
      GROUP BY video, frame, bodypart) WHERE s > 400""",
}
_NEEDS = {"pred": ["e"], "pred1": ["e"], "truth": ["pred"], "tidy": ["truth"], "counts": ["pred"], "outliers": ["pred"], "finite": ["human"]}


def oracle(body: str, *views: str) -> str:
    """`body` behind the definitions of the views it uses."""
    order: list[str] = []

    def need(name: str) -> None:
        for other in _NEEDS.get(name, []):
            need(other)
        if name not in order:
            order.append(name)

    for v in views:
        need(v)
    return "WITH " + ", ".join(f"{v} AS ({SQL[v]})" for v in order) + " " + body
