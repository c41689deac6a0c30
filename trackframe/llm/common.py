"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

#: A word is a run of anything but these six ASCII white-space characters.
WORD_BREAK = r"[\x20\x09-\x0D]+"


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or where it is unset (as in tests) a new folder of this
    machine, which is then also set as the session's checkpoint folder. On a cluster, whose executors wouldn't share that, it is an
    error."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="trackframe-")
        spark.sparkContext.setCheckpointDir(path)
        path = spark.sparkContext.getCheckpointDir() or path
    return path.rstrip("/")


def stage(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write `df` once as Parquet in the shared folder and read it back: lineage ends there, lost executors only cost
    the tasks that read it again. The files go when the driver's JVM ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/trackframe/{name}-{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(path)
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return spark.read.schema(df.schema).parquet(path)


#: A key is hot when it holds more than this share of all rows, so there are at most 1 / HOT_SHARE of them.
HOT_SHARE = 1 / 2000


def looked_up(rows: DataFrame, table: DataFrame, key: str, weight: str, total: float, apart: Column, share: float = HOT_SHARE) -> DataFrame:
    """The inner join of `rows` with `table`, which has `key` once each and says in `weight` how many rows hold it, without gathering
    a hot key's rows: keys above `share` of `total` (at most 1 / share of them) are broadcast, and their rows go through the other
    join under `apart`, a key of their own. The columns of `table` but key and weight are added."""
    values = [c for c in table.columns if c not in (key, weight)]
    hot = F.col(weight) > F.lit(max(1.0, total * share))
    few = table.where(hot).select(F.col(key).alias("__key"), F.lit(True).alias("__hot"), *(F.col(v).alias(f"__hot_{v}") for v in values))
    rows = rows.join(F.broadcast(few), rows[key] == F.col("__key"), "left").drop("__key")
    rows = rows.withColumn("__apart", F.when(F.col("__hot"), apart).otherwise(F.col(key)))
    rest = table.where(~hot).select(F.col(key).alias("__apart"), F.lit(True).alias("__cold"), *(F.col(v).alias(f"__cold_{v}") for v in values))
    rows = rows.join(rest, "__apart", "left").where(F.col("__hot") | F.col("__cold"))
    both = [F.when(F.col("__hot"), F.col(f"__hot_{v}")).otherwise(F.col(f"__cold_{v}")).alias(v) for v in values]
    return rows.select(*(c for c in rows.columns if not c.startswith("__")), *both)


def ascii_lower(text: Column) -> Column:
    """Lower-cases A to Z and nothing else; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo `modulus`; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def word_count(text: Column) -> Column:
    """Number of words of a text (null: 0)."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, WORD_BREAK))).cast("long")
