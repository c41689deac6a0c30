"""What Python code on executors needs (the package itself, which a cluster's executors don't have installed), and a barrier for plans."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_shipped: dict[str, str] = {}


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once for each Spark application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="trackframe-"), "trackframe.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(root)))
    context.addPyFile(path)
    _shipped[context.applicationId] = path


def map_arrow(df: DataFrame, function: Callable, schema) -> DataFrame:
    """`df.mapInArrow`, with this package at hand on the executors."""
    ship(df.sparkSession)
    return df.mapInArrow(function, schema)


def computed_once(df: DataFrame) -> DataFrame:
    """`df` with its columns computed here: Catalyst would otherwise copy their expressions into every use in the projections
    above, and into the bodies of higher-order functions, where they run again for each element."""
    return df.select(F.explode(F.array(F.struct(*df.columns))).alias("row")).select("row.*")
