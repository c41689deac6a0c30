"""Groups of videos by the names of their files."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import date_span, group_key_of, kind, pieces
from ..functions.paths import stem
from ..runtime import computed_once


def inferred_groups(videos: DataFrame) -> DataFrame:
    """(ord, path, stem, group): the key beside the date in the name, the stem where there is none."""
    named = videos.select("ord", "path", stem(F.col("path")).alias("stem"))
    parted = computed_once(named.withColumn("parts", pieces(F.col("stem"))))
    sorted_out = computed_once(parted.withColumn("kinds", F.transform("parts", kind)))
    spanned = computed_once(sorted_out.withColumn("span", date_span(F.col("kinds"))).drop("kinds"))
    return spanned.select("ord", "path", "stem", F.coalesce(group_key_of(F.col("parts"), F.col("span")), F.col("stem")).alias("group"))


def pattern_groups(videos: DataFrame, pattern: str) -> DataFrame:
    """Groups by a regular expression of Python: its first group if that took part, else the whole match; the stem
    where nothing matches, or nothing but an empty string."""
    re.compile(pattern)

    @F.pandas_udf("string")
    def key(stems: pd.Series) -> pd.Series:
        compiled = re.compile(pattern)

        def of(name: str) -> str:
            match = compiled.search(name)
            if match is None:
                return name
            own = match.group(1) if compiled.groups and match.group(1) is not None else match.group(0)
            return own or name

        return stems.map(of)

    named = videos.select("ord", "path", stem(F.col("path")).alias("stem"))
    return named.withColumn("group", key("stem"))


def group_members(grouped: DataFrame) -> DataFrame:
    """(group, first_ord, members): groups with their stems in order, one row each."""
    return grouped.groupBy("group").agg(
        F.min("ord").alias("first_ord"), F.count("*").alias("members"), F.transform(F.array_sort(F.collect_list(F.struct("ord", "stem"))), lambda s: s["stem"]).alias("stems")
    )
