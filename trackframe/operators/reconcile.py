"""Matching of requests, results and claims."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.paths import stem


def resolved(path: Column, base: str = "/") -> Column:
    """The path made absolute below `base`, without '.', '..' and empty parts."""
    full = F.when(path.startswith("/"), path).otherwise(F.concat(F.lit(base.rstrip("/") + "/"), path))
    parts = F.filter(F.split(full, "/"), lambda p: ~p.isin("", "."))
    step = lambda done, p: F.when(p == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))).otherwise(F.concat(done, F.array(p)))
    return F.concat(F.lit("/"), F.array_join(F.aggregate(parts, F.array().cast("array<string>"), step), "/"))


def registered_match(registered: DataFrame, requested: DataFrame, base: str = "/") -> DataFrame:
    """(ord, path) of the registered videos (ord, path) that are requested (path), each once; both by their resolved paths below `base`."""
    own, asked = registered.withColumn("at", resolved(F.col("path"), base)), requested.select(resolved(F.col("path"), base).alias("at"))
    return own.join(asked, "at", "left_semi").select("ord", "path")


def unmatched_requests(registered: DataFrame, requested: DataFrame, base: str = "/") -> DataFrame:
    """(path) of the requests, each once, that resolve to no registered video."""
    own = registered.select(resolved(F.col("path"), base).alias("at"))
    return requested.select("path", resolved(F.col("path"), base).alias("at")).dropDuplicates(["at"]).join(own, "at", "left_anti").select("path")


def analyzed_videos(registered: DataFrame, predictions: DataFrame) -> DataFrame:
    """Registered videos that have predictions, by name only."""
    return registered.join(predictions.select("video").distinct(), "video", "left_semi")


def in_refinement(machine: DataFrame, refined: DataFrame | None = None) -> DataFrame:
    """(video) with machine labels of any iteration or a refinement of them."""
    found = machine.select("video")
    return (found if refined is None else found.unionByName(refined.select("video"))).distinct()


def refinement_exclusion(videos: DataFrame, machine: DataFrame, refined: DataFrame | None = None) -> DataFrame:
    """Videos without machine labels of any iteration and without a refinement of them."""
    return videos.join(in_refinement(machine, refined), "video", "left_anti")


def duplicate_stems(videos: DataFrame) -> DataFrame:
    """(stem, paths, first_path, other_path): stems that different paths share, with the first and the last of these by name. The same
    path twice is allowed."""
    named = videos.select(stem(F.col("path")).alias("stem"), "path").where("stem <> ''").distinct()
    return named.groupBy("stem").agg(F.count("*").alias("paths"), F.min("path").alias("first_path"), F.max("path").alias("other_path")).where("paths > 1")


def duplicate_targets(videos: DataFrame) -> DataFrame:
    """(directory, stem, rows): prediction targets that occur more than once; the same path twice counts."""
    return videos.groupBy("directory", stem(F.col("path")).alias("stem")).agg(F.count("*").alias("rows")).where("rows > 1")


def require_unique_stems(videos: DataFrame) -> DataFrame:
    """`videos` again; an error that names both paths where two share a stem, since their frames would share a folder."""
    clash = duplicate_stems(videos).orderBy("stem").limit(1).collect()
    if clash:
        raise ValueError(f"{clash[0]['first_path']} and {clash[0]['other_path']} share the name {clash[0]['stem']!r}")
    return videos


def ordered_dedup(rows: DataFrame, key: str, last_wins: bool = False) -> DataFrame:
    """The first row of each key by ord, or with `last_wins` the last row at the first one's place."""
    of_key = W.partitionBy(key)
    ranked = rows.withColumn("first_ord", F.min("ord").over(of_key)).withColumn("rank", F.row_number().over(of_key.orderBy(F.col("ord").desc() if last_wins else F.col("ord"))))
    kept = ranked.where("rank = 1").drop("rank")
    return kept.withColumn("ord", F.col("first_ord")).drop("first_ord")


def positional_pairs(videos: DataFrame, values: DataFrame) -> DataFrame:
    """Pairs videos (ord, path) with values (ord, value): one value serves all, else their numbers must agree."""
    n, m = videos.count(), values.count()
    if m == 1:
        return videos.crossJoin(F.broadcast(values.select("value")))
    if n != m:
        raise ValueError(f"{m} values for {n} videos")
    return videos.join(values, "ord")


def existing_files(registered: DataFrame, listing: DataFrame) -> DataFrame:
    return registered.join(listing.select("path").distinct(), "path", "left_semi")


def resolved_outputs(videos: DataFrame, listing: DataFrame, scorer: str) -> DataFrame:
    """(stem, output): the file <stem><scorer>.h5 if it exists, else the last by name that begins so; null without any."""
    # a name begins with a stem and the scorer wherever the scorer stands in it, so names are keyed by what comes before each place
    times = F.size(F.split("name", re.escape(scorer))) - 1
    names = listing.select("name").where(F.col("name").endswith(".h5")).withColumn("k", F.explode(F.when(times > 0, F.sequence(F.lit(1), times))))
    names = names.select("name", F.call_function("substring_index", F.col("name"), F.lit(scorer), F.col("k")).alias("stem"))
    found = videos.select("stem").join(names, "stem", "left")
    exact = F.max(F.when(F.col("name") == F.concat("stem", F.lit(f"{scorer}.h5")), F.col("name")))
    return found.groupBy("stem").agg(F.coalesce(exact, F.max("name")).alias("output"))


def ordered_outputs(videos: DataFrame, outputs: DataFrame) -> DataFrame:
    """(ord, stem, output) in the order of the videos (ord, stem)."""
    return videos.select("ord", "stem").join(outputs, "stem").select("ord", "stem", "output").orderBy("ord")


def unreported_work(items: DataFrame, claims: DataFrame, results: DataFrame, exits: DataFrame) -> DataFrame:
    """(key, state) of items without a result: 'lost with its worker' if the worker that claimed it has exited with an error, 'claimed'
    if not, 'never claimed' without a claim."""
    open_ = items.select("key").join(results.select("key"), "key", "left_anti")
    claimed = open_.join(claims.select("key", "worker"), "key", "left").join(exits.select("worker", "code"), "worker", "left")
    lost = claimed.groupBy("key").agg(F.max("worker").alias("worker"), F.max(F.when(F.col("code") != 0, 1)).alias("bad"))
    state = F.when(F.col("worker").isNull(), "never claimed").when(F.col("bad") == 1, "lost with its worker").otherwise("claimed")
    return lost.select("key", state.alias("state"))


def run_status_rollup(outcomes: DataFrame) -> DataFrame:
    """One row: ok, not_analyzed, errors and the frames written of the ok ones, from (status, written)."""
    n = lambda s: F.count(F.when(F.col("status") == s, 1))
    return outcomes.agg(
        n("ok").alias("ok"), n("not_analyzed").alias("not_analyzed"), n("error").alias("errors"),
        F.coalesce(F.sum(F.when(F.col("status") == "ok", F.col("written"))), F.lit(0)).cast("long").alias("written"),
    )


def input_size_fixed(sizes: DataFrame, group: str) -> DataFrame:
    """(group, fixed): whether all (width, height) are known and equal; sizes that are not positive are unknown."""
    known = F.when((F.col("width") > 0) & (F.col("height") > 0), F.struct("width", "height"))
    return sizes.groupBy(group).agg(((F.countDistinct(known) == 1) & (F.count(known) == F.count("*"))).alias("fixed"))


def version_floor(published: DataFrame, bounds: DataFrame) -> DataFrame:
    """(bound, variant): the newest published version at most the bound; versions are structs (major, minor)."""
    pairs = bounds.join(F.broadcast(published), F.col("version") <= F.col("bound"), "left")
    return pairs.groupBy("bound").agg(F.max("version").alias("variant"))
