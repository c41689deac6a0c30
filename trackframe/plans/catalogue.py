"""Every query of the catalogue with its SQL oracle. Floats are rounded, computed integers are long."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import nested, numbers, paths, texts
from ..operators import detect, evaluate, labelsets, naming, progress, ranges, reconcile, sampling, select, series, trajectory
from ..sources import fixtures as fx
from . import pipelines

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLES: dict[str, str] = {}


def query(sql: str | None = None, *views: str):
    """Registers the function's name, with its oracle over fixture views."""

    def register(function):
        _QUERIES[function.__name__] = function
        if sql is not None:
            _ORACLES[function.__name__] = fx.oracle(sql, *views) if views else sql
        return function

    return register


def _rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    for c in columns:
        df = df.withColumn(c, F.round(c, digits))
    return df


# ---- detection


@query("SELECT video, frame FROM outliers", "outliers")
def jump_outliers(spark, sf):
    return detect.jump_outliers(fx.pred(spark, sf), 20.0)


@query("SELECT video, count(*) AS n FROM outliers GROUP BY video", "outliers")
def jump_outlier_counts(spark, sf):
    return detect.jump_outliers(fx.pred(spark, sf), 20.0).groupBy("video").agg(F.count("*").alias("n"))


@query("SELECT DISTINCT video, frame FROM pred WHERE likelihood < 0.05::DOUBLE", "pred")
def uncertain_outliers(spark, sf):
    return detect.uncertain_outliers(fx.pred(spark, sf), 0.05)


@query("SELECT video, CAST(frame AS BIGINT) AS frame FROM (SELECT DISTINCT user_id AS video FROM events), (SELECT unnest([1, 2, 3]) AS frame)")
def list_outliers(spark, sf):
    return detect.list_outliers(fx.table(spark, sf, "events").select(F.col("user_id").alias("video")).distinct(), [3, 1, 2, 1])


@query(
    """SELECT video, frame, position, n FROM (SELECT video, frame, row_number() OVER (PARTITION BY video ORDER BY frame) - 1 AS position, count(*) OVER (PARTITION BY video) AS n FROM pred1)
    WHERE position >= floor(n * 0.25::DOUBLE) AND position < ceil(n * 0.75::DOUBLE)""",
    "pred1",
)
def frame_window_slice(spark, sf):
    return series.frame_window(fx.pred1(spark, sf), 0.25, 0.75).select("video", "frame", "position", "n")


@query(
    """SELECT video, frame, individual, bodypart, round(x + CASE WHEN video % 2 = 0 THEN 10 - CASE WHEN video % 3 = 0 THEN 5 ELSE 0 END ELSE 0 END, 6) AS x,
      round(y + CASE WHEN video % 2 = 0 THEN 20 - CASE WHEN video % 3 = 0 THEN 5 ELSE 0 END ELSE 0 END, 6) AS y FROM pred""",
    "pred",
)
def crop_offset(spark, sf):
    p = fx.pred(spark, sf)
    v = fx.table(spark, sf, "events").select(F.col("user_id").alias("video")).distinct()
    metadata = v.select("video", (F.col("video") % 2 == 0).alias("cropped"), F.lit(10).alias("x1"), F.lit(20).alias("y1"))
    config = v.where("video % 3 = 0").select("video", F.lit("5, 100, 5, 100").alias("crop"))
    return _rounded(series.crop_offset(p, metadata, config).select("video", "frame", "individual", "bodypart", "x", "y"), "x", "y")


@query("SELECT video, frame, individual, x, y FROM pred WHERE bodypart IN ('bp1')", "pred")
def bodypart_projection(spark, sf):
    return series.bodypart_projection(fx.pred(spark, sf), ["bp1"]).select("video", "frame", "individual", "x", "y")


@query(
    """SELECT p.video, p.frame, k.keypoint, p.x, p.y FROM pred p JOIN (SELECT video, individual, bodypart, CAST(row_number() OVER (PARTITION BY video ORDER BY individual, bodypart) - 1 AS INTEGER) AS keypoint
    FROM (SELECT DISTINCT video, individual, bodypart FROM pred)) k USING (video, individual, bodypart)""",
    "pred",
)
def keypoint_series(spark, sf):
    return series.keypoint_series(fx.pred(spark, sf)).select("video", "frame", "keypoint", "x", "y")


@query(
    """SELECT video, frame, individual, max(x) FILTER (bodypart = 'bp0') AS bp0_x, max(y) FILTER (bodypart = 'bp0') AS bp0_y, max(likelihood) FILTER (bodypart = 'bp0') AS bp0_likelihood,
    max(x) FILTER (bodypart = 'bp1') AS bp1_x, max(y) FILTER (bodypart = 'bp1') AS bp1_y, max(likelihood) FILTER (bodypart = 'bp1') AS bp1_likelihood FROM pred GROUP BY video, frame, individual""",
    "pred",
)
def wide_pivot(spark, sf):
    return series.wide_pivot(fx.pred(spark, sf), ["bp0", "bp1"])


@query("SELECT video, frame, individual, bodypart, x, y, likelihood FROM pred", "pred")
def long_unpivot(spark, sf):
    wide = series.wide_pivot(fx.pred(spark, sf), ["bp0", "bp1"])
    return series.long_unpivot(wide, ["bp0", "bp1"]).where("x is not null")


@query("SELECT video, frame FROM (SELECT video, frame, row_number() OVER (PARTITION BY video ORDER BY frame) - 1 AS k FROM outliers) WHERE k % 3 = 0", "outliers")
def candidate_stride(spark, sf):
    return series.candidate_stride(detect.jump_outliers(fx.pred(spark, sf), 20.0), 3)


def _counts(spark, sf):
    return fx.pred(spark, sf).groupBy("video").agg(F.countDistinct("frame").alias("frame_count"))


@query("SELECT o.video, o.frame FROM outliers o JOIN counts c USING (video) WHERE frame > floor(frame_count * 0.1::DOUBLE) AND frame < ceil(frame_count * 0.9::DOUBLE)", "outliers", "counts")
def candidate_window_crop(spark, sf):
    return series.candidate_window_crop(detect.jump_outliers(fx.pred(spark, sf), 20.0), _counts(spark, sf), 0.1, 0.9)


@query("SELECT video, unnest(range(CAST(floor(frame_count * 0.1::DOUBLE) AS BIGINT), CAST(ceil(frame_count * 0.9::DOUBLE) AS BIGINT), 2)) AS frame FROM counts", "counts")
def candidate_range(spark, sf):
    return series.candidate_range(_counts(spark, sf), 0.1, 0.9, 2)


@query("SELECT video, greatest(1, CAST(ceil((ceil(frame_count * 0.9::DOUBLE) - floor(frame_count * 0.1::DOUBLE)) / 3) AS BIGINT)) AS total FROM counts", "counts")
def clustering_totals(spark, sf):
    return series.clustering_totals(_counts(spark, sf), 0.1, 0.9, 3)


@query(
    """SELECT video, frame, round(avg(d), 6) AS deviation FROM (SELECT video, frame, abs(x - y) AS d FROM pred) GROUP BY video, frame""",
    "pred",
)
def keypoint_nanmean_deviation(spark, sf):
    d = fx.pred(spark, sf).select("video", "frame", "bodypart", F.abs(F.col("x") - F.col("y")).alias("deviation"))
    return _rounded(detect.nanmean_deviation(d), "deviation")


@query(
    """, d AS (SELECT video, frame, round(avg(abs(x - y)), 6) AS deviation FROM pred GROUP BY video, frame),
    r AS (SELECT *, row_number() OVER (PARTITION BY video ORDER BY deviation DESC, frame DESC) AS k, count(*) FILTER (deviation > 60) OVER (PARTITION BY video) AS far, count(*) OVER (PARTITION BY video) AS n FROM d)
    SELECT video, frame AS position FROM r WHERE CASE WHEN far < 10 AND n > 10 THEN k <= 10 ELSE deviation > 60 END""",
    "pred",
)
def deviation_topk_fallback(spark, sf):
    d = fx.pred(spark, sf).select("video", "frame", "bodypart", F.abs(F.col("x") - F.col("y")).alias("deviation"))
    return detect.deviation_outliers(_rounded(detect.nanmean_deviation(d), "deviation"), 5, 60.0)


@query(
    """, g AS (SELECT *, likelihood >= 0.1::DOUBLE AS good FROM pred1),
    l AS (SELECT video, frame, x, y, good AND coalesce(lag(good) OVER w, false) AS fits, last_value(CASE WHEN good THEN x END IGNORE NULLS) OVER b AS x0, last_value(CASE WHEN good THEN y END IGNORE NULLS) OVER b AS y0
      FROM g WINDOW w AS (PARTITION BY video ORDER BY frame), b AS (PARTITION BY video ORDER BY frame ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    f AS (SELECT video, regr_slope(x, x0) AS xb, regr_intercept(x, x0) AS xa, regr_slope(y, y0) AS yb, regr_intercept(y, y0) AS ya FROM l WHERE fits GROUP BY video)
    SELECT video, frame FROM l JOIN f USING (video) WHERE sqrt((x - xa - xb * x0) ** 2 + (y - ya - yb * y0) ** 2) > 60""",
    "pred1",
)
def ar1_residual_outliers(spark, sf):
    return trajectory.ar1_deviation(fx.pred1(spark, sf), 0.1).where(F.col("deviation") > 60).select("video", "frame")


@query()
def arma_residual_outliers(spark, sf):
    return trajectory.fitting_outliers(fx.pred1(spark, sf), frames_per_video=3, pixel_distance=60.0)


@query(
    """SELECT video, count(*) AS candidates, CASE WHEN count(*) > 1 THEN round((max(frame) - min(frame))::DOUBLE / (count(*) - 1), 6) END AS mean_gap,
    coalesce(CASE WHEN count(*) > 1 THEN (max(frame) - min(frame))::DOUBLE / (count(*) - 1) END <= 2, false) AS stream FROM outliers GROUP BY video""",
    "outliers",
)
def candidate_density_mode(spark, sf):
    return _rounded(series.candidate_density(detect.jump_outliers(fx.pred(spark, sf), 20.0), 2.0), "mean_gap")


# ---- selection


@query()
def kmeans_representatives(spark, sf):
    return select.kmeans_representatives(fx.thumbs(spark, sf), 8)


@query(
    """, u AS (SELECT label AS video, vec_id AS frame, generate_subscripts(embedding, 1) AS i, unnest(embedding)::DOUBLE AS v FROM embeddings),
    c AS (SELECT video, frame, i, v - avg(v) OVER (PARTITION BY video, i) AS w FROM u) SELECT video, frame, round(sum(w * w), 4) AS energy FROM c GROUP BY video, frame""",
    "disk_frames",
)
def feature_centering(spark, sf):
    c = series.feature_centering(fx.thumbs(spark, sf))
    return c.select("video", "frame", F.round(F.aggregate("centered", F.lit(0.0), lambda s, v: s + v * v), 4).alias("energy"))


@query(
    """, r AS (SELECT video, frame, row_number() OVER (PARTITION BY video ORDER BY frame) - 1 AS k, count(*) OVER (PARTITION BY video) AS n FROM outliers)
    SELECT video, frame FROM r WHERE n <= 5 OR k IN (0, (n - 1) // 4, 2 * (n - 1) // 4, 3 * (n - 1) // 4, n - 1)""",
    "outliers",
)
def uniform_selection(spark, sf):
    return select.uniform_selection(detect.jump_outliers(fx.pred(spark, sf), 20.0), 5)


@query("SELECT video, frame FROM (SELECT video, frame, row_number() OVER (PARTITION BY video ORDER BY frame) - 1 AS k FROM outliers) WHERE k % 2 = 0", "outliers")
def detect_pipeline(spark, sf):
    return detect.detect_outliers(fx.pred(spark, sf), "jump", step=2, pixel_distance=20.0)


# ---- label sets


@query("SELECT video, image FROM finite", "finite")
def finite_labels(spark, sf):
    return labelsets.finite_labels(fx.human(spark, sf))


@query("SELECT DISTINCT video, image FROM machine", "machine")
def machine_label_union(spark, sf):
    return labelsets.machine_label_union(fx.machine(spark, sf))


@query("SELECT video, image FROM disk_frames EXCEPT (SELECT video, image FROM finite UNION SELECT video, image FROM machine)", "disk_frames", "finite", "machine")
def bare_frames(spark, sf):
    return labelsets.bare_frames(fx.disk_frames(spark, sf), fx.human(spark, sf), fx.machine(spark, sf))


@query("SELECT video, image FROM machine WHERE iteration = 1 EXCEPT SELECT video, image FROM finite", "finite", "machine")
def removable_outliers(spark, sf):
    return labelsets.removable_outliers(fx.machine(spark, sf), fx.human(spark, sf), 1)


@query(
    """SELECT m.video, coalesce(r.removed, 0) AS removed, m.video IN (SELECT DISTINCT video FROM disk_frames WHERE image % 50 = 0) AS refinement FROM (SELECT DISTINCT video FROM machine WHERE iteration = 1 AND video IS NOT NULL) m
    LEFT JOIN (SELECT video, count(*) AS removed FROM (SELECT video, image FROM machine WHERE iteration = 1 EXCEPT SELECT video, image FROM finite) GROUP BY video) r USING (video)""",
    "finite", "machine", "disk_frames",
)
def cleared_outliers(spark, sf):
    refined = fx.disk_frames(spark, sf).where("image % 50 = 0")
    return labelsets.cleared_outliers(fx.machine(spark, sf).where("video is not null"), fx.human(spark, sf), refined, 1)


@query(
    """SELECT video, count(*) AS pending FROM (SELECT video, image FROM machine WHERE iteration = 0 EXCEPT (SELECT video, image FROM finite UNION SELECT video, image FROM disk_frames WHERE image % 7 = 0)) GROUP BY video""",
    "finite", "machine", "disk_frames",
)
def pending_refinement(spark, sf):
    refined = fx.disk_frames(spark, sf).where("image % 7 = 0").select("*", F.lit(1.0).alias("x"), F.lit(float("nan")).alias("y"))
    return labelsets.pending_refinement(fx.machine(spark, sf), fx.human(spark, sf), refined, 0)


@query(
    """SELECT (SELECT count(DISTINCT video) FROM disk_frames) AS directories, (SELECT count(DISTINCT video) FROM finite) AS labelled_directories, (SELECT count(*) FROM disk_frames) AS frames""",
    "disk_frames", "finite",
)
def purge_preview(spark, sf):
    return labelsets.purge_preview(fx.disk_frames(spark, sf), fx.human(spark, sf))


@query("SELECT video, image FROM human WHERE (video, image) NOT IN (SELECT (video, image) FROM machine WHERE iteration = 1)", "human", "machine")
def drop_label_rows(spark, sf):
    return labelsets.drop_label_rows(fx.human(spark, sf), fx.machine(spark, sf).where("iteration = 1")).select("video", "image")


# ---- registration


def _requests(spark, sf):
    v = fx.videos(spark, sf)
    return v.where("ord % 11 = 0").select("path").unionByName(v.where("ord % 22 = 0").select(F.concat("path", F.lit(".bogus")).alias("path")))


_REQUESTS = "(SELECT path FROM videos WHERE ord % 11 = 0 UNION ALL SELECT path || '.bogus' FROM videos WHERE ord % 22 = 0)"


@query(f"SELECT ord, path FROM videos WHERE path IN {_REQUESTS}", "videos")
def registered_match(spark, sf):
    return reconcile.registered_match(fx.videos(spark, sf), _requests(spark, sf))


@query(f"SELECT DISTINCT path FROM {_REQUESTS} WHERE path NOT IN (SELECT path FROM videos)", "videos")
def unmatched_requests(spark, sf):
    return reconcile.unmatched_requests(fx.videos(spark, sf), _requests(spark, sf))


@query("SELECT c_custkey AS video FROM customer WHERE c_custkey IN (SELECT user_id FROM events)")
def analyzed_videos(spark, sf):
    return reconcile.analyzed_videos(fx.table(spark, sf, "customer").select(F.col("c_custkey").alias("video")), fx.pred(spark, sf))


@query("SELECT c_custkey AS video FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events WHERE event_id % 30 = 0) AND c_custkey % 7 <> 0")
def refinement_exclusion(spark, sf):
    machine = fx.table(spark, sf, "events").where("event_id % 30 = 0").select(F.col("user_id").alias("video"))
    videos = fx.table(spark, sf, "customer").select(F.col("c_custkey").alias("video"))
    return reconcile.refinement_exclusion(videos, machine, videos.where("video % 7 = 0"))


@query("""SELECT o_orderkey AS ord, '/data/d' || (o_orderkey % 3) || '/m' || (o_custkey % 20) || '.mp4' AS path FROM orders""")
def resolved_paths(spark, sf):
    o = fx.table(spark, sf, "orders")
    name = F.concat(F.lit("m"), (F.col("o_custkey") % 20).cast("string"), F.lit(".mp4"))
    folder = F.concat(F.lit("d"), (F.col("o_orderkey") % 3).cast("string"))
    crooked = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("/data/./x/../"), folder, F.lit("//"), name)).otherwise(F.concat(F.lit("../"), folder, F.lit("/./"), name))
    return o.select(F.col("o_orderkey").alias("ord"), reconcile.resolved(crooked, "/data/project").alias("path"))


_STEM = r"regexp_extract(path, '([^/]+?)(\.[^./]*)?$', 1)"


@query(
    f"""SELECT stem, count(*) AS paths, min(path) AS first_path, max(path) AS other_path FROM (SELECT DISTINCT {_STEM} AS stem, path
    FROM (SELECT '/data/d' || (o_orderkey % 2) || '/clip' || (o_custkey % 50) || '.mp4' AS path FROM orders)) GROUP BY stem HAVING count(*) > 1"""
)
def duplicate_stems(spark, sf):
    o = fx.table(spark, sf, "orders")
    path = F.concat(F.lit("/data/d"), (F.col("o_orderkey") % 2).cast("string"), F.lit("/clip"), (F.col("o_custkey") % 50).cast("string"), F.lit(".mp4"))
    return reconcile.duplicate_stems(o.select(path.alias("path")))


@query(f'SELECT directory, {_STEM} AS stem, count(*) AS "rows" FROM videos GROUP BY ALL HAVING count(*) > 1', "videos")
def duplicate_targets(spark, sf):
    return reconcile.duplicate_targets(fx.videos(spark, sf))


@query("SELECT path, min(ord) AS ord, arg_max(existing, ord) AS existing FROM videos GROUP BY path", "videos")
def ordered_dedup(spark, sf):
    return reconcile.ordered_dedup(fx.videos(spark, sf), "path", last_wins=True).select("path", "ord", "existing")


@query(
    f"SELECT ord, {_STEM} AS stem, regexp_extract(path, '[^/](\\.[^./]+)$', 1) AS suffix, regexp_extract(path, '^(.*)/[^/]*$', 1) AS parent, string_split(path, '/')[-1] AS name FROM videos", "videos"
)
def path_parts(spark, sf):
    p = F.col("path")
    return fx.videos(spark, sf).select("ord", paths.stem(p).alias("stem"), paths.suffix(p).alias("suffix"), paths.parent(p).alias("parent"), paths.file_name(p).alias("name"))


@query(
    """SELECT doc_id, CASE WHEN doc_id % 4 = 3 THEN '' WHEN doc_id % 4 < 2 THEN source ELSE 'plain' END AS video,
    CASE WHEN doc_id % 4 = 3 THEN 'labeled-data' WHEN doc_id % 4 < 2 THEN 'labeled-data/' || source || '/img' || doc_id || '.png' ELSE 'img' || doc_id || '.png' END AS image FROM documents"""
)
def relative_image_path(spark, sf):
    d = fx.table(spark, sf, "documents").select("doc_id", "source")
    name = F.concat(F.lit("img"), F.col("doc_id").cast("string"), F.lit(".png"))
    whole = F.when(F.col("doc_id") % 4 == 3, F.lit("/p/labeled-data")).when(F.col("doc_id") % 4 < 2, F.concat(F.lit("/p/labeled-data/"), "source", F.lit("/"), name)).otherwise(F.concat(F.lit("/p/plain/"), name))
    return d.select("doc_id", paths.relative_image(whole).alias("r")).select("doc_id", "r.video", "r.image")


@query("SELECT doc_id, 'img' || doc_id || '.png' AS image FROM documents")
def image_name(spark, sf):
    full = F.concat(F.lit("labeled-data/"), "source", F.lit("/img"), F.col("doc_id").cast("string"), F.lit(".png"))
    return fx.table(spark, sf, "documents").select("doc_id", paths.file_name(full).alias("image"))


@query(
    """SELECT ord, [TRY_CAST(trim(p[1]) AS INTEGER), TRY_CAST(trim(p[2]) AS INTEGER), TRY_CAST(trim(p[3]) AS INTEGER), TRY_CAST(trim(p[4]) AS INTEGER)]::VARCHAR AS crop
    FROM (SELECT ord, string_split('0, ' || existing || ', 0, ' || ord, ',') AS p FROM videos WHERE ord % 5 <> 0) UNION ALL SELECT ord, NULL FROM videos WHERE ord % 5 = 0""",
    "videos",
)
def crop_parse(spark, sf):
    v = fx.videos(spark, sf)
    text = F.when(F.col("ord") % 5 == 0, F.lit("0, x, 1")).otherwise(F.concat(F.lit("0, "), F.col("existing").cast("string"), F.lit(", 0, "), F.col("ord").cast("string")))
    crop = paths.parse_crop(text)
    return v.select("ord", F.when(crop.isNotNull(), F.concat(F.lit("["), F.array_join(crop.cast("array<string>"), ", "), F.lit("]"))).alias("crop"))


_GROUP = """CASE ord % 6 WHEN 5 THEN 'M' || lpad(CAST(o_custkey % 20 AS VARCHAR), 2, '0') || '_run1' ELSE 'M' || lpad(CAST(o_custkey % 20 AS VARCHAR), 2, '0') END"""


@query(f'SELECT ord, {_GROUP} AS "group" FROM videos JOIN orders ON ord = o_orderkey', "videos")
def group_key_inferred(spark, sf):
    return naming.inferred_groups(fx.videos(spark, sf)).select("ord", "group")


@query(r"""SELECT ord, regexp_extract(path, 'M\d+', 0) AS "group" FROM videos""", "videos")
def group_key_regex(spark, sf):
    return naming.pattern_groups(fx.videos(spark, sf), r"(M\d+)").select("ord", "group")


@query(f'SELECT {_GROUP} AS "group", min(ord) AS first_ord, count(*) AS members FROM videos JOIN orders ON ord = o_orderkey GROUP BY ALL', "videos")
def group_members(spark, sf):
    return naming.group_members(naming.inferred_groups(fx.videos(spark, sf))).drop("stems")


# ---- sampling


@query(
    """SELECT s.video, count(d.image) AS existing FROM (SELECT video FROM disk_frames WHERE video IS NOT NULL UNION SELECT 'none' || n_nationkey FROM nation) s LEFT JOIN disk_frames d USING (video) GROUP BY s.video""",
    "disk_frames",
)
def extracted_counts(spark, sf):
    frames = fx.disk_frames(spark, sf)
    none = fx.table(spark, sf, "nation").select(F.concat(F.lit("none"), F.col("n_nationkey").cast("string")).alias("video"))
    return sampling.extracted_counts(frames.where("video is not null").select("video").unionByName(none).distinct(), frames)


@query(
    """SELECT video, "group", existing, coalesce(video % 13 = 0, false) AS pinned FROM candidates""", "candidates",
)
def pinned_candidates(spark, sf):
    c = fx.candidates(spark, sf)
    requested = c.where("video % 13 = 0").select("video").unionByName(spark.range(1).select((F.col("id") - 1).alias("video")))
    return sampling.with_pins(c, requested).select("video", "group", "existing", "pinned")


@query("SELECT video, cap AS picks FROM candidates WHERE cap > 0", "candidates")
def pick_counts(spark, sf):
    return sampling.pick_counts(fx.candidates(spark, sf), 20)


_TOTAL = "(SELECT CAST(sum(existing) AS BIGINT) FROM candidates)"
_STATUS = f"{_TOTAL} AS existing, {_TOTAL} + 5000 AS target, CAST(5000 AS BIGINT) AS remaining"


def _budget(spark, sf) -> int:
    return int(fx.candidates(spark, sf).agg(F.sum("existing")).first()[0]) + 5000


@query(
    f"SELECT {_STATUS}, CAST(sum(cap) AS BIGINT) AS capacity, false AS met, sum(cap) < 5000 AS unreachable, sum(cap) FILTER (pinned) > 5000 AS overshoot FROM candidates", "candidates"
)
def budget_status(spark, sf):
    return sampling.budget_status(fx.candidates(spark, sf), 20, _budget(spark, sf))


@query(
    """, o AS (SELECT *, CASE WHEN pinned THEN 0 WHEN existing = 0 THEN 1 ELSE 2 END AS tier FROM candidates WHERE pinned OR cap > 0),
    s AS (SELECT video, cap, tier, CAST(sum(cap) OVER (ORDER BY tier, ord) - cap AS BIGINT) AS prior FROM o) SELECT * FROM s WHERE tier = 0 OR prior < 5000""",
    "candidates",
)
def uniform_budget_fill(spark, sf):
    return sampling.uniform_fill(fx.candidates(spark, sf), 20, _budget(spark, sf)).select("video", "cap", F.col("tier").cast("int").alias("tier"), F.col("prior").cast("long").alias("prior"))


_BALANCED = """, g AS (SELECT "group", sum(existing) + coalesce(sum(cap) FILTER (pinned), 0) AS covered FROM candidates GROUP BY "group"),
    f AS (SELECT c.video, c."group", c.cap, c.ord, 1 AS tier, CAST(g.covered + sum(c.cap) OVER (PARTITION BY c."group" ORDER BY c.existing > 0, c.ord DESC) - c.cap AS BIGINT) AS coverage
      FROM candidates c JOIN g ON c."group" = g."group" WHERE NOT c.pinned AND c.cap > 0),
    a AS (SELECT video, "group", cap, ord, 0 AS tier, CAST(-1 AS BIGINT) AS coverage, '' AS tie FROM candidates WHERE pinned UNION ALL SELECT video, "group", cap, ord, tier, coverage, "group" FROM f),
    s AS (SELECT video, "group", cap, tier, coverage, CAST(sum(cap) OVER (ORDER BY coverage, tie, ord) - cap AS BIGINT) AS prior FROM a),
    sel AS (SELECT * FROM s WHERE tier = 0 OR prior < 5000),
    cov AS (SELECT "group", CAST(sum(existing) AS BIGINT) AS existing, coalesce(max(added), 0) AS added, CAST(sum(existing) + coalesce(max(gain), 0) AS BIGINT) AS projected, count(*) FILTER (cap > 0) AS available
      FROM candidates LEFT JOIN (SELECT "group", count(*) AS added, sum(cap) AS gain FROM sel GROUP BY "group") USING ("group") GROUP BY "group")"""


@query(_BALANCED + "SELECT * FROM sel", "candidates")
def balanced_budget_fill(spark, sf):
    found = sampling.balanced_fill(fx.candidates(spark, sf), 20, _budget(spark, sf))
    return found.select("video", "group", "cap", F.col("tier").cast("int").alias("tier"), F.col("coverage").cast("long").alias("coverage"), F.col("prior").cast("long").alias("prior"))


@query(_BALANCED + "SELECT * FROM cov", "candidates")
def per_group_coverage(spark, sf):
    c = fx.candidates(spark, sf)
    return sampling.per_group_coverage(c, sampling.balanced_fill(c, 20, _budget(spark, sf)), 20)


@query(_BALANCED + "SELECT count(*) FILTER (added > 0) AS sampled, count(*) FILTER (added = 0 AND available > 0) AS starved FROM cov", "candidates")
def starved_groups(spark, sf):
    return sampling.starved_groups(per_group_coverage(spark, sf))


# ---- ranges

_RANGES = """, k AS (SELECT video, frame_count AS n, greatest(1, least(4, frame_count)) AS k FROM counts),
    r AS (SELECT video, n, k, unnest(range(k)) AS chunk FROM k),
    s AS (SELECT video, chunk, chunk * (n // k) + least(chunk, n % k) AS start, chunk * (n // k) + least(chunk, n % k) + n // k + CASE WHEN chunk < n % k THEN 1 ELSE 0 END AS "end" FROM r)"""


@query(_RANGES + "SELECT * FROM s", "counts")
def frame_ranges(spark, sf):
    return ranges.frame_ranges(_counts(spark, sf), 4)


def _chunks(spark, sf):
    p = fx.pred(spark, sf).select("video", "frame").distinct()
    r = ranges.frame_ranges(_counts(spark, sf), 4)
    results = ranges.chunk_of_frame(p, r).where("video % 10 <> 3 or chunk <> 2").groupBy("video", "chunk").agg(F.count("*").alias("rows"))
    return p, r, results.withColumn("error", F.when((F.col("video") % 10 == 4) & (F.col("chunk") == 1), F.lit("decode")))


_INTEGRITY = _RANGES + """, w AS (SELECT video, chunk, CASE WHEN video % 10 = 4 AND chunk = 1 THEN 'decode' WHEN video % 10 = 3 AND chunk = 2 THEN 'missing' END AS why FROM s),
    i AS (SELECT video, count(*) AS chunks, count(why) = 0 AS complete, arg_min(why, chunk) FILTER (why IS NOT NULL) AS first_error FROM w GROUP BY video)"""


@query(_INTEGRITY + "SELECT * FROM i", "counts")
def chunk_integrity(spark, sf):
    _, r, results = _chunks(spark, sf)
    return ranges.chunk_integrity(r, results)


@query(_INTEGRITY + "SELECT DISTINCT video, frame FROM pred JOIN i USING (video) WHERE complete", "counts", "pred")
def chunk_stitch(spark, sf):
    p, r, results = _chunks(spark, sf)
    return ranges.stitch(p, ranges.chunk_integrity(r, results))


# ---- evaluation


def _tidy(spark, sf):
    return evaluate.evaluation_tidy(fx.truth(spark, sf))


@query(
    """SELECT split, video, image, individual, bodypart, pred_x, pred_y, pred_likelihood, coalesce(gt_x, 'nan'::DOUBLE) AS gt_x, coalesce(gt_y, 'nan'::DOUBLE) AS gt_y,
    coalesce(round(error_px, 6), 'nan'::DOUBLE) AS error_px, above_pcutoff, matched FROM tidy""",
    "tidy",
)
def evaluation_tidy(spark, sf):
    return _rounded(_tidy(spark, sf), "error_px")


@query("SELECT split, count(DISTINCT image) AS images, round(avg(error_px), 6) AS rmse_px, round(avg(error_px) FILTER (above_pcutoff), 6) AS rmse_px_above FROM tidy GROUP BY split", "tidy")
def split_metrics(spark, sf):
    return _rounded(evaluate.split_metrics(_tidy(spark, sf)), "rmse_px", "rmse_px_above")


@query("SELECT round(avg(error_px) FILTER (split = 'test') - avg(error_px) FILTER (split = 'train'), 6) AS gap FROM tidy", "tidy")
def generalization_gap(spark, sf):
    return _rounded(evaluate.generalization_gap(_tidy(spark, sf)), "gap")


_WORST = "SELECT bodypart, round_even(rmse, 3) AS rmse FROM (SELECT 'k' || (video % 12) AS bodypart, avg(error_px) AS rmse FROM tidy GROUP BY ALL) ORDER BY rmse DESC, bodypart LIMIT 5"


@query(_WORST, "tidy")
def worst_keypoints(spark, sf):
    t = _tidy(spark, sf).withColumn("bodypart", F.concat(F.lit("k"), (F.col("video") % 12).cast("string")))
    return evaluate.worst_keypoints(evaluate.keypoint_errors(t))


@query("SELECT count(*) AS unmatched FROM (SELECT image FROM tidy GROUP BY image HAVING NOT bool_or(matched))", "tidy")
def unmatched_images(spark, sf):
    return evaluate.unmatched_images(_tidy(spark, sf))


@query("SELECT DISTINCT image, individual FROM truth WHERE v > 0", "truth")
def surviving_individuals(spark, sf):
    return evaluate.surviving_individuals(fx.truth(spark, sf))


@query()
def image_matches(spark, sf):
    return evaluate.image_matches(fx.truth(spark, sf))


_THRESHOLDS = tuple(0.5 + 0.05 * i for i in range(10))


@query(
    f"""WITH m AS (SELECT user_id AS image, (event_id * 37 % 1000)::DOUBLE / 1000 AS score, CASE WHEN event_id % 7 <> 0 THEN (event_id * 13 % 101)::DOUBLE / 100 END AS oks, 40 AS truths FROM events),
    t AS (SELECT unnest([{", ".join(f"{x!r}::DOUBLE" for x in _THRESHOLDS)}]) AS cut), n AS (SELECT sum(x) AS total FROM (SELECT max(truths) AS x FROM m GROUP BY image)),
    e AS (SELECT cut, score, count(*) FILTER (coalesce(oks, 0) >= cut) AS hits, count(*) AS n FROM m, t GROUP BY cut, score),
    c AS (SELECT cut, score, sum(hits) OVER w / (sum(n) OVER w)::DOUBLE AS p, sum(hits) OVER w / total::DOUBLE AS recall FROM e, n WINDOW w AS (PARTITION BY cut ORDER BY score DESC)),
    b AS (SELECT *, max(p) OVER (PARTITION BY cut ORDER BY score) AS best FROM c),
    l AS (SELECT cut, r, coalesce(max(best) FILTER (recall * 100 + 1e-9 >= r), 0) AS best FROM b, range(101) x(r) GROUP BY cut, r)
    SELECT round((SELECT avg(s) FROM (SELECT sum(best) / 101 AS s FROM l GROUP BY cut)), 6) AS map, round((SELECT avg(r) FROM (SELECT max(recall) AS r FROM b GROUP BY cut)), 6) AS mar"""
)
def average_precision(spark, sf):
    e = fx.table(spark, sf, "events")
    oks = F.when(F.col("event_id") % 7 != 0, (F.col("event_id") * 13 % 101).cast("double") / 100)
    matches = e.select(F.col("user_id").alias("image"), ((F.col("event_id") * 37 % 1000).cast("double") / 1000).alias("score"), oks.alias("oks"), F.lit(40).cast("long").alias("truths"))
    return _rounded(evaluate.average_precision(matches, _THRESHOLDS), "map", "mar")


@query(
    """SELECT p.image, p.individual, p.bodypart, p.x, t.gt_x FROM (SELECT * FROM truth WHERE frame % 5 <> 0) p LEFT JOIN (SELECT image, individual, bodypart, gt_x FROM truth WHERE frame % 3 <> 0 AND event_id % 7 <> 0) t
    USING (image, individual, bodypart) WHERE p.image IN (SELECT image FROM truth WHERE frame % 3 <> 0 AND event_id % 7 <> 0)""",
    "truth",
)
def prediction_truth_join(spark, sf):
    rows = fx.truth(spark, sf)
    predictions = rows.where("frame % 5 <> 0").select("image", "individual", "bodypart", "x")
    truth = rows.where("frame % 3 <> 0 and event_id % 7 <> 0").select("image", "individual", "bodypart", "gt_x")
    return evaluate.joined_truth(predictions, truth).select("image", "individual", "bodypart", "x", "gt_x")


@query("SELECT n_name AS bodypart, s_acctbal AS rmse FROM supplier JOIN nation ON s_suppkey = n_nationkey WHERE s_suppkey % 4 <> 0")
def named_keypoint_metrics(spark, sf):
    s = fx.table(spark, sf, "supplier")
    value = F.when(F.col("s_suppkey") % 4 == 0, F.lit(float("nan"))).otherwise(F.col("s_acctbal").cast("double"))
    metrics = s.select(F.concat(F.lit("rmse_keypoint_"), F.col("s_suppkey").cast("string")).alias("name"), value.alias("value"))
    metrics = metrics.unionByName(spark.range(1).select(F.lit("rmse").alias("name"), F.lit(1.0).alias("value")))
    return evaluate.named_keypoint_metrics(metrics, fx.table(spark, sf, "nation").select(F.col("n_nationkey").alias("ord"), F.col("n_name").alias("bodypart")))


@query(
    """SELECT 'best' AS wanted, n_name AS path FROM nation WHERE n_nationkey = 7 UNION ALL SELECT 'fallback', n_name FROM nation WHERE n_nationkey = (SELECT max(n_nationkey) FROM nation)
    UNION ALL SELECT '-2', n_name FROM nation WHERE n_nationkey = (SELECT max(n_nationkey) - 1 FROM nation) UNION ALL SELECT '3', n_name FROM nation WHERE n_nationkey = 3"""
)
def chosen_snapshot(spark, sf):
    s = fx.table(spark, sf, "nation").select(F.col("n_nationkey").alias("epoch"), F.col("n_name").alias("path"), (F.col("n_nationkey") == 7).alias("best"))
    none = s.withColumn("best", F.lit(False))
    found = [("best", s, "best"), ("fallback", none, "best"), ("-2", s, -2), ("3", s, 3)]
    parts = [evaluate.chosen_snapshot(t, i).select(F.lit(n).alias("wanted"), "path") for n, t, i in found]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


# ---- nested values and chunks


@query(
    """SELECT CAST(n_nationkey AS BIGINT) AS nation, CAST(k AS INTEGER) AS part, CAST(greatest(0, least(c, n_nationkey + 1 - s)) AS BIGINT) AS size, CASE WHEN s <= n_nationkey THEN CAST(s AS BIGINT) END AS "first"
    FROM nation, (VALUES (0, 2, 0), (1, 3, 2), (2, 5, 5), (3, 4, 10)) v(k, c, s)"""
)
def ragged_slices(spark, sf):
    n = fx.table(spark, sf, "nation").select(F.col("n_nationkey").cast("long").alias("nation"))
    parts = nested.ragged_slices(F.sequence(F.lit(0).cast("long"), F.col("nation")), F.array(*(F.lit(c) for c in (2, 3, 5, 4))))
    each = n.select("nation", F.posexplode(parts).alias("part", "items"))
    return each.select("nation", "part", F.size("items").cast("long").alias("size"), F.get("items", F.lit(0)).alias("first"))


@query(
    """SELECT n_nationkey AS nation, CASE WHEN n_nationkey % 2 = 1 THEN 'own' ELSE 'base' END AS name, CASE WHEN n_nationkey % 3 = 0 THEN 'late' ELSE 'base' END AS kind, n_regionkey AS region, 'none' AS missing FROM nation"""
)
def map_overrides(spark, sf):
    n = fx.table(spark, sf, "nation")
    base = F.create_map(F.lit("name"), F.lit("base"), F.lit("kind"), F.lit("base"), F.lit("region"), F.col("n_regionkey").cast("string"))
    own = F.when(F.col("n_nationkey") % 2 == 1, F.create_map(F.lit("name"), F.lit("own")))
    late = F.when(F.col("n_nationkey") % 3 == 0, F.create_map(F.lit("kind"), F.lit("late")))
    merged = n.select(F.col("n_nationkey").alias("nation"), F.create_map(F.lit("settings"), nested.overridden(base, own, late)).alias("m"))
    of = lambda k, d=None: nested.nested(F.col("m"), "settings", k, default=d)
    return merged.select("nation", of("name").alias("name"), of("kind").alias("kind"), of("region").cast("int").alias("region"), of("absent", "none").alias("missing"))


@query(
    """SELECT source AS key, CAST(i - 1 AS BIGINT) AS line, value FROM (SELECT source, generate_subscripts(ls, 1) AS i, unnest(ls) AS value, len(ls) AS n
    FROM (SELECT source, string_split(string_agg(text, '' ORDER BY doc_id), chr(10)) AS ls FROM documents WHERE source IS NOT NULL GROUP BY source)) WHERE i < n OR value <> ''"""
)
def joined_lines(spark, sf):
    d = fx.table(spark, sf, "documents").where("source is not null and text is not null")
    return texts.joined_lines(d.select(F.col("source").alias("key"), F.col("doc_id").alias("seq"), F.col("text").alias("value")))


# ---- the extractions from end to end


def _project(spark, sf) -> pipelines.Project:
    c = fx.candidates(spark, sf)
    path = F.concat(F.lit("/v/"), F.col("ord").cast("string"), F.lit(".mp4"))
    nothing = fx.human(spark, sf).where("false").select(F.lit(0).cast("long").alias("video"), "image", "x", "y")
    disk = c.where("existing > 0").select("video", F.explode(F.sequence(F.lit(1).cast("long"), F.col("existing").cast("long"))).alias("image"))
    machine = c.where("ord % 7 = 0").select("video", F.lit(0).alias("iteration"), F.lit(1).cast("long").alias("image"))
    counts = c.select("video", (F.col("ord") % 40 + 5).cast("long").alias("frame_count"))
    return pipelines.Project(c.select("video", "ord", path.alias("path"), "group"), fx.pred(spark, sf), nothing, machine, nothing, disk, counts)


@query("""SELECT video, 'ok' AS status, least(cap, ord % 40 + 5) AS written FROM candidates WHERE cap > 0 AND ord % 7 <> 0""", "candidates")
def frame_extraction_run(spark, sf):
    return pipelines.extract_frames(_project(spark, sf), ceiling=20).outcomes


@query(
    """SELECT c.o_orderkey AS video, CASE WHEN p.video IS NULL THEN 'not_analyzed' WHEN o.n IS NULL THEN 'error' ELSE 'ok' END AS status, least(coalesce(o.n, 0), 3) AS written FROM orders c
    LEFT JOIN (SELECT DISTINCT video FROM pred) p ON p.video = c.o_orderkey LEFT JOIN (SELECT video, count(*) AS n FROM outliers GROUP BY video) o ON o.video = c.o_orderkey""",
    "outliers",
)
def outlier_extraction_run(spark, sf):
    return pipelines.extract_outliers(_project(spark, sf), frames_per_video=3).outcomes


@query("SELECT c_nationkey AS project, count(DISTINCT c_custkey % 3) = 1 AS fixed FROM customer GROUP BY c_nationkey")
def input_size_fixed(spark, sf):
    c = fx.table(spark, sf, "customer").select(F.col("c_nationkey").alias("project"), (F.col("c_custkey") % 3 + 640).alias("width"), F.lit(480).alias("height"))
    return reconcile.input_size_fixed(c, "project")


@query("SELECT video % 10 AS epoch, bodypart AS name, round(avg(x), 6) AS value FROM pred GROUP BY ALL", "pred")
def epoch_metric_means(spark, sf):
    m = fx.pred(spark, sf).select((F.col("video") % 10).alias("epoch"), F.col("bodypart").alias("name"), F.col("x").alias("value"))
    return _rounded(evaluate.epoch_metric_means(m), "value")


@query(
    f""", m AS (SELECT o_custkey AS epoch, o_orderkey AS ord, (ARRAY['losses/', 'metrics/test.', 'other/'])[CAST(1 + o_orderkey % 3 AS INTEGER)] || o_orderkey AS name, o_totalprice AS value FROM orders),
    r AS (SELECT *, row_number() OVER (PARTITION BY epoch ORDER BY CASE WHEN name LIKE 'metrics/%' THEN 0 ELSE 1 END, ord) AS place FROM m WHERE name NOT LIKE 'other/%')
    SELECT epoch, CAST(place AS INTEGER) AS place, name, value FROM r WHERE place <= 3""",
    "disk_frames",
)
def metric_priority_top3(spark, sf):
    o = fx.table(spark, sf, "orders")
    prefix = F.get(F.array(F.lit("losses/"), F.lit("metrics/test."), F.lit("other/")), (F.col("o_orderkey") % 3).cast("int"))
    m = o.select(F.col("o_custkey").alias("epoch"), F.col("o_orderkey").alias("ord"), F.concat(prefix, F.col("o_orderkey").cast("string")).alias("name"), F.col("o_totalprice").alias("value"))
    return evaluate.metric_priority_top(m, ("metrics/", "losses/"), 3)


# ---- progress and outcomes


@query(
    """SELECT count(*) FILTER (o_orderstatus = 'F') AS ok, count(*) FILTER (o_orderstatus = 'O') AS not_analyzed, count(*) FILTER (o_orderstatus = 'P') AS errors,
    CAST(coalesce(sum(o_custkey % 9) FILTER (o_orderstatus = 'F'), 0) AS BIGINT) AS written FROM orders"""
)
def run_status_rollup(spark, sf):
    status = F.when(F.col("o_orderstatus") == "F", "ok").when(F.col("o_orderstatus") == "O", "not_analyzed").otherwise("error")
    return reconcile.run_status_rollup(fx.table(spark, sf, "orders").select(status.alias("status"), (F.col("o_custkey") % 9).alias("written")))


@query(
    """SELECT o_orderkey AS key, CASE WHEN o_orderkey % 5 = 1 THEN 'never claimed' WHEN o_custkey % 3 = 1 THEN 'lost with its worker' ELSE 'claimed' END AS state FROM orders WHERE o_orderkey % 2 = 1"""
)
def unreported_work(spark, sf):
    o = fx.table(spark, sf, "orders")
    items, results = o.select(F.col("o_orderkey").alias("key")), o.where("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("key"))
    claims = o.where("o_orderkey % 5 <> 1").select(F.col("o_orderkey").alias("key"), F.col("o_custkey").alias("worker"))
    exits = o.select(F.col("o_custkey").alias("worker")).distinct().where("worker % 3 <> 0").withColumn("code", F.when(F.col("worker") % 3 == 1, -9).otherwise(0))
    return reconcile.unreported_work(items, claims, results, exits)


@query(
    """, l AS (SELECT key, coalesce(arg_max(count, seq) FILTER (kind = 'progress'), 0) AS latest, bool_or(kind = 'done') AS done FROM msgs GROUP BY key)
    SELECT CAST(least(sum(latest), 1000000) AS BIGINT) AS frames, CAST(1000000 AS BIGINT) AS total, count(*) FILTER (done) AS units_done FROM l""",
    "msgs",
)
def progress_snapshot(spark, sf):
    return progress.progress_snapshot(fx.messages(spark, sf), 1_000_000)


@query(
    """, u AS (SELECT key, bool_or(kind = 'done') AS done FROM msgs GROUP BY key) SELECT key % 20 AS video, count(*) AS units, count(*) FILTER (NOT done) AS remaining, bool_and(done) AS complete FROM u GROUP BY ALL""",
    "msgs",
)
def video_completion(spark, sf):
    units = progress.latest_counts(fx.messages(spark, sf)).select((F.col("key") % 20).alias("video"), "key", "done")
    return progress.video_completion(units)


@query(
    """SELECT key, since, silence FROM (SELECT key, ts AS since, (epoch_us(lead(ts) OVER (PARTITION BY key ORDER BY ts, seq)) - epoch_us(ts)) / 1000000.0::DOUBLE AS silence FROM msgs) WHERE silence >= 1200""",
    "msgs",
)
def stalled_keys(spark, sf):
    return progress.stalled_keys(fx.messages(spark, sf), 1200.0)


@query(
    """, i AS (SELECT user_id AS key, rn + 1 AS item, count(*) OVER (PARTITION BY user_id) AS total FROM e) SELECT key, item, total FROM i WHERE item % greatest(1, least(total // 100, 250)) = 0 OR item = total""",
    "e",
)
def throttled_updates(spark, sf):
    from pyspark.sql import Window as W

    items = fx.pred1(spark, sf).select(F.col("video").alias("key"), (F.col("frame") + 1).alias("item"), F.count("*").over(W.partitionBy("video")).alias("total"))
    return progress.throttled_updates(items)


@query(
    """SELECT event_id, CASE WHEN s < 3600 THEN printf('%02d:%02d', s // 60, s % 60) ELSE printf('%d:%02d:%02d', s // 3600, s // 60 % 60, s % 60) END AS elapsed FROM (SELECT event_id, event_id * 7 % 20000 AS s FROM events)"""
)
def duration_format(spark, sf):
    return fx.table(spark, sf, "events").select("event_id", texts.format_duration(F.col("event_id") * 7 % 20000).alias("elapsed"))


@query(
    """SELECT o_orderkey AS key, CAST(floor(least(greatest(d / t, 0), 1) * 100) AS INTEGER) AS percent, CASE WHEN d = 0 THEN '--:--' ELSE printf('%02d:%02d', CAST(floor((t - d) * 60 / d) AS BIGINT) // 60, CAST(floor((t - d) * 60 / d) AS BIGINT) % 60) END AS eta,
    '01:00' AS elapsed_text FROM (SELECT o_orderkey, (o_custkey % 50)::DOUBLE AS d, 60::DOUBLE AS t FROM orders)"""
)
def progress_eta(spark, sf):
    o = fx.table(spark, sf, "orders").select(F.col("o_orderkey").alias("key"), (F.col("o_custkey") % 50).cast("double").alias("done"), F.lit(60.0).alias("total"), F.lit(60.0).alias("elapsed"))
    return progress.progress_lines(o)


@query(
    """SELECT n_nationkey AS nation, v AS variant FROM (SELECT n_nationkey, 10 + n_nationkey // 8 AS major, n_nationkey % 8 AS minor FROM nation), LATERAL (SELECT max(m || '.' || k) AS v FROM (VALUES (11, 8), (12, 1), (12, 4)) p(m, k)
    WHERE (m, k) <= (major, minor))"""
)
def version_floor(spark, sf):
    n = fx.table(spark, sf, "nation").select("n_nationkey", texts.parse_version(F.concat_ws(".", (F.lit(10) + F.floor(F.col("n_nationkey") / 8)).cast("string"), (F.col("n_nationkey") % 8).cast("string"))).alias("bound"))
    published = spark.createDataFrame([("cu118",), ("cu121",), ("cu124",)], "tag string").select(texts.parse_version(F.col("tag")).alias("version"))
    found = reconcile.version_floor(published, n.select("bound").distinct())
    return n.join(found, "bound").select(F.col("n_nationkey").alias("nation"), texts.format_version(F.col("variant")).alias("variant"))


@query("SELECT doc_id FROM documents WHERE NOT contains(text, 'Licensed under')")
def line_filter(spark, sf):
    return fx.table(spark, sf, "documents").where(texts.without_marker(F.col("text"), "Licensed under")).select("doc_id")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)
