"""Predictions against ground truth."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.numbers import euclidean, finite, is_finite
from ..runtime import computed_once


def surviving_individuals(truth: DataFrame) -> DataFrame:
    """(image, individual) with at least one keypoint that is visible (v > 0) and has both coordinates."""
    seen = (F.col("v") > 0) & is_finite(F.col("gt_x")) & is_finite(F.col("gt_y"))
    return truth.groupBy("image", "individual").agg(F.bool_or(seen).alias("survives")).where("survives").select("image", "individual")


def joined_truth(predictions: DataFrame, truth: DataFrame) -> DataFrame:
    """Predicted keypoints (image, individual, bodypart, ...) beside their truth, of the images that both sides have; images of one side
    only are dropped. A keypoint without a truth has null coordinates there, and truths without a prediction give no row."""
    both = predictions.join(truth.select("image").distinct(), "image", "left_semi")
    return both.join(truth, ["image", "individual", "bodypart"], "left")


def named_keypoint_metrics(metrics: DataFrame, bodyparts: DataFrame) -> DataFrame:
    """(bodypart, rmse) from metrics (name, value) called rmse_keypoint_<i>, where i is the bodypart's ord; missing values are left out."""
    i = F.regexp_extract("name", r"^rmse_keypoint_(\d+)$", 1).try_cast("long")
    known = metrics.select(i.alias("ord"), F.col("value").alias("rmse")).where(F.col("ord").isNotNull() & is_finite(F.col("rmse")))
    return known.join(bodyparts.select(F.col("ord").cast("long").alias("ord"), "bodypart"), "ord").select("bodypart", "rmse")


def chosen_snapshot(snapshots: DataFrame, index: int | str = -1) -> DataFrame:
    """(epoch, path) of one snapshot of (epoch, path, best): by its place in the order of epochs, from the end if negative, or the best
    one; where no snapshot is marked best, the last. No row if there is none."""
    best = F.col("best").cast("int") if index == "best" else F.lit(0)
    back = index == "best" or index < 0
    place = W.orderBy(best.desc(), F.col("epoch").desc()) if back else W.orderBy("epoch")
    wanted = 1 if index == "best" else -index if back else index + 1
    return snapshots.withColumn("place", F.row_number().over(place)).where(F.col("place") == wanted).select("epoch", "path")


def evaluation_tidy(joined: DataFrame, cutoff: float = 0.6) -> DataFrame:
    """One row per predicted keypoint of an image that both sides have: error_px is the distance to a visible truth, NaN otherwise;
    above_pcutoff includes the cutoff itself. Expects image, video, split, individual, bodypart, x, y, likelihood, gt_x, gt_y, v."""
    seen = F.coalesce((F.col("v") > 0) & is_finite(F.col("gt_x")) & is_finite(F.col("gt_y")), F.lit(False))
    nan = F.lit(float("nan"))
    return joined.select(
        "split", "video", "image", "individual", "bodypart", F.col("x").alias("pred_x"), F.col("y").alias("pred_y"), F.col("likelihood").alias("pred_likelihood"),
        F.when(seen, F.col("gt_x")).otherwise(nan).alias("gt_x"), F.when(seen, F.col("gt_y")).otherwise(nan).alias("gt_y"),
        F.when(seen, euclidean(F.col("x") - F.col("gt_x"), F.col("y") - F.col("gt_y"))).otherwise(nan).alias("error_px"),
        (F.col("likelihood") >= cutoff).alias("above_pcutoff"), seen.alias("matched"),
    )


def split_metrics(tidy: DataFrame) -> DataFrame:
    """(split, images, rmse_px, rmse_px_above): 'rmse' is the mean error, as the field is called by convention."""
    error = finite(F.col("error_px"))
    return tidy.groupBy("split").agg(F.countDistinct("image").alias("images"), F.avg(error).alias("rmse_px"), F.avg(F.when(F.col("above_pcutoff"), error)).alias("rmse_px_above"))


def generalization_gap(tidy: DataFrame) -> DataFrame:
    error = finite(F.col("error_px"))
    return tidy.agg((F.avg(F.when(F.col("split") == "test", error)) - F.avg(F.when(F.col("split") == "train", error))).alias("gap"))


def keypoint_errors(tidy: DataFrame) -> DataFrame:
    return tidy.groupBy("bodypart").agg(F.avg(finite(F.col("error_px"))).alias("rmse"))


def worst_keypoints(errors: DataFrame, count: int = 5) -> DataFrame:
    """(bodypart, rmse): the largest errors, rounded half to even at 3 digits, without missing ones; ties by bodypart."""
    known = errors.where(is_finite(F.col("rmse")))
    return known.orderBy(F.col("rmse").desc(), "bodypart").limit(count).select("bodypart", F.bround("rmse", 3).alias("rmse"))


def unmatched_images(tidy: DataFrame) -> DataFrame:
    """One row: images without any matched row."""
    return tidy.groupBy("image").agg(F.bool_or("matched").alias("any")).agg(F.count(F.when(~F.col("any"), 1)).alias("unmatched"))


def instance_names(rows: DataFrame, matched: str = "name") -> DataFrame:
    """Names individuals without a match instance_<i>, i counting the image's individuals from 0."""
    i = F.row_number().over(W.partitionBy("image").orderBy("individual")) - 1
    return rows.withColumn("name", F.coalesce(F.col(matched), F.concat(F.lit("instance_"), i.cast("string"))))


def identity_by_pose(prepared: DataFrame, truth: DataFrame) -> DataFrame:
    """Names the individuals of a prepared truth by equal coordinates, where missing equals missing."""
    same = (prepared["image"] == truth["image"]) & prepared["pose"].eqNullSafe(truth["pose"])
    return prepared.join(truth.select("image", "pose", "name"), same, "left").select(prepared["*"], truth["name"])


def oks(pred: np.ndarray, truth: np.ndarray, sigma: float = 0.1) -> float:
    """Object keypoint similarity of (keypoints, 2) and (keypoints, 3 with visibility); NaN without a visible keypoint."""
    seen = (truth[:, 2] > 0) & np.isfinite(truth[:, :2]).all(axis=1)
    if not seen.any():
        return float("nan")
    own = truth[seen, :2]
    area = max(float(np.prod(own.max(axis=0) - own.min(axis=0))), 1.0)
    gaps = ((pred[seen, :2] - own) ** 2).sum(axis=1)
    gaps = np.where(np.isfinite(gaps), gaps, np.inf)
    return float(np.exp(-gaps / (2 * area * (2 * sigma) ** 2)).mean())


def greedy_matches(predicted: list[np.ndarray], scores: list[float], truth: list[np.ndarray]) -> list[tuple[int, int, float]]:
    """(prediction, truth, similarity): predictions by falling score take the most similar truth that is left."""
    free, found = set(range(len(truth))), []
    for i in sorted(range(len(predicted)), key=lambda i: -scores[i]):
        options = [(oks(predicted[i], truth[j]), -j) for j in free]
        options = [o for o in options if o[0] == o[0]]
        if options:
            similarity, j = max(options)
            free.discard(-j)
            found.append((i, -j, similarity))
    return found


def _dense(points: Column, parts: Column) -> Column:
    """The point of each bodypart in `parts`, null where there is none; of several the first."""
    return F.transform(parts, lambda part: F.get(points, F.array_position(points["part"], part).cast("int") - 1))


def _shape(points: Column) -> Column:
    """The visible keypoints of a true individual with their places, and the spread of its similarity; null without a visible one."""
    own = F.filter(
        F.transform(points, lambda q, i: F.struct(i.alias("at"), q["gt_x"].alias("x"), q["gt_y"].alias("y"), q["seen"].alias("seen"))),
        lambda q: F.coalesce(q["seen"], F.lit(False)),
    )
    return F.when(F.size(own) > 0, own)


def _area(own: Column) -> Column:
    sides = [F.array_max(own[c]) - F.array_min(own[c]) for c in ("x", "y")]
    return F.greatest(sides[0] * sides[1], F.lit(1.0))


def _similarity(points: Column, truth: Column) -> Column:
    """`oks` in Spark: NaN where it is NaN there."""

    def gap(q: Column) -> Column:
        p = F.get(points, q["at"])
        dx, dy = p["x"] - q["x"], p["y"] - q["y"]
        return F.nanvl(F.coalesce(dx * dx + dy * dy, F.lit(float("inf"))), F.lit(float("inf")))

    total = F.aggregate(truth["own"], F.lit(0.0), lambda s, q: s + F.exp(-gap(q) / truth["spread"]))
    return total / F.size(truth["own"])


def _greedy(ranked: Column, truths: Column) -> Column:
    """`greedy_matches` in Spark: (place of the individual, similarity or null) for each of `ranked`."""
    free = F.sequence(F.lit(0), F.size(truths) - 1)
    start = F.struct(
        F.when(F.size(truths) > 0, free).otherwise(F.array().cast("array<int>")).alias("free"),
        F.array().cast("array<struct<place:int,oks:double>>").alias("found"),
    )

    def step(state: Column, one: Column) -> Column:
        options = F.transform(state["free"], lambda j: F.struct(_similarity(one["points"], F.get(truths, j)).alias("oks"), (-j).alias("back")))
        best = F.array_max(F.filter(options, lambda o: ~F.isnan(o["oks"])))
        # in an array of one, so that it is computed once for its two uses
        taken = F.transform(
            F.array(best),
            lambda b: F.struct(
                F.filter(state["free"], lambda j: F.coalesce(j != -b["back"], F.lit(True))).alias("free"),
                F.array_append(state["found"], F.struct(one["place"].alias("place"), b["oks"].alias("oks"))).alias("found"),
            ),
        )
        return F.get(taken, F.lit(0))

    return F.aggregate(ranked, start, step, lambda state: state["found"])


def image_matches(rows: DataFrame, sigma: float = 0.1) -> DataFrame:
    """(image, individual, score, oks, truths): predicted individuals of long rows matched to the true ones, image by image. An individual
    without a match has a null oks; truths counts the image's true individuals. Rows without an individual belong to none; of several rows
    of a keypoint the least counts. Everything runs in Spark's expressions after one exchange by image: there are about as many images as
    rows, too many for a call of Python each."""
    seen = (F.col("v") > 0) & is_finite(F.col("gt_x")) & is_finite(F.col("gt_y")) & (F.abs("gt_x") < math.inf) & (F.abs("gt_y") < math.inf)
    point = F.struct(
        F.struct("bodypart").alias("part"), *(F.col(c).cast("double").alias(c) for c in ("x", "y", "gt_x", "gt_y")), F.coalesce(seen, F.lit(False)).alias("seen"),
        finite(F.col("likelihood").cast("double")).alias("likelihood"),
    )
    each = rows.where(F.col("individual").isNotNull()).repartition("image").groupBy("image", "individual").agg(F.array_sort(F.collect_list(point)).alias("points"))
    held = F.filter(F.col("points")["likelihood"], lambda v: v.isNotNull())
    score = finite(F.try_divide(F.aggregate(held, F.lit(0.0), lambda s, v: s + v), F.size(held)))
    person = F.struct("individual", score.alias("score"), "points")
    people = computed_once(each.groupBy("image").agg(F.array_sort(F.collect_list(person)).alias("people")))

    parts = F.array_sort(F.array_distinct(F.flatten(F.transform("people", lambda p: p["points"]["part"]))))
    people = computed_once(people.withColumn("parts", parts))
    people = computed_once(people.select("image", "people", F.transform("people", lambda p: _dense(p["points"], F.col("parts"))).alias("dense")))
    own = F.filter(F.transform("dense", _shape), lambda t: t.isNotNull())
    ranked = F.transform(
        F.arrays_zip(F.col("people")["score"].alias("score"), "dense"),
        lambda p, i: F.struct(p["score"].isNull().alias("last"), (-p["score"]).alias("down"), i.alias("place"), p["dense"].alias("points")),
    )
    people = computed_once(people.select("image", "people", own.alias("own"), F.array_sort(ranked).alias("ranked")))
    spread = lambda own: F.lit(2.0) * _area(own) * F.lit((2 * sigma) ** 2)
    truths = F.transform("own", lambda own: F.struct(own.alias("own"), spread(own).alias("spread")))
    people = computed_once(people.select("image", "people", truths.alias("shapes"), "ranked"))
    people = computed_once(people.select("image", "people", F.size("shapes").cast("long").alias("truths"), F.array_sort(_greedy(F.col("ranked"), F.col("shapes"))).alias("found")))
    names = [F.col("people")["individual"].alias("individual"), F.col("people")["score"].alias("score"), F.col("found")["oks"].alias("oks")]
    matched = people.select("image", "truths", F.explode(F.arrays_zip(*names)).alias("m"))
    return matched.select("image", "m.individual", "m.score", "m.oks", "truths")


def average_precision(matches: DataFrame, thresholds: tuple[float, ...] = tuple(0.5 + 0.05 * i for i in range(10)), bins: int = 1000) -> DataFrame:
    """One row (map, mar): mean over similarity thresholds of the 101-point precision, and of the recall, exact over all distinct scores;
    equal scores are ranked together. Running sums and maxima along the scores are taken within `bins` parts of them first and then over
    the parts, so no task holds all scores."""
    truths = matches.groupBy("image").agg(F.max("truths").alias("t")).agg(F.coalesce(F.sum("t"), F.lit(0)).alias("total"))
    hits = F.array(*(F.struct(F.lit(t).alias("at"), (F.coalesce("oks", F.lit(0.0)) >= t).cast("long").alias("hit")) for t in thresholds))
    each = matches.select("score", F.explode(hits).alias("h")).groupBy("score", F.col("h.at").alias("at")).agg(F.sum("h.hit").alias("hits"), F.count("*").alias("n"))
    each = each.withColumn("bin", F.least(F.floor(F.col("score") * bins), F.lit(bins - 1)).cast("int"))

    inside = W.partitionBy("at", "bin")
    down, all_rows = inside.orderBy(F.col("score").desc()).rowsBetween(W.unboundedPreceding, 0), W.partitionBy("at")
    sums = each.groupBy("at", "bin").agg(F.sum("hits").alias("h"), F.sum("n").alias("m"))
    above = all_rows.orderBy(F.col("bin").desc())
    sums = sums.select("at", "bin", (F.sum("h").over(above) - F.col("h")).alias("h0"), (F.sum("m").over(above) - F.col("m")).alias("m0"))
    curve = each.select("at", "bin", "score", F.sum("hits").over(down).alias("tp"), F.sum("n").over(down).alias("seen")).join(F.broadcast(sums), ["at", "bin"])
    curve = curve.crossJoin(F.broadcast(truths)).select(
        "at", "bin", "score", ((F.col("tp") + F.col("h0")) / (F.col("seen") + F.col("m0"))).alias("precision"), F.try_divide(F.col("tp") + F.col("h0"), F.col("total")).alias("recall")
    )
    # the best precision at this recall or a higher one, which lies at this score or a lower one
    tops = curve.groupBy("at", "bin").agg(F.max("precision").alias("top"))
    tops = tops.select("at", "bin", F.max("top").over(all_rows.orderBy("bin").rowsBetween(W.unboundedPreceding, -1)).alias("below"))
    up = inside.orderBy("score").rowsBetween(W.unboundedPreceding, 0)
    curve = curve.withColumn("own", F.max("precision").over(up)).join(F.broadcast(tops), ["at", "bin"])
    curve = curve.withColumn("best", F.greatest("own", F.coalesce("below", F.lit(0.0))))
    # a point of the curve serves the recall levels r / 100 that it reaches; of those that serve a level the best is the first
    levels = curve.groupBy("at", F.least(F.floor(F.col("recall") * 100 + 1e-9), F.lit(100)).cast("int").alias("level")).agg(F.max("best").alias("best"), F.max("recall").alias("recall"))
    by = levels.groupBy("at").agg(F.max("recall").alias("recall"), F.collect_list(F.struct("level", "best")).alias("points"))
    at_recall = F.transform(F.sequence(F.lit(0), F.lit(100)), lambda r: F.coalesce(F.array_max(F.transform(F.filter("points", lambda p: p["level"] >= r), lambda p: p["best"])), F.lit(0.0)))
    return by.select("recall", (F.aggregate(at_recall, F.lit(0.0), lambda s, v: s + v) / 101).alias("ap")).agg(F.avg("ap").alias("map"), F.avg("recall").alias("mar"))


def epoch_metric_means(metrics: DataFrame) -> DataFrame:
    """(epoch, name, value): means without missing values, NaN where all are missing."""
    return metrics.groupBy("epoch", "name").agg(F.coalesce(F.avg(finite(F.col("value"))), F.lit(float("nan"))).alias("value"))


def metric_priority_top(metrics: DataFrame, prefixes: tuple[str, ...], count: int = 3) -> DataFrame:
    """Per epoch the first `count` metrics by the priority of their prefix, then by ord; others and missing values are left out."""
    rank = F.lit(None).cast("int")
    for i, prefix in reversed(list(enumerate(prefixes))):
        rank = F.when(F.col("name").startswith(prefix), F.lit(i)).otherwise(rank)
    known = metrics.withColumn("priority", rank).where(F.col("priority").isNotNull() & is_finite(F.col("value")))
    place = F.row_number().over(W.partitionBy("epoch").orderBy("priority", "ord"))
    return known.withColumn("place", place).where(F.col("place") <= count).select("epoch", "place", "name", "value")
