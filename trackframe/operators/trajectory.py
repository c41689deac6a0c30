"""Departures of keypoints from a fitted trajectory.

`ar1_deviation` fits x[t] = a + b * x[t-1] by least squares in closed form, natively. `arma_deviation` fits ARMA(p, q) per keypoint
and axis by the Hannan-Rissanen regressions and filters one step ahead, carrying its own prediction through rows without confidence;
its numbers are those of this estimator, not of a maximum-likelihood fit. Rows without confidence leave the fit and the filter only:
every row with coordinates has its distance from the fit, or an unlikely and far position could not be flagged.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.numbers import euclidean, finite
from ..runtime import ship
from .detect import deviation_outliers, nanmean_deviation

_KEY = ("video", "individual", "bodypart")


def ar1_deviation(predictions: DataFrame, minimum_confidence: float = 0.01) -> DataFrame:
    """(video, individual, bodypart, frame, deviation) from first-order fits over pairs of neighbouring confident rows. Each row is held
    against the fit from the last confident row before it; null where there is none and where no line can be fitted."""
    confident = F.coalesce(finite(F.col("likelihood")) >= minimum_confidence, F.lit(False))
    order = W.partitionBy(*_KEY).orderBy("frame")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    last = lambda c: F.last(F.when(confident, finite(F.col(c))), ignorenulls=True).over(before)
    rows = predictions.select(
        *_KEY, "frame", (confident & F.lag(confident, 1, False).over(order)).alias("fits"), *(finite(F.col(c)).alias(c) for c in "xy"), *(last(c).alias(f"{c}0") for c in "xy")
    )
    own = lambda c: F.when(F.col("fits"), F.col(c))
    fits = rows.groupBy(*_KEY).agg(*(f(own(c), own(f"{c}0")).alias(f"{c}{n}") for c in "xy" for n, f in (("b", F.regr_slope), ("a", F.regr_intercept))))
    joined = rows.join(fits, list(_KEY))
    gap = {c: F.col(c) - (F.col(f"{c}a") + F.col(f"{c}b") * F.col(f"{c}0")) for c in "xy"}
    return joined.select(*_KEY, "frame", euclidean(gap["x"], gap["y"]).alias("deviation"))


def arma_residuals(series: np.ndarray, confident: np.ndarray, p: int, q: int) -> np.ndarray:
    """Observed minus fitted positions of one axis, NaN where nothing was observed; NaN everywhere if the fit fails. Rows that aren't
    confident take no part in the fit. A pure function of its arguments."""
    n, good = len(series), confident & np.isfinite(series)
    try:
        if good.sum() < 3 * (p + q + 1):
            raise ValueError("too few confident rows")
        x = np.interp(np.arange(n), np.flatnonzero(good), series[good])
        mean = x[good].mean()
        x = x - mean
        lags = lambda v, k: np.column_stack([v[k - 1 - i : len(v) - 1 - i] for i in range(k)])
        long = min(max(p, q) + 4, n // 4)
        first = lags(x, long)
        shocks = np.zeros(n)
        shocks[long:] = x[long:] - first @ np.linalg.lstsq(first, x[long:], rcond=None)[0]
        at = long + q
        design = np.column_stack([x[at - 1 - i : n - 1 - i] for i in range(p)] + [shocks[at - 1 - i : n - 1 - i] for i in range(q)])
        weights = np.linalg.lstsq(design, x[at:], rcond=None)[0]
        past, errors, out = np.zeros(p), np.zeros(q), np.empty(n)
        for t in range(n):
            predicted = past @ weights[:p] + errors @ weights[p:]
            seen = x[t] if good[t] else predicted
            out[t] = series[t] - mean - predicted
            past = np.concatenate(([seen], past[:-1])) if p else past
            errors = np.concatenate(([seen - predicted], errors[:-1])) if q else errors
        return out
    except (ValueError, np.linalg.LinAlgError):
        return np.full(n, np.nan)


def arma_deviation(predictions: DataFrame, p: int = 3, q: int = 1, minimum_confidence: float = 0.01) -> DataFrame:
    """(video, individual, bodypart, frame, deviation), one fit a keypoint in parallel; a failed fit gives NaN for all its frames."""

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("frame", kind="stable")
        confident = (pdf["likelihood"] >= minimum_confidence).to_numpy()
        dx, dy = (arma_residuals(pdf[c].to_numpy(dtype=float), confident, p, q) for c in ("x", "y"))
        return pdf[[*_KEY, "frame"]].assign(deviation=np.sqrt(dx * dx + dy * dy))

    ship(predictions.sparkSession)
    rows = predictions.select(*_KEY, "frame", "x", "y", "likelihood")
    schema = rows.select(*_KEY, "frame", F.col("x").cast("double").alias("deviation")).schema
    return rows.groupBy(*_KEY).applyInPandas(fit, schema)


def fitting_outliers(
    predictions: DataFrame, frames_per_video: int = 20, pixel_distance: float = 20.0, minimum_confidence: float = 0.01,
    autoregressive_degree: int = 3, moving_average_degree: int = 1, index_base: str = "position",
) -> DataFrame:
    """(video, frame) of the fitted detector. Its indices are positions in the window; `index_base` 'label' gives frames instead."""
    deviations = nanmean_deviation(arma_deviation(predictions, autoregressive_degree, moving_average_degree, minimum_confidence))
    positions = deviations.withColumn("label", F.col("frame")).withColumn("frame", F.row_number().over(W.partitionBy("video").orderBy("frame")).cast("long") - 1)
    found = deviation_outliers(positions, frames_per_video, pixel_distance).select("video", F.col("position").alias("frame"))
    return found if index_base == "position" else found.join(positions.select("video", "frame", "label"), ["video", "frame"]).select("video", F.col("label").alias("frame"))
