"""Choice of frames among candidates."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..runtime import ship


def uniform_selection(candidates: DataFrame, count: int) -> DataFrame:
    """`count` candidates of each video, evenly spread over their ranks floor(i * (n - 1) / (count - 1)); all where there are no more."""
    of_video = W.partitionBy("video")
    ranked = candidates.select("video", "frame", (F.row_number().over(of_video.orderBy("frame")) - 1).cast("long").alias("rank"), F.count("*").over(of_video).alias("n"))
    # rank r is picked when some i has i * (n - 1) div (count - 1) = r: the least i with i * (n - 1) >= r * (count - 1)
    k, m = F.lit(count - 1).cast("long"), F.col("n") - 1
    least = F.expr(f"(rank * {count - 1} + n - 2) div greatest(n - 1, 1)") if count > 1 else F.lit(0).cast("long")
    picked = (least <= k) & (F.floor(least * m / F.greatest(k, F.lit(1).cast("long"))) == F.col("rank")) if count > 1 else F.col("rank") == 0
    return ranked.where((F.col("n") <= count) | picked).select("video", "frame")


def uniform_counts(candidates: DataFrame, counts: DataFrame) -> DataFrame:
    """Like `uniform_selection` with a number of its own for each video of `counts` (video, picks); other videos give none."""
    of_video = W.partitionBy("video")
    ranked = candidates.join(counts.select("video", "picks"), "video").select(
        "video", "frame", "picks", (F.row_number().over(of_video.orderBy("frame")) - 1).cast("long").alias("rank"), F.count("*").over(of_video).alias("n")
    )
    least = F.expr("(rank * (picks - 1) + n - 2) div greatest(n - 1, 1)")
    picked = F.when(F.col("picks") == 1, F.col("rank") == 0).otherwise(
        (least <= F.col("picks") - 1) & (F.floor(least * (F.col("n") - 1) / F.greatest(F.col("picks") - 1, F.lit(1).cast("long"))) == F.col("rank"))
    )
    return ranked.where((F.col("n") <= F.col("picks")) | picked).select("video", "frame")


def kmeans(features: np.ndarray, clusters: int, batch: int, iterations: int, rng: np.random.Generator, tolerance: float = 1e-3) -> np.ndarray:
    """Mini-batch k-means; the cluster of each row. An iteration is a pass over all rows in random order; they end early once a
    pass moves the centers by no more than `tolerance` of the features' mean variance (squared distances, summed)."""
    centers = features[rng.choice(len(features), clusters, replace=False)].astype(float)
    seen = np.zeros(clusters)
    least = tolerance * features.var(axis=0).mean()
    for _ in range(iterations):
        before, order = centers.copy(), rng.permutation(len(features))
        for at in range(0, len(order), batch):
            rows = features[order[at : at + batch]]
            nearest = ((rows[:, None, :] - centers[None]) ** 2).sum(axis=2).argmin(axis=1) if rows.size * clusters < 5e7 else _nearest(rows, centers)
            for k in np.unique(nearest):
                own = rows[nearest == k]
                seen[k] += len(own)
                centers[k] += (own - centers[k]).sum(axis=0) / seen[k]
        if ((centers - before) ** 2).sum() <= least:
            break
    return _nearest(features, centers)


def _nearest(rows: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return (rows @ centers.T * -2 + (centers**2).sum(axis=1)).argmin(axis=1)


def kmeans_representatives(features: DataFrame, clusters: int, batch: int = 100, iterations: int = 50, seed: int = 0) -> DataFrame:
    """(video, frame): one random member of each cluster that isn't empty, per video of (video, frame, features). A video with fewer
    frames than clusters gives them all; a batch is at most half of the frames; `iterations` counts passes over all frames. Equal
    seeds give equal choices."""

    def pick(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("frame", kind="stable")
        frames = pdf["frame"].to_numpy()
        if len(frames) <= clusters:
            return pdf[["video", "frame"]]
        rng = np.random.default_rng([seed, *str(pdf["video"].iloc[0]).encode()])
        data = np.stack(pdf["features"].to_numpy()).astype(float)
        data -= data.mean(axis=0)
        size = batch if batch <= len(frames) else max(1, len(frames) // 2)
        labels = kmeans(data, clusters, size, iterations, rng)
        chosen = sorted(int(rng.choice(frames[labels == k])) for k in np.unique(labels))
        return pd.DataFrame({"video": [pdf["video"].iloc[0]] * len(chosen), "frame": chosen})

    ship(features.sparkSession)
    rows = features.select("video", "frame", "features")
    return rows.groupBy("video").applyInPandas(pick, rows.select("video", "frame").schema)


SELECTORS = {"uniform": lambda candidates, count, **_: uniform_selection(candidates, count), "kmeans": lambda candidates, count, **o: kmeans_representatives(candidates, count, **o)}
