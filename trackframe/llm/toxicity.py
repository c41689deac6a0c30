"""Toxicity by class-conditional Kneser-Ney models.

Each class (toxic, ordinary) has a model of words. As Kneser-Ney's lower orders do, it counts contexts rather than tokens: a word's
count is the number of distinct words it follows, so a passage that copies repeat weighs once. The discounted count backs off to
the word's expression, its first `PREFIX` bytes, counted by contexts in the class as well, and the expression backs off to counts
that both classes share; within an expression the shared counts tell words apart. So inflected and unseen forms of a telling word are
known by their expression, and a word of a few contexts says little.

Context counts level off as a sample grows, so two classes of different sizes would differ in common words already. The larger class
is therefore dealt into folds of the smaller one's size, each with a model of its own, and its probability is the mean of theirs.

A text's measure is the difference of the two log-likelihoods, normalised by length: the mean over its words of how much likelier (in
log) each is in toxic text, where differences of up to `MARGIN` count as none. A logistic curve fitted on rows that the counts did not
see turns that one number into a score between 0 and 1, without changing its order.

Fitting uses a bounded sample: at most `SAMPLES` labelled documents of each class, drawn by a hash of the id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import map_arrow
from .common import stage
from .hashing import NOT_WORD, U64, word_and_prefix_hashes

SAMPLES = 8192
PREFIX, MARGIN, RIDGE = 5, 1.5, 1e-3
#: What is taken off the context counts of words and of expressions.
DISCOUNTS = (2.0, 1.5)


def tokens(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words, free of punctuation, and of their expressions."""
    return word_and_prefix_hashes((text or "").lower(), PREFIX, NOT_WORD)


def bent(x):
    """Signed square root: measures near 0, where most texts lie, are told apart as well as large ones."""
    return np.sign(x) * np.sqrt(np.abs(x))


class Model:
    """words, parts: sorted hashes with how much likelier (log) each is in toxic text; other: the same for all other words. The score
    is the logistic function of slope * bent(measure) + constant."""

    def __init__(self, words, word_gain, parts, part_gain, other, slope=0.0, constant=0.0):
        self.words, self.word_gain, self.parts, self.part_gain, self.other = words, word_gain, parts, part_gain, other
        self.slope, self.constant = slope, constant

    def gains(self, text: str | None) -> np.ndarray:
        """How much likelier (log) each word of the text is in toxic text."""
        words, parts = tokens(text)
        found = np.full(len(words), self.other)
        for names, gain, own in ((self.parts, self.part_gain, parts), (self.words, self.word_gain, words)):
            if len(names) and len(own):
                at = np.minimum(np.searchsorted(names, own), len(names) - 1)
                found = np.where(names[at] == own, gain[at], found)
        return found

    def measure(self, text: str | None) -> float:
        gains = self.gains(text)
        beyond = np.sign(gains) * np.maximum(np.abs(gains) - MARGIN, 0)
        return float(beyond.mean()) if len(gains) else 0.0

    def score(self, text: str | None) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * bent(self.measure(text)) + self.constant, -30, 30))))


def calibrated(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope (not below 0) and constant of a weighted logistic curve, by Newton's method."""
    scale = float(np.abs(x).max()) or 1.0
    z = np.c_[x / scale, np.ones(len(x))]
    w, ridge = np.zeros(2), np.diag([RIDGE, 1e-6])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        hessian = (z * (weight * p * (1 - p))[:, None]).T @ z + ridge
        step = np.linalg.solve(hessian, z.T @ (weight * (p - y)) + ridge @ w)
        w -= step * min(1.0, 5 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-8:
            break
    return max(0.0, float(w[0])) / scale, float(w[1])


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct (word, expression, word before) of each text with the text's model."""
    for batch in batches:
        for text, own in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
            words, parts = tokens(text.as_py())
            if not len(words):
                continue
            rows = np.unique(np.stack((words, parts, np.concatenate(([U64(0)], words[:-1])))), axis=1).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(pa.array(c) for c in rows), pa.array(np.full(rows.shape[1], own, dtype=np.int32))], names=["word", "part", "left", "model"])


def constant(rate: float) -> Model:
    """A model that scores every text alike, for labels of one class or none."""
    none = np.zeros(0, dtype=U64)
    rate = min(max(rate, 1e-6), 1 - 1e-6)
    return Model(none, none, none, none, 0.0, 0.0, float(np.log(rate / (1 - rate))))


def _mass(counts: DataFrame, name: str, discount: float) -> dict[int, tuple[float, float]]:
    """By model: the total count and the share of it that the discount frees."""
    sums = counts.groupBy("model").agg(F.sum(name).alias("total"), F.sum(F.least(name, F.lit(discount))).alias("freed")).collect()
    return {r["model"]: (float(r["total"]), float(r["freed"]) / float(r["total"])) for r in sums}


def _spread(counts: DataFrame, key: list[str], name: str, discount: float, share: dict[int, float]) -> DataFrame:
    """By key: the discounted counts of model 0 and of all others (p0, p1), times `share` of their model, and the shared count."""
    value = F.greatest(F.col(name) - discount, F.lit(0.0)) * F.element_at(F.create_map(*(F.lit(v) for kv in share.items() for v in kv)), F.col("model"))
    own = F.col("model") == 0
    return counts.groupBy(*key).agg(F.sum(F.when(own, value).otherwise(0.0)).alias("p0"), F.sum(F.when(own, 0.0).otherwise(value)).alias("p1"), F.sum(name).alias("shared"))


def kneser_ney(texts: DataFrame) -> Model | None:
    """How much likelier words are in model 0 of `texts` (text, model) than in the mean of the models 1, 2, ..., the folds of the other
    class; None if either has no word."""
    pairs = stage(map_arrow(texts.select("text", "model"), _contexts, "word long, part long, left long, model int"), "toxicity-contexts")
    by_word = stage(pairs.groupBy("model", "word", "part").agg(F.countDistinct("left").alias("n")), "toxicity-words")
    by_part = stage(pairs.groupBy("model", "part").agg(F.countDistinct("left").alias("n")), "toxicity-parts")
    words, parts = _mass(by_word, "n", DISCOUNTS[0]), _mass(by_part, "n", DISCOUNTS[1])
    folds = {0: 1, **{m: len(words) - 1 for m in words if m}}
    if 0 not in words or len(words) < 2:
        return None
    word_share = {m: 1 / (folds[m] * words[m][0]) for m in words}
    part_share = {m: words[m][1] / (folds[m] * parts[m][0]) for m in words}
    freed = [sum(words[m][1] * parts[m][1] / folds[m] for m in words if (m == 0) == c) for c in (True, False)]

    low = _spread(by_part, ["part"], "n", DISCOUNTS[1], part_share).toArrow()
    shared = (low["shared"].to_numpy() + 0.5) / (low["shared"].to_numpy().sum() + 1)
    order = np.argsort(low["part"].to_numpy().view(U64))
    part_names = low["part"].to_numpy().view(U64)[order]
    part_p = [(low[c].to_numpy() + f * shared)[order] for c, f in zip(("p0", "p1"), freed, strict=True)]

    each = _spread(by_word, ["word", "part"], "n", DISCOUNTS[0], word_share)
    in_part = by_word.groupBy("part").agg(F.sum("n").alias("all"))
    known = each.where("p0 > 0 or p1 > 0").join(in_part, "part").toArrow()
    own = known["word"].to_numpy().view(U64)
    at = np.searchsorted(part_names, known["part"].to_numpy().view(U64))
    within = (known["shared"].to_numpy() + 0.5) / (known["all"].to_numpy() + 1)
    word_p = [known[c].to_numpy() + within * p[at] for c, p in zip(("p0", "p1"), part_p, strict=True)]
    order = np.argsort(own)
    return Model(own[order], np.log(word_p[0] / word_p[1])[order], part_names, np.log(part_p[0] / part_p[1]), float(np.log(freed[0] / freed[1])))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", toxic_col: str = "toxic") -> Model:
    """Learns from the rows of `labels` (id, 0 or 1) whose ids `docs` has. Null ids and labels are left out; an id with both labels is
    an example of both classes."""
    marked = labels.select(F.col(id_col).alias("id"), F.col(toxic_col).cast("int").alias("toxic")).where("id is not null and toxic in (0, 1)")
    slots = marked.groupBy("toxic", F.pmod(F.xxhash64("id"), F.lit(SAMPLES)).alias("slot")).agg(F.min("id").alias("id"), F.count("*").alias("n"))
    drawn = [tuple(r) for r in slots.select("id", "toxic", "n").collect()]
    sizes = [sum(n for _, t, n in drawn if t == c) for c in (0, 1)]
    if not all(sizes):
        return constant(float(sizes[1] > 0))
    picked = docs.sparkSession.createDataFrame([d[:2] for d in drawn], ["id", "toxic"]).withColumn("toxic", F.col("toxic").cast("int"))
    own = docs.select(F.col(id_col).alias("own_id"), F.col(text_col).alias("text"))
    sample = own.join(F.broadcast(picked), F.col("own_id") == F.col("id")).select("id", "toxic", "text")
    sample = stage(sample.withColumn("use", F.pmod(F.xxhash64("text"), F.lit(4))), "toxicity-sample")

    seen = sample.where("use <> 0").select("text", "toxic").distinct()
    n = {r["toxic"]: r["n"] for r in seen.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(n) < 2:
        return constant(sizes[1] / sum(sizes))
    larger = max(n, key=lambda c: (n[c], c == 0))
    folds = max(1, round(n[larger] / n[1 - larger]))
    fold = F.when(F.col("toxic") == larger, F.pmod(F.xxhash64("text", F.lit(5)), F.lit(folds)).cast("int") + 1).otherwise(F.lit(0))
    model = kneser_ney(seen.select("text", fold.alias("model")))
    if model is None:
        return constant(sizes[1] / sum(sizes))
    if larger == 1:  # model 0 is the smaller class; gains are told for the toxic one
        model.word_gain, model.part_gain, model.other = -model.word_gain, -model.part_gain, -model.other

    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shipped.value.measure(t.as_py()) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(found, pa.float64())], names=["toxic", "x"])

    unseen = map_arrow(sample.where("use = 0").select("text", "toxic"), measured, "toxic int, x double").collect()
    y = np.array([r["toxic"] for r in unseen], dtype=float)
    if len(set(y.tolist())) < 2:
        return constant(sizes[1] / sum(sizes))
    x = bent(np.array([r["x"] for r in unseen]))
    order = np.lexsort((x, y))
    x, y = x[order], y[order]
    weight = np.where(y == 1, sizes[1] / (y == 1).sum(), sizes[0] / (y == 0).sum())
    model.slope, model.constant = calibrated(x, y, weight * len(y) / weight.sum())
    return model


def toxicity(docs: DataFrame, model: Model, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), threshold: float = 0.3) -> DataFrame:
    """The columns `keep` of every row with score (0 to 1) and predicted (1 if score >= threshold). Null and blank texts get the
    score of a text without words. Each row is judged by itself; an empty table gives no rows."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.select(*keep).columns
    schema = docs.select(*keep, F.lit(0.0).alias("score")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [shipped.value.score(t.as_py()) for t in batch.column(len(names))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array(scores, pa.float64())], names=[*names, "score"])

    scored = map_arrow(docs.select(*keep, F.col(text_col).alias("__text")), run, schema)
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
