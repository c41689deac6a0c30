"""Language-model scores of whole documents, by a gated recurrent model over corpus-wide word counts.

Counting: the tokens of all training documents are counted by word, over the whole corpus. Words are named by 64-bit hashes.

Model: the most frequent words form the head vocabulary of the recurrent model; every other word belongs to the tail bucket of
its last two bytes. The model gives head words and buckets a probability after everything that came before in the document; a
word's share of its bucket is its smoothed count over that of all words of the bucket, with one place in each for words never
seen. So the model's probabilities of all words sum to at most one, unseen words included.

Training: one pass over all training documents, repeated ones as often as they occur. They are dealt to `ROUNDS` rounds and, within
a round, to replicas of about `REPLICA_TOKENS`. In each round every replica runs truncated backpropagation over its documents from the
same weights, and the weights are averaged by Spark, so the driver holds one copy whatever the number of replicas.

Scoring: words with at least `COMMON` of all tokens (1 / COMMON words at most, which bounds what is broadcast) are looked up in
place; the counts of rarer words are joined to the documents that hold them. Each document is scored from its first token to
its end with the state carried across windows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import map_arrow
from .common import stage
from .hashing import U64, words_of_texts
from .recurrent import Shape, initial, score, train

SHAPE = Shape(hidden=32, classes=32, width=64, tails=96)
REPLICA_TOKENS, ROUNDS, RATE = 400_000, 3, 0.1
COMMON = 1e-6
SUFFIX = 2
END = 0  # the id of the end token, which also begins a document
SLICE = 4096
#: Bytes of text that are encoded or scored at once, a longer text by itself.
GROUP = 4_000_000
_LN10 = math.log(10)


def _groups(texts: pa.Array) -> Iterator[list[str | None]]:
    """The texts in order, in groups of about `GROUP` bytes."""
    group, size = [], 0
    for text in texts:
        group.append(text.as_py())
        size += len(group[-1] or "") + 100
        if size >= GROUP:
            yield group
            group, size = [], 0
    if group:
        yield group


def _hashes(texts: list[str | None], tails: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words' hashes and tail buckets of all texts, and the numbers of words."""
    words, suffixes, lengths = words_of_texts(texts, SUFFIX, False)
    return words, (suffixes % U64(tails)).astype(np.int32), lengths


def counted_words(docs: DataFrame, text_col: str, buckets: int) -> DataFrame:
    """(hash, tail, n) of every word of `docs`; rows with a null hash hold the numbers of documents instead."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in _groups(batch.column(0)):
                words, tails, _ = _hashes(group, buckets)
                coded = pa.array(words.view(np.int64)).dictionary_encode()
                at, names = coded.indices.to_numpy(), coded.dictionary.to_numpy()
                of = np.zeros(len(names), dtype=np.int32)
                of[at] = tails
                n = np.bincount(at, minlength=len(names))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.concat_arrays([pa.array(names, pa.int64()), pa.nulls(1, pa.int64())]), pa.array(np.append(of, 0).astype(np.int32)),
                        pa.array(np.append(n, len(group)).astype(np.int64)),
                    ],
                    names=["hash", "tail", "n"],
                )

    parts = map_arrow(docs.select(text_col), run, "hash long, tail int, n long")
    return parts.groupBy("hash", "tail").agg(F.sum("n").alias("n"))


class Model:
    """names, counts, heads: the common words' hashes (sorted), counts and head ids (0: none). tails: log10 of the buckets'
    smoothed shares. tokens and types: N and V of the training tokens, the end token among them; ends: its count. trained: how
    many tokens the replicas went over in each round. rare: the counts of all other words, as a table; it stays on the driver."""

    def __init__(self, shape, names, counts, heads, tails, tokens, types, ends, weights):
        self.shape = shape
        self.names, self.counts, self.heads, self.tails = names, counts, heads, tails
        self.tokens, self.types, self.ends, self.weights = tokens, types, ends, weights
        self.trained: list[int] = []
        self.rare: DataFrame | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"rare": None}

    def log_share(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.5) / (self.tokens + 0.5 * (self.types + 1)))

    def encode(self, texts: list[str | None]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of each text with the end token; for the words of all texts their hashes, whether they are common, and their counts if so;
        and where each text's words begin and end."""
        words, tails, lengths = _hashes(texts, self.shape.tails)
        found = pc.index_in(pa.array(words.view(np.int64)), value_set=pa.array(self.names.view(np.int64)))
        known = found.is_valid().to_numpy(zero_copy_only=False)
        at = found.fill_null(0).to_numpy()
        none = np.zeros(1, dtype=np.int32)
        counts = np.where(known, np.append(self.counts, none)[at], 0)
        heads = np.where(known, np.append(self.heads, none)[at], 0)
        ids = np.where(heads > 0, heads, self.shape.head + tails).astype(np.int32)
        edges = np.concatenate(([0], np.cumsum(lengths)))
        end = np.array([END], dtype=np.int32)
        return [np.concatenate((ids[a:b], end)) for a, b in zip(edges, edges[1:], strict=False)], words, known, counts, edges


def _pack(p: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([p[k].reshape(-1) for k in sorted(p)])


def _unpack(flat: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k in sorted(like):
        out[k] = flat[at : at + like[k].size].reshape(like[k].shape).astype(np.float32)
        at += like[k].size
    return out


SUMS = "slice int, v array<double>, n long, seen long"


def _sums(slices: list[int], values: list, n: list[int], seen: list[int]) -> pa.RecordBatch:
    """Sums of weights by slice, with the numbers of replicas and tokens in them."""
    arrays = [pa.array(slices, pa.int32()), pa.array(values, pa.list_(pa.float64())), pa.array(n, pa.int64()), pa.array(seen, pa.int64())]
    return pa.RecordBatch.from_arrays(arrays, names=["slice", "v", "n", "seen"])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each slice of the partition, whatever the number of replicas."""
    sums: dict[int, list] = {}
    for batch in batches:
        for at, v, n, seen in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            own = v.values.to_numpy()
            old = sums.get(at, (0.0, 0, 0))
            sums[at] = (old[0] + own, old[1] + n, old[2] + seen)
    if sums:
        yield _sums(list(sums), [v[0].tolist() for v in sums.values()], [v[1] for v in sums.values()], [v[2] for v in sums.values()])


def fit(docs: DataFrame, text_col: str = "text", shape: Shape = SHAPE, share_of_common: float = COMMON, replica_tokens: int = REPLICA_TOKENS) -> Model:
    """Learns from all rows of `docs`; null texts are empty documents."""
    spark = docs.sparkSession
    counts = stage(counted_words(docs, text_col, shape.tails), "word-counts")
    ends = int(counts.where("hash is null").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    words = counts.where("hash is not null")
    types, tokens = words.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    types, tokens = types + (ends > 0), tokens + ends
    common = words.where(F.col("n") >= max(1.0, share_of_common * tokens)).toArrow()
    names, n, tail = common["hash"].to_numpy().view(U64), common["n"].to_numpy(), common["tail"].to_numpy()
    order = np.argsort(names)
    names, n, tail = names[order], n[order], tail[order]
    head = np.lexsort((names, -n))[: shape.head - 1]
    heads = np.zeros(len(names), dtype=np.int32)
    heads[head] = np.arange(1, len(head) + 1)

    by_tail = np.full(shape.tails, 0.5)
    for r in words.groupBy("tail").agg(F.sum(F.col("n") + 0.5).alias("n")).collect():
        by_tail[r["tail"]] += r["n"]
    np.subtract.at(by_tail, tail[head], n[head] + 0.5)
    total = tokens + 0.5 * (types + 1)
    unigram = np.concatenate(([ends], n[head], np.zeros(shape.head - 1 - len(head)), by_tail))
    weights = initial(shape, unigram)
    model = Model(shape, names, n, heads, np.log10(by_tail / total), int(tokens), int(types), ends, weights)

    shipped = spark.sparkContext.broadcast(model)
    kind = np.int16 if shape.inputs < 2**15 else np.int32  # of the staged ids

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [one.astype(kind).tobytes() for group in _groups(batch.column(2)) for one in shipped.value.encode(group)[0]]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ids, pa.binary())], names=["replica", "hash", "ids"])

    # dealt by place as well as by text, so that the copies of a text don't meet in one replica; a replica is a run of one file
    replicas = max(1, round(tokens / ROUNDS / replica_tokens))
    dealt = docs.select(F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("hash"), F.monotonically_increasing_id().alias("place"), F.col(text_col).alias("text"))
    turn = F.pmod(F.xxhash64("hash", "place"), F.lit(replicas * ROUNDS)).cast("int")
    dealt = dealt.select(turn.alias("replica"), "hash", "text")
    dealt = map_arrow(dealt, encoded, "replica int, hash long, ids binary")
    dealt = stage(dealt.repartition(replicas, F.col("replica") % replicas).sortWithinPartitions("replica", "hash"), "training-documents")
    shipped.unpersist()
    size = sum(v.size for v in weights.values())
    for k in range(ROUNDS):
        shipped = spark.sparkContext.broadcast(model.weights)

        def replica(batches: Iterator[pa.RecordBatch], shipped=shipped, k=k) -> Iterator[pa.RecordBatch]:
            start = shipped.value
            at, documents, total, n, seen = None, [], 0.0, 0, 0

            def trained(own: int, documents: list[np.ndarray]) -> np.ndarray:
                p = {name: value.copy() for name, value in start.items()}
                memory = {name: np.full_like(value, 1e-3 if not k else 1.0) for name, value in start.items()}
                train(shape, p, memory, documents, END, RATE, seed=own * 31 + k)
                return _pack(p).astype(float)

            for batch in batches:
                for own, ids in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    if at is not None and own != at:
                        total, n = total + trained(at, documents), n + 1
                        documents = []
                    at = own
                    documents.append(np.frombuffer(ids.as_py(), dtype=kind))
                    seen += len(documents[-1])
            if documents:
                total, n = total + trained(at, documents), n + 1
                slices = [total[i : i + SLICE].tolist() for i in range(0, len(total), SLICE)]
                yield _sums(list(range(len(slices))), slices, [n] * len(slices), [seen] * len(slices))

        own = dealt.where(F.col("replica").between(k * replicas, (k + 1) * replicas - 1)).select("replica", "ids")  # a range of each sorted file
        parts = map_arrow(own, replica, SUMS)
        whole = map_arrow(parts.repartition(min(replicas, -(-size // SLICE)), "slice"), _added, SUMS).toArrow()
        if whole.num_rows:
            flat = np.zeros(size)
            for at, v, n in zip(whole["slice"].to_pylist(), whole["v"].to_pylist(), whole["n"].to_pylist(), strict=True):
                flat[at * SLICE : at * SLICE + len(v)] = np.array(v) / n
            model.weights = _unpack(flat, weights)
            model.trained.append(whole["seen"][0].as_py())
        shipped.unpersist()
    model.rare = words.where(F.col("n") < max(1.0, share_of_common * tokens)).select("hash", "n")
    return model


def lm_score(docs: DataFrame, model: Model, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keep` of every row with n_tokens, n_known, train_tokens, base_score and score (log10).

    Tokens are the words (A to Z lower-cased) and one end; a null text has the end only. If nothing was learned every token has
    the share of an unseen one in base_score. Each row is scored by itself, repeated rows alike; an empty table gives no rows."""
    spark = docs.sparkSession
    shipped = spark.sparkContext.broadcast(model)
    names = docs.select(*keep).columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shipped.value
        for batch in batches:
            at = 0
            for group in _groups(batch.column(len(names))):
                documents, words, known, counts, edges = m.encode(group)
                shares = m.log_share(counts)
                inside = np.concatenate([d[:-1] for d in documents]) if len(words) else np.zeros(0, dtype=np.int32)
                tail_shares = np.where(inside >= m.shape.head, m.tails[np.maximum(inside - m.shape.head, 0)], 0.0)
                base = np.add.reduceat(np.append(np.where(known, shares, 0.0), 0.0), edges[:-1]) * (np.diff(edges) > 0)
                tail = np.add.reduceat(np.append(np.where(known & (inside >= m.shape.head), shares, 0.0) - tail_shares, 0.0), edges[:-1]) * (np.diff(edges) > 0)
                sure = np.add.reduceat(np.append(known, False).astype(np.int64), edges[:-1]) * (np.diff(edges) > 0)
                rare = [np.unique(words[a:b][~known[a:b]], return_counts=True) for a, b in zip(edges, edges[1:], strict=False)]
                found = score(m.shape, m.weights, documents, END) / _LN10
                longs = pa.list_(pa.int64())
                arrays = [
                    pa.array([len(d) for d in documents], pa.int64()), pa.array(sure + (m.ends > 0), pa.int64()),
                    pa.array(base + m.log_share(np.array([m.ends]))[0], pa.float64()), pa.array(tail, pa.float64()),
                    pa.array([w.view(np.int64) for w, _ in rare], longs), pa.array([n.astype(np.int64) for _, n in rare], longs), pa.array(found, pa.float64()),
                ]
                own = [c.slice(at, len(group)) for c in batch.columns[: len(names)]]
                at += len(group)
                yield pa.RecordBatch.from_arrays([*own, *arrays], names=[*names, "n_tokens", "known", "base", "tail", "hashes", "times", "model"])

    schema = docs.select(
        *keep, *(F.lit(0).cast("long").alias(c) for c in ("n_tokens", "known")), *(F.lit(0.0).alias(c) for c in ("base", "tail")),
        *(F.array(F.lit(0).cast("long")).alias(c) for c in ("hashes", "times")), F.lit(0.0).alias("model"),
    ).schema
    scored = map_arrow(docs.select(*keep, F.col(text_col).alias("__text")), run, schema)
    scored = stage(scored.withColumn("row_no", F.monotonically_increasing_id()), "lm-scored")

    each = scored.select("row_no", F.explode(F.arrays_zip("hashes", "times")).alias("w")).select("row_no", F.col("w.hashes").alias("hash"), F.col("w.times").alias("times"))
    each = each.join(model.rare, "hash", "left")
    place = model.tokens + 0.5 * (model.types + 1)
    share = F.log10((F.coalesce("n", F.lit(0)) + F.lit(0.5)) / F.lit(float(place)))
    rare_sums = each.groupBy("row_no").agg(
        F.sum(F.col("times") * share).alias("rare"), F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("rare_known")
    )
    rest = F.coalesce("rare", F.lit(0.0))
    return scored.drop("hashes", "times").join(rare_sums, "row_no", "left").select(
        *keep, "n_tokens", (F.col("known") + F.coalesce("rare_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"), (F.col("base") + rest).alias("base_score"), (F.col("model") + F.col("tail") + rest).alias("score"),
    )
