"""Near deduplication by MinHash with odd sketches.

A document is its set of distinct word shingles. MinHash samples of the set serve twice: bands of samples name the buckets in
which candidates meet, and all samples are folded into an odd sketch, a bitmap in which each sample flips one bit. The
population count of two sketches' XOR estimates a high similarity precisely. A second bitmap folds the full set in the same way: its XOR
never counts more than the sets differ by, so it drops pairs that cannot be linked and no others. Almost only true links reach
the last step, which compares the full sets.

No group is compared pair by pair or gathered in one task:

1. Documents with the same set form a class; one of them stands for it from here on.
2. In every bucket the members meet its smallest member only (a star). What passes the sketch and then the comparison of full
   sets is a link, and the links give components.
3. Only buckets whose members still lie in different components are looked at again: members meet in blocks of at most
   `BLOCK`, and pairs of different components that pass the sketch are compared on full sets as well. So every pair that
   shares a bucket is either in one component already or judged by its sketch, whatever the bucket's size.

A pair at the threshold shares no bucket with probability `MISS` at most.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import map_arrow
from .common import stage
from .hashing import U64, mix, word_hashes

SAMPLES, BANDS, MISS = 512, 48, 1e-5
SKETCH_BITS, SET_BITS = 1024, 2048
BLOCK, CHUNK = 1024, 256

_rng = np.random.default_rng(20_240_602)
_A = (_rng.integers(0, 2**32, SAMPLES, dtype=U64) | U64(1)).astype(np.uint32)[:, None]
_B = _rng.integers(0, 2**32, SAMPLES, dtype=U64).astype(np.uint32)[:, None]
_SALT = _rng.integers(0, 2**64, SAMPLES, dtype=U64)
_ORDERS = [_rng.permutation(SAMPLES) for _ in range(BANDS)]


def shingle_set(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles; of fewer words, one hash of the whole sequence."""
    words = word_hashes(text)
    if not len(words):
        return words
    width = min(k, len(words))
    rows = len(words) - width + 1
    out = words[:rows] + U64(width)
    for j in range(1, width):
        out = mix(out * U64(0xD1342543DE82EF95) + words[j : j + rows])
    return np.unique(mix(out))


def minhash(shingles: np.ndarray) -> np.ndarray:
    x = (shingles >> U64(32)).astype(np.uint32)
    best = np.full(SAMPLES, 2**32 - 1, dtype=np.uint32)
    for at in range(0, len(x), 512):
        part = x[None, at : at + 512] * _A
        part += _B
        np.minimum(best, part.min(axis=1), out=best)
    return best


def rows_per_band(threshold: float) -> int:
    """The most samples a band may have so that a pair at the threshold shares a bucket but for MISS."""
    return max(r for r in range(1, 17) if r == 1 or (1 - threshold**r) ** BANDS <= MISS)


def band_index(rows: int) -> np.ndarray:
    """For each band the samples it joins: parts of one random order after another."""
    per = SAMPLES // rows
    return np.array([_ORDERS[b // per][(b % per) * rows : (b % per + 1) * rows] for b in range(BANDS)])


def band_keys(samples: np.ndarray, index: np.ndarray) -> np.ndarray:
    key = np.arange(1, len(index) + 1, dtype=U64)
    for column in samples[index].astype(U64).T:
        key = mix(key * U64(0xD1342543DE82EF95) + column)
    return key.view(np.int64)


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    bits = (mix(samples.astype(U64) + _SALT) % U64(SKETCH_BITS)).astype(np.int64)
    return np.packbits((np.bincount(bits, minlength=SKETCH_BITS) & 1).astype(np.uint8)).view(np.int64)


def set_sketch(shingles: np.ndarray) -> np.ndarray:
    """Parity bitmap of the full set; two of them differ in as many bits as the sets in elements, or fewer."""
    bits = (shingles % U64(SET_BITS)).astype(np.int64)
    return np.packbits((np.bincount(bits, minlength=SET_BITS) & 1).astype(np.uint8)).view(np.int64)


def most_differing_bits(threshold: float) -> int:
    """The XOR count up to which a pair may reach the threshold: 4 deviations of the samples below it, and 3 of the fold."""
    low = threshold - 4 * math.sqrt(threshold * (1 - threshold) / SAMPLES)
    flips = 2 * SAMPLES * (1 - low)
    return math.ceil(SKETCH_BITS / 2 * (1 - (1 - 2 / SKETCH_BITS) ** flips) + 3 * 2 * math.sqrt(flips**2 / (2 * SKETCH_BITS)))


def signatures(docs: DataFrame, id_col: str, text_col: str, k: int, threshold: float) -> DataFrame:
    """doc_id, n_shingles, set_a, set_b (128 bits that name the set), keys, sketch, bitmap; of an empty set the last three are
    null."""
    index = band_index(rows_per_band(threshold))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, a, b, keys, sketches, bitmaps = [], [], [], [], [], []
            for text in batch.column(1):
                s = shingle_set(text.as_py(), k)
                sizes.append(len(s))
                a.append(int(mix(s + U64(11)).sum(dtype=U64).view(np.int64)) if len(s) else 0)
                b.append(int(mix(s ^ U64(0x5851F42D4C957F2D)).sum(dtype=U64).view(np.int64)) if len(s) else 0)
                samples = minhash(s) if len(s) else None
                keys.append(band_keys(samples, index) if len(s) else None)
                sketches.append(odd_sketch(samples) if len(s) else None)
                bitmaps.append(set_sketch(s) if len(s) else None)
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(keys, longs), pa.array(sketches, longs), pa.array(bitmaps, longs)],
                names=["doc_id", "n_shingles", "set_a", "set_b", "keys", "sketch", "bitmap"],
            )

    schema = "doc_id long, n_shingles long, set_a long, set_b long, keys array<long>, sketch array<long>, bitmap array<long>"
    return map_arrow(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), run, schema)


def differing_bits(x: Column, y: Column) -> Column:
    return F.aggregate(F.zip_with(x, y, lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda s, v: s + v)


def sizes_allow(n: Column, m: Column, num: int, den: int) -> Column:
    return F.least(n, m) * den >= F.greatest(n, m) * num


def bitmaps_allow(differing: Column, n: Column, m: Column, num: int, den: int) -> Column:
    """Linked sets of n and m elements differ by at most (n + m) * (den - num) / (den + num)."""
    return differing * (den + num) <= (n + m) * (den - num)


def confirmed(pairs: DataFrame, texts: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar. Texts travel to the pair's first document, whose set is kept while its
    partners stream by; partners of one document are split into chunks of about CHUNK."""
    chunks = pairs.groupBy("a").agg(F.ceil(F.count("*") / F.lit(CHUNK)).alias("chunks"))
    placed = pairs.join(chunks, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("chunks")).alias("chunk"))
    partners = placed.join(texts, placed["b"] == texts["node"]).select("a", "chunk", F.col("b").alias("id"), F.lit(1).alias("role"), "text")
    firsts = placed.select("a", "chunk").distinct().join(texts, F.col("a") == texts["node"]).select("a", "chunk", F.col("a").alias("id"), F.lit(0).alias("role"), "text")
    together = firsts.unionByName(partners).repartition("a", "chunk").sortWithinPartitions("a", "chunk", "role")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, own = None, []
        for batch in batches:
            a, b = [], []
            for first, chunk, other, role, text in zip(*(batch.column(i).to_pylist() for i in range(4)), batch.column(4), strict=True):
                if (first, chunk) != at:
                    at, own = (first, chunk), []
                mine = shingle_set(text.as_py(), k)
                if role == 0:
                    own.append(mine)
                    continue
                for theirs in own:
                    both = len(np.intersect1d(mine, theirs, assume_unique=True))
                    if den * both >= num * (len(mine) + len(theirs) - both):
                        a.append(first)
                        b.append(other)
                        break
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return map_arrow(together, run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, label) with the smallest node of each connected component, for the nodes of `edges` (a, b), by alternating
    large-star and small-star steps; every round is written out, and the rounds end when one changes nothing."""
    edges = stage(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = stage(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
        edges = stage(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "small-star")
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == state:
            break
        state = now
    labels = edges.groupBy("u").agg(F.min("v").alias("label")).select(F.col("u").alias("node"), "label")
    return labels.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct().join(labels.select("node"), "node", "left_anti"))


def cross_component_pairs(members: DataFrame, most_bits: int, num: int, den: int) -> DataFrame:
    """Pairs (a, b) of different components that share a bucket and pass the sketch. members: key, node, label, n,
    sketch, bitmap."""
    counts = members.groupBy("key").agg(F.count("*").alias("rows"), F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y")
    rows = members.join(counts.select("key", F.ceil(F.col("rows") / F.lit(BLOCK)).alias("blocks")), "key")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    rows = rows.select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "label", "n", "sketch", "bitmap")
    rows = rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")

    def pairs_of(group: list[tuple]) -> tuple[list[int], list[int]]:
        _, i, j = group[0][:3]
        block, node, label, n = (np.array([g[c] for g in group], dtype=np.int64) for c in (3, 4, 5, 6))
        sketch, bitmap = (np.array([g[c] for g in group], dtype=np.int64).view(U64) for c in (7, 8))
        a, b = [], []
        for r in range(len(group) - 1):
            fits = (label[r + 1 :] != label[r]) & (np.minimum(n[r], n[r + 1 :]) * den >= np.maximum(n[r], n[r + 1 :]) * num)
            if i != j:
                fits &= block[r + 1 :] != block[r]
            at = np.flatnonzero(fits) + r + 1
            at = at[np.bitwise_count(sketch[at] ^ sketch[r]).sum(axis=1) <= most_bits]
            at = at[np.bitwise_count(bitmap[at] ^ bitmap[r]).sum(axis=1, dtype=np.int64) * (den + num) <= (n[at] + n[r]) * (den - num)]
            a += np.minimum(node[at], node[r]).tolist()
            b += np.maximum(node[at], node[r]).tolist()
        return a, b

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple] = []
        for batch in batches:
            a: list[int] = []
            b: list[int] = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if group and row[:3] != group[0][:3]:
                    x, y = pairs_of(group)
                    a, b, group = a + x, b + y, []
                group.append(row)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
        if group:
            x, y = pairs_of(group)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())], names=["a", "b"])

    return map_arrow(rows, run, "a long, b long").distinct()


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One row per row of `docs`: doc_id, n_shingles, component_id, kept. Documents are linked when den * intersection >=
    num * union of their sets of k-word shingles; component_id is the smallest id that links reach.

    Null and blank texts have an empty set and are linked with nothing: they keep their own id. Rows that repeat an id are one
    document, whose links are those of all its rows. Rows with a null id take part; a component of such rows only has a null
    component_id, and they say kept. An empty table gives no rows."""
    threshold, bits = num / den, most_differing_bits(num / den)
    sigs = stage(signatures(docs, id_col, text_col, k, threshold), "signatures")
    sets = ["set_a", "set_b", "n_shingles"]
    classes = sigs.where("n_shingles > 0").groupBy(*sets).agg(F.min("doc_id").alias("least_id"), F.first("keys").alias("keys"), F.first("sketch").alias("sketch"), F.first("bitmap").alias("bitmap"))
    # a class of null ids only is named by its set, below all ids in use
    classes = classes.withColumn("node", F.coalesce("least_id", F.col("set_a").bitwiseOR(F.lit(-(2**63)))))
    classes = stage(classes, "set-classes")

    bands = classes.select("node", F.explode("keys").alias("key"))
    shared = bands.groupBy("key").agg(F.min("node").alias("center"), F.count("*").alias("rows")).where("rows > 1").select("key", "center")
    members = stage(bands.join(shared, "key"), "bucket-members")
    about = classes.select("node", F.col("n_shingles").alias("n"), "sketch", "bitmap")

    stars = members.where("node <> center").select(F.col("center").alias("a"), F.col("node").alias("b")).distinct()
    left, right = (about.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("sketch").alias(f"s{x}"), F.col("bitmap").alias(f"b{x}")) for x in "ab")
    stars = stars.join(left, "a").join(right, "b").where(sizes_allow(F.col("na"), F.col("nb"), num, den) & (differing_bits(F.col("sa"), F.col("sb")) <= bits))
    stars = stars.where(bitmaps_allow(differing_bits(F.col("ba"), F.col("bb")), F.col("na"), F.col("nb"), num, den))
    stars = stage(stars.select("a", "b"), "star-pairs")

    in_buckets = members.select("node").distinct()
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).join(in_buckets, F.col("doc_id") == F.col("node"), "left_semi")
    unnamed = classes.where("least_id is null").select("node", "set_a").limit(1).count()
    texts = texts.select(F.col("doc_id").alias("node"), "text")
    if unnamed:
        texts = texts.unionByName(_unnamed_texts(docs, id_col, text_col, k, in_buckets))
    texts = stage(texts, "bucket-texts")

    links = stage(confirmed(stars, texts, k, num, den), "star-links")
    labels = stage(components(links), "star-labels")
    labelled = members.select("key", "node").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    open_keys = labelled.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y").select("key")
    waiting = labelled.join(open_keys, "key", "left_semi").join(about, "node").select("key", "node", "label", "n", "sketch", "bitmap")
    more = cross_component_pairs(waiting, bits, num, den).join(stars, ["a", "b"], "left_anti")
    more = stage(confirmed(stage(more, "block-pairs"), texts, k, num, den), "block-links")
    if more.limit(1).count():
        labels = stage(components(links.unionByName(more)), "labels")

    named = classes.select(*sets, "node", "least_id").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = named.groupBy("label").agg(F.min("least_id").alias("component_id"))
    named = stage(named.join(least, "label").select(*sets, "component_id"), "class-components")
    rows = sigs.select("doc_id", *sets)
    full = rows.where("n_shingles > 0").join(named, sets).select("doc_id", "n_shingles", "component_id")
    empty = rows.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return full.unionByName(empty).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _unnamed_texts(docs: DataFrame, id_col: str, text_col: str, k: int, in_buckets: DataFrame) -> DataFrame:
    """Texts of rows without an id, under the names of their classes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t.as_py(), k) for t in batch.column(0)]
            names = [int((mix(s + U64(11)).sum(dtype=U64) | U64(2**63)).view(np.int64)) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), batch.column(0)], names=["node", "text"])

    rows = map_arrow(docs.where(F.col(id_col).isNull()).select(F.col(text_col).alias("text")), run, "node long, text string")
    return rows.join(in_buckets, "node", "left_semi").dropDuplicates(["node"])


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of `docs`, with all their columns, but for those whose component has a smaller id. Rows without an id stay."""
    gone = near_dedup(docs, id_col, text_col, **options).where(~F.col("kept")).select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, docs[id_col].cast("long") == gone["__gone"], "left_anti")


ORACLE_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
         ELSE list_distinct(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) END AS sh FROM w
), x AS MATERIALIZED (
  SELECT doc_id, len(sh) AS n, unnest(sh) AS t FROM s
), p AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b FROM x a JOIN x b ON a.t = b.t AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), r AS (
  SELECT doc_id, doc_id AS seen FROM s UNION SELECT r.doc_id, p.b FROM r JOIN p ON r.seen = p.a
)
SELECT s.doc_id, CAST(len(s.sh) AS BIGINT) AS n_shingles, min(r.seen) AS component_id, s.doc_id = min(r.seen) AS kept
FROM s JOIN r ON s.doc_id = r.doc_id GROUP BY s.doc_id, len(s.sh)
"""
