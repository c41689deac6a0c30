"""Best-fit packing of documents into sequences, bulk-synchronously.

Documents are tokenised, documents longer than a sequence are cut into full pieces behind a shorter first one, and what is
shorter than a sequence is packed best-fit in decreasing length. Lengths and gaps are whole numbers of at most `capacity`, so
a range sort puts each into a bucket of its own and ranks it there. One superstep lets all waiting documents of a length look
up their successor, the smallest gap that holds them; where documents compete for the gaps of a bucket their ranks decide,
every gap takes one document at most, gaps are updated, and those without a gap sweep on to the next successor, or open
sequences of their own when there is none.

Since rows of a bucket are interchangeable, a superstep is decided by the counts of the buckets (at most `capacity` of each
kind). Only those counts reach the driver; its decisions are intervals (length, ranks, sequences, offset), whose number is
bounded by the capacity and not by the number of documents. Ranks and lookups of rows stay distributed, and a length that
holds a third of all rows is ranked in lanes. Full pieces are sequences of their own and need no rank. (The sweeps were also tried as
Spark jobs over the tables of buckets, which the README tells of: they took up to a hundred supersteps and the driver's memory.)

The identifiers are those of the vocabulary file: tiktoken reads the same vocabulary as ranks and yields the same ids, the string
of the special token included, which becomes that token.
"""

from __future__ import annotations

import base64
import zlib
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..runtime import map_arrow
from .common import stage

CAPACITY = 1024
END_ID = 2
LANES = 256
VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: Fixed value: the vocabulary's special token.
SPECIAL = {"<|endoftext|>": 50256}


@lru_cache(maxsize=2)
def encoding(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of n tokens; only the first may be shorter than the capacity."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def tokenized_pieces(docs: DataFrame, id_col: str, text_col: str, capacity: int, end_id: int, vocabulary: str, with_ids: bool) -> DataFrame:
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoding(vocabulary)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for at in range(0, len(ids), 500):
                out: list[list] = [[], [], [], [], [], []]
                for doc_id, text in zip(ids[at : at + 500], batch.column(1).slice(at, 500), strict=True):
                    tokens = np.append(np.asarray(coder.encode_to_numpy(text.as_py() or "", allowed_special="all"), dtype="<u4"), np.uint32(end_id)).astype("<u4")
                    for k, (start, length) in enumerate(cut(len(tokens), capacity)):
                        part = tokens[start : start + length]
                        for column, value in zip(out, (doc_id, k, start, length, zlib.crc32(part.tobytes()), part.tolist() if with_ids else None), strict=True):
                            column.append(value)
                types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()))
                arrays = [pa.array(c, t) for c, t in zip(out, types, strict=True)][: 6 if with_ids else 5]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: len(arrays)])

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return map_arrow(docs.select(F.col(id_col).cast("long"), F.col(text_col)), pieces, schema)


def best_fit(waiting: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Supersteps over bucket counts. waiting: length -> documents. Returns intervals (length, first rank, end rank, first
    sequence, offset) and the number of sequences."""
    gaps: list[deque[tuple[int, int]]] = [deque() for _ in range(capacity + 1)]  # by gap: (first sequence, count)
    plan, sequences = [], 0
    for length in sorted(waiting, reverse=True):
        rank, left = 0, waiting[length]
        while left:
            taken: list[tuple[int, int, int]] = []  # gap, sequences: each gap takes one document a superstep
            successor = length
            while left and successor <= capacity:
                while left and gaps[successor]:
                    first, count = gaps[successor].popleft()
                    n = min(left, count)
                    if n < count:
                        gaps[successor].appendleft((first + n, count - n))
                    plan.append((length, rank, rank + n, first, capacity - successor))
                    taken.append((successor - length, first, n))
                    rank, left = rank + n, left - n
                successor += 1
            for gap, first, n in taken:
                gaps[gap].append((first, n))
            if not taken and left:
                each = capacity // length
                opened, rest = divmod(left, each)
                for k in range(each):
                    if n := opened + (k < rest):
                        # the last of the new sequences may be partly filled: it is first in none but the leading layers
                        plan.append((length, rank, rank + n, sequences, k * length))
                        rank += n
                if opened:
                    gaps[capacity - each * length].append((sequences, opened))
                if rest:
                    gaps[capacity - rest * length].append((sequences + opened, 1))
                sequences += opened + (rest > 0)
                left = 0
    return plan, sequences


def pack(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID,
    vocabulary: str = VOCABULARY, with_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset; with `with_ids` also ids.

    A null text is empty: one piece that holds the end id. Null and repeated ids are packed like any other, each row as a
    document of its own; ids that are no whole numbers raise an error. An empty table gives no rows. Columns other than id and text
    play no part. A piece that fills a sequence has a negative sequence_id."""
    spark = docs.sparkSession
    pieces = stage(tokenized_pieces(docs, id_col, text_col, capacity, end_id, vocabulary, with_ids), "pieces")
    more = ["ids"] if with_ids else []
    full = pieces.withColumn("sequence_id", -1 - F.monotonically_increasing_id()).where(F.col("length") == capacity)
    full = full.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", F.lit(0).cast("long").alias("offset"), *more)
    lane = F.pmod(F.xxhash64("doc_id", "start"), F.lit(LANES)).cast("int")
    pieces = pieces.where(F.col("length") < capacity).withColumn("lane", lane)
    counts = pieces.groupBy("length", "lane").agg(F.count("*").alias("n"))
    counts = stage(counts.withColumn("before", F.sum("n").over(W.partitionBy("length").orderBy("lane")) - F.col("n")), "piece-counts")
    waiting = {int(r["length"]): int(r["n"]) for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan, _ = best_fit(waiting, capacity)
    intervals = spark.createDataFrame(plan, "length long, first long, end long, sequence0 long, offset long")

    within = F.row_number().over(W.partitionBy("length", "lane").orderBy("doc_id", "start", "ids_crc32")) - 1
    ranked = pieces.withColumn("within", within).join(counts.drop("n"), ["length", "lane"])
    ranked = ranked.withColumn("rank", F.col("before") + F.col("within"))
    here = (ranked["length"] == intervals["length"]) & (ranked["rank"] >= intervals["first"]) & (ranked["rank"] < intervals["end"])
    placed = ranked.join(F.broadcast(intervals), here)
    return full.unionByName(placed.select(
        "doc_id", "piece", "start", ranked["length"], "ids_crc32", (F.col("sequence0") + F.col("rank") - F.col("first")).alias("sequence_id"), "offset",
        *more,
    ))
