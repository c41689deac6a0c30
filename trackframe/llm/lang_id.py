"""Language identification by compression.

Each language has a zstandard dictionary of raw content, filled with excerpts of its training texts. A text is cut into windows, each
window is compressed with every language's dictionary, and the language with the smallest total wins; the whole text is read, and
texts of all lengths are judged alike. Where the best and the second best are closer than `MARGIN` of the second, the prediction is
rejected: it is still returned, with `rejected` set.

Fitting uses a bounded sample: at most `SAMPLES` distinct texts a language, with an excerpt of at most `EXCERPT` characters each, all of
which the dictionary holds. Texts are drawn by a hash of their content, so copies count once. Sampled texts that the other half of the
sample assigns to another language are dropped before the dictionaries are built, which makes wrong labels harmless. More than
`MOST_LANGUAGES` languages are an error, since each has a dictionary in memory.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import map_arrow

SAMPLES, EXCERPT, MOST_LANGUAGES = 320, 200, 1000
LEVEL, WINDOW = 6, 1024
MARGIN = 0.004
_LETTER = re.compile(r"[^\W\d_]")


def _content(texts: list[bytes]) -> bytes:
    return b"\n".join(texts) or b"\n" * 8


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    dictionary.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_content_size=False, write_checksum=False, write_dict_id=False)


def _size(compressor: zstandard.ZstdCompressor, windows: list[bytes]) -> int:
    return sum(len(compressor.compress(w)) for w in windows)


def _windows(data: bytes) -> list[bytes]:
    return [data[i : i + WINDOW] for i in range(0, len(data), WINDOW)]


class Classifier:
    """languages: most frequent first, they win ties. contents: the dictionary of each."""

    def __init__(self, languages: list[str], contents: list[bytes]):
        self.languages, self.contents = languages, contents
        self.compressors = [_compressor(c) for c in contents]

    @classmethod
    def of(cls, samples: dict[str, list[bytes]]) -> Classifier:
        return cls(list(samples), [_content(t) for t in samples.values()])

    def sizes(self, data: bytes) -> list[int]:
        windows = _windows(data)
        return [_size(c, windows) for c in self.compressors]

    def predict(self, text: str | None) -> tuple[str, float, float]:
        """(language, score, margin). `und` with score and margin 0 if the text is null or has no letter."""
        if not text or not self.languages or not _LETTER.search(text):
            return "und", 0.0, 0.0
        sizes = self.sizes(text.lower().encode("utf-8", "replace"))
        best = min(range(len(sizes)), key=sizes.__getitem__)
        if len(sizes) == 1:
            return self.languages[best], 1.0, 1.0
        second = min(s for i, s in enumerate(sizes) if i != best)
        margin = (second - sizes[best]) / second
        return self.languages[best], margin / (margin + MARGIN), margin


def cleaned(samples: dict[str, list[bytes]]) -> dict[str, list[bytes]]:
    """Without the excerpts that the other half of the sample takes for another language."""
    halves = [{lang: _compressor(_content(texts[k::2])) for lang, texts in samples.items()} for k in (0, 1)]
    kept = {}
    for lang, texts in samples.items():
        own = [t for i, t in enumerate(texts) if min(halves[1 - i % 2].items(), key=lambda c, t=t: (_size(c[1], _windows(t)), c[0] != lang))[0] == lang]
        kept[lang] = own or texts
    return kept


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Classifier:
    """Learns from the rows of `labelled` that have a language and a text with a letter."""
    rows = labelled.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where(
        F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")
    )
    rows = rows.withColumn("hash", F.xxhash64("text"))
    drawn = rows.groupBy("lang", F.pmod("hash", F.lit(SAMPLES)).alias("slot")).agg(F.min("hash").alias("hash"), F.count("*").alias("n"))
    picked = drawn.select("lang", "hash", "n").limit(MOST_LANGUAGES * SAMPLES + 1).collect()
    totals: dict[str, int] = {}
    for r in picked:
        totals[r["lang"]] = totals.get(r["lang"], 0) + r["n"]
    if len(totals) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    samples: dict[str, list[bytes]] = {lang: [] for lang in sorted(totals, key=lambda k: (-totals[k], k))}
    if picked:
        keys = labelled.sparkSession.createDataFrame([(r["lang"], r["hash"]) for r in picked], "lang string, hash long")
        start = F.when(F.length("text") > EXCERPT, F.pmod("hash", F.length("text") - F.lit(EXCERPT))).otherwise(F.lit(0)).cast("int")
        texts = rows.join(F.broadcast(keys), ["lang", "hash"]).select("lang", "hash", F.substring("text", start + 1, F.lit(EXCERPT)).alias("part"))
        for r in sorted(texts.groupBy("lang", "hash").agg(F.first("part").alias("part")).collect(), key=lambda r: r["hash"]):
            samples[r["lang"]].append(r["part"].lower().encode("utf-8", "replace"))
    return Classifier.of(cleaned(samples))


def identify(docs: DataFrame, model: Classifier, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keep` of every row with lang_pred, score (0 to 1; below 0.5 means rejected), margin and rejected.

    A null text, or one without a letter, is `und` and rejected, as is every text if nothing was learned. Each row is judged
    by itself, so repeated rows get equal results, and an empty table gives no rows."""
    spark = docs.sparkSession
    samples = spark.sparkContext.broadcast((model.languages, model.contents))
    kept = docs.select(*keep).schema.fields
    schema = docs.select(*keep, F.lit("").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(0.0).alias("margin")).schema
    cache: dict[str, Classifier] = {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if "model" not in cache:
            cache["model"] = Classifier(*samples.value)
        judge = cache["model"].predict
        for batch in batches:
            found = [judge(t.as_py()) for t in batch.column(len(kept))]
            lang, score, margin = (list(c) for c in zip(*found, strict=True)) if found else ([], [], [])
            own = [batch.column(i) for i in range(len(kept))]
            yield pa.RecordBatch.from_arrays(
                [*own, pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(margin, pa.float64())],
                names=[*(f.name for f in kept), "lang_pred", "score", "margin"],
            )

    return map_arrow(docs.select(*keep, F.col(text_col).alias("__text")), run, schema).withColumn("rejected", F.col("margin") < MARGIN)


def accepted(docs: DataFrame, model: Classifier, text_col: str = "text") -> DataFrame:
    """The rows of `docs`, with all their columns, whose language is not rejected."""
    row = docs.select(F.struct("*").alias("row"), F.col(text_col).alias("text"))
    return identify(row, model, "text", ("row",)).where(~F.col("rejected")).select("row.*")
