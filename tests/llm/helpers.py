"""Small tables of the awkward kinds that every operator must handle."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Extra columns whose names operators use inside.
CLASHES = ("row", "norm", "digest", "size", "rank", "node", "label", "key", "score", "kept", "hash", "block", "id", "th")

WORDS = "amber birch cedar delta ember frost grove haven inlet jetty knoll lotus maple north ocean prairie quartz river stone tidal".split()


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + r.choice(("", "", "", ".", ",")) + r.choice(("", str(r.randrange(90)))) for _ in range(n))


def awkward_rows() -> list[tuple]:
    base = prose(1, 80)
    near = base.replace(base.split()[40], "changed", 1)
    rows = [
        (1, base, "en", "a", None), (2, base, "en", "a", 3), (3, base.upper(), "de", "b", 3), (4, near, None, None, 3), (5, None, "en", "a", None), (6, "", None, "b", 0),
        (7, " \t\n ", "de", None, 4), (8, "word", "en", "c", 4), (9, prose(2, 30_000), "en", "c", 9), (10, "123 456 !!", None, "c", 9), (None, base, "en", "a", 1),
        (None, prose(3, 50), None, None, None), (11, prose(4, 60), "de", "b", 1), (11, prose(4, 60), "de", "b", 1), (12, "Ärger über Öl und \U0001f600 emoji", "de", "b", 5),
    ]
    return rows


def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA)


def clashing(spark):
    from pyspark.sql import functions as F

    docs = awkward(spark)
    for name in CLASHES:
        docs = docs.withColumn(name, F.lit("x"))
    return docs


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def documents(spark, rows):
    """Rows of (doc_id, text) or (doc_id, text, lang, source)."""
    return spark.createDataFrame([(*r, *(None,) * (5 - len(r))) for r in rows], SCHEMA)


def words(text):
    return (text or "").encode().lower().split()
