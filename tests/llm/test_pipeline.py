import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")
from trackframe.llm import near_dedup, packing  # noqa: E402
from trackframe.llm.common import stage  # noqa: E402

from .helpers import awkward_rows, clashing, documents, empty, prose  # noqa: E402


def test_stages_follow_one_another(spark):
    base = prose(1, 150)
    near = base.replace(base.split()[70], "changed", 1)
    rows = [(i, prose(50 + i, 60), "en", f"s{i % 3}") for i in range(60)]
    rows += [(100, base, "en", "s0"), (101, base.upper(), "en", "s0"), (102, near, "en", "s1"), (103, "12 34", "en", "s1"), (104, None, "en", "s1")]
    docs = documents(spark, rows)
    kept = {}
    for name, step in corpus_pipeline.STAGES:
        before = docs
        docs = stage(step(spark, docs, ""), name)
        if name != "packing":
            assert docs.columns == before.columns
            kept[name] = {r.doc_id for r in docs.select("doc_id").collect()}
    assert not {103, 104} & kept["language_id"] and 100 in kept["language_id"]
    assert 101 in kept["exact_dedup"] and 100 not in kept["exact_dedup"]
    assert len({101, 102} & kept["near_dedup"]) == 1
    assert set(range(60)) <= kept["near_dedup"]
    assert docs.agg({"length": "sum"}).first()[0] > 0 and packing.CAPACITY == 1024


def test_pipeline_ends_in_token_ids(spark):
    rows = corpus_pipeline.packing_stage(spark, documents(spark, [(1, prose(1, 900)), (2, prose(2, 40)), (3, None)]), "").collect()
    assert {r.doc_id for r in rows} == {1, 2, 3} and all(len(r.ids) == r.length > 0 for r in rows)


@pytest.mark.parametrize("make", [clashing, empty])
def test_every_stage_handles_awkward_tables(spark, make):
    for name, step in corpus_pipeline.STAGES:
        found = step(spark, make(spark), "")
        rows = found.count()
        assert rows == 0 if make is empty else rows > 0
        if name != "packing":
            assert found.columns == make(spark).columns


def test_near_stage_uses_five_words_and_four_fifths(spark):
    docs = clashing(spark)
    assert corpus_pipeline.near_stage(spark, docs, "").count() == near_dedup.drop_near_duplicates(docs).count() <= len(awkward_rows())
