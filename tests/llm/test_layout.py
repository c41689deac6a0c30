import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from trackframe.llm import fingerprints, mixing, packing, sharding

from .helpers import awkward_rows, clashing, documents, empty, prose, words


# ---- mixing


def test_shares_stop_at_the_limit_and_use_everything():
    targets = mixing.share_out([10, 1000, 1, 0], [1, 2, 3, 1], 3)
    assert targets[0] == 30 and targets[2] == 3 and targets[3] == 0 and abs(sum(targets) - 1011) < 1e-9


def test_mix_against_brute_force(spark):
    rows = [(i, prose(i, i % 23), None, ("a", "b", "c", None)[i % 4] if i % 3 else "hot") for i in range(400)]
    found = {r.doc_id: r for r in mixing.mix(documents(spark, rows)).collect()}
    by = defaultdict(list)
    for i, text, _, source in rows:
        by[source].append((len(words(text)), i))
    order = sorted((s for s in by if s is not None)) + [None]
    sizes = [sum(n for n, _ in by[s]) for s in order]
    targets = mixing.share_out(sizes, [1, 2, 3, 1, 2][: len(order)], 3)
    for source, size, target in zip(order, sizes, targets, strict=True):
        at, taken = mixing.offset_of(source, 17), 0
        for n, i in sorted(by[source]):
            before, at = at, at + target / size
            r = found[i]
            assert (r.size, r.source_size) == (n, size) and abs(r.target - target) < 1e-6
            assert abs(r.copies - (int(at + 1e-9) - int(before + 1e-9))) == 0 and r.taken == r.copies * n <= 3 * n
            taken += r.taken
        assert abs(taken - target) <= 0.05 * target + 25


def test_mixed_documents_repeat_rows(spark):
    docs = clashing(spark)
    copies = {}
    for r in mixing.mix(docs).collect():
        copies[r.doc_id] = copies.get(r.doc_id, 0) + r.copies
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    assert Counter(r.doc_id for r in mixed.select("doc_id").collect()) == Counter({k: v for k, v in copies.items() if v})
    assert mixing.mix(empty(spark)).count() == 0 and mixing.mixed_documents(empty(spark)).count() == 0
    assert len(mixing.mix(docs).collect()) == len(awkward_rows())


# ---- sharding


def ring_by_hand(rows, shards, vnodes):
    points, total = sharding.ring(shards, vnodes), len(rows)
    arcs = sharding.arc_of_cell(points)
    room = [total // shards + (s < total % shards) for s in range(shards)]
    start = points[-1][0] + 1
    placed = {}
    used = [0] * shards
    for r in sorted(rows, key=lambda r: (arcs[r["cell"]], (r["cell"] - start) % sharding.CELLS, r["place"], r["lane"], r["doc_id"])):
        k = arcs[r["cell"]]
        while used[points[k][1]] >= room[points[k][1]]:
            k = (k + 1) % len(points)
        placed[r["doc_id"]] = (points[k][1], used[points[k][1]])
        used[points[k][1]] += 1
    return placed


def test_sharding_against_insertion_by_hand(spark):
    docs = documents(spark, [(i, "copy" if i % 3 == 0 else prose(i, 5)) for i in range(700)])
    found = sharding.shard_rows(docs, shards=7, vnodes=5).collect()
    place = F.xxhash64(F.coalesce("text", F.lit("")))
    keyed = docs.select("doc_id", place.alias("place"), F.pmod(place, F.lit(sharding.CELLS)).cast("int").alias("cell"), F.pmod(F.xxhash64("doc_id"), F.lit(sharding.LANES)).cast("int").alias("lane"))
    assert {r.doc_id: (r.shard, r.slot) for r in found} == ring_by_hand([r.asDict() for r in keyed.collect()], 7, 5)
    sizes = Counter(r.shard for r in found)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    for s in sizes:
        assert sorted(r.slot for r in found if r.shard == s) == list(range(sizes[s]))


def test_copies_stay_together_in_crowded_cells(spark, monkeypatch):
    monkeypatch.setattr(sharding, "CELLS", 64)
    docs = documents(spark, [(i, f"text {i % 500}") for i in range(5000)])
    shards = defaultdict(set)
    for r in sharding.shard_rows(docs, shards=40, vnodes=4).collect():
        shards[r.text_crc32].add(r.shard)
    # a text parts only where a shard fills up, and each interval of the plan has two ends
    assert sum(len(s) > 1 for s in shards.values()) <= 2 * 40 + 160 and sum(len(s) == 1 for s in shards.values()) > 350


def test_sharding_moves_little_when_a_shard_is_added(spark):
    docs = documents(spark, [(i, prose(i, 6)) for i in range(2000)])
    a, b = ({r.doc_id: r.shard for r in sharding.shard_rows(docs, shards=n, vnodes=32).collect()} for n in (10, 11))
    assert sum(a[i] != b[i] for i in a) < 1000


def test_sharding_of_awkward_rows(spark):
    found = sharding.shard_rows(clashing(spark)).collect()
    assert len(found) == len(awkward_rows())
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in found) == Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, *_ in awkward_rows())
    assert {r.law for r in found} == {"rows"} and {r.grown_shard for r in found} == {None}
    assert sharding.shard_rows(empty(spark)).count() == 0


# ---- packing


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=30))
def test_best_fit_packs_everything_without_gaps(waiting):
    plan, n = packing.best_fit(dict(waiting), 64)
    inside, ranks = defaultdict(list), defaultdict(list)
    for length, first, end, sequence, offset in plan:
        ranks[length] += range(first, end)
        for i in range(end - first):
            inside[sequence + i].append((offset, length))
    assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(v)) for k, v in waiting.items()}
    assert sorted(inside) == list(range(n))
    for items in inside.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= 64
    assert sum(sum(length for _, length in items) <= 32 for items in inside.values()) <= 1  # or two could have been one


@given(st.integers(1, 5000))
def test_cut(n):
    pieces = packing.cut(n, 1024)
    assert pieces[0][0] == 0 and sum(length for _, length in pieces) == n and all(length == 1024 for _, length in pieces[1:])
    assert all(a[0] + a[1] == b[0] for a, b in zip(pieces, pieces[1:], strict=False))


def test_packing_round_trip(spark):
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = Counter()
    for doc_id, text, *_ in awkward_rows():
        ids = [*coder.encode(text or "", add_special_tokens=False).ids, 2]
        for k, (start, length) in enumerate(packing.cut(len(ids), 1024)):
            expected[doc_id, k, start, length, zlib.crc32(np.array(ids[start : start + length], dtype="<u4").tobytes())] += 1
    found = packing.pack(clashing(spark), with_ids=True).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == expected
    assert all(zlib.crc32(np.array(r.ids, dtype="<u4").tobytes()) == r.ids_crc32 for r in found)
    by = defaultdict(list)
    for r in found:
        by[r.sequence_id].append((r.offset, r.length))
    for items in by.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(by) == -(-sum(n for *_, n, _ in expected.elements()) // 1024)
    assert packing.pack(empty(spark)).count() == 0


def test_ids_equal_the_tokenizers_library():
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for text in ("<|endoftext|> a", "a  <|endoftext|>  b<|endoftext|><|endoftext|>\n\n", "<|endoftext|", "it's  1٣² ñandú\n\n x", "\U0001f600‍", prose(3, 50).upper(), "a" * 5000):
        assert packing.encoding(packing.VOCABULARY).encode_to_numpy(text, allowed_special="all").tolist() == coder.encode(text, add_special_tokens=False).ids


# ---- fingerprints


@pytest.fixture(scope="module")
def marked(spark):
    rows = [(i * 37, prose(i, 90)) for i in range(60)] + [(5000, prose(3, 90)), (5001, None), (5002, "x"), (5003, ""), (9000, prose(7, 20_000))]
    return rows, {r.doc_id: r for r in fingerprints.fingerprint(documents(spark, rows)).collect()}


def test_edited_texts(marked):
    rows, found = marked
    for k, (doc_id, text) in enumerate(rows):
        own, follower = text or "", rows[(k + 1) % len(rows)][1] or ""
        half = len(own) // 2
        edited = own[: len(own) - half] + follower[:half]
        assert found[doc_id].n_chars == len(own) and found[doc_id].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()


def test_fingerprints_tell_texts_apart(marked):
    rows, found = marked
    assert found[3 * 37].fingerprint == found[5000].fingerprint and found[5001].fingerprint == found[5003].fingerprint
    assert len({r.fingerprint for r in found.values()}) == len({t or "" for _, t in rows})
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found.values())
    prose_rows = [found[i * 37] for i in range(59)]
    assert np.mean([r.near_edited for r in prose_rows]) > np.mean([r.near_next for r in prose_rows])
    assert found[5001].near_edited == 1.0


def test_fingerprints_of_awkward_rows(spark):
    found = fingerprints.fingerprint(clashing(spark)).collect()
    assert len(found) == len(awkward_rows())
    prints = defaultdict(set)
    texts = defaultdict(set)
    for i, t, *_ in awkward_rows():
        texts[i].add(t or "")
    for r in found:
        if r.doc_id is not None:
            for t in texts[r.doc_id]:
                prints[t].add(r.fingerprint)
    assert all(len(v) == 1 for v in prints.values())
    assert fingerprints.fingerprint(empty(spark)).count() == 0
    one = fingerprints.fingerprint(documents(spark, [(4, "only one here")])).collect()
    assert one[0].edited_sha256 == hashlib.sha256(("only one here"[:7] + "only o").encode()).hexdigest() and one[0].near_next == 1.0
