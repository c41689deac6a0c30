import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from trackframe.llm import exact_dedup, line_dedup, near_dedup

from .helpers import awkward, awkward_rows, clashing, documents, empty, prose, words


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def test_exact_dedup_against_brute_force(spark):
    groups = defaultdict(list)
    for doc_id, text, *_ in awkward_rows():
        groups[lower(text)].append(doc_id)
    expected = []
    for doc_id, text, *_ in awkward_rows():
        ids = [i for i in groups[lower(text)] if i is not None]
        keep = max(ids) if ids else None
        expected.append((doc_id, keep, len(groups[lower(text)]), doc_id == keep, hashlib.sha256(lower(text).encode()).hexdigest()))
    found = [tuple(r) for r in exact_dedup.exact_dedup(clashing(spark)).collect()]
    assert sorted(map(str, found)) == sorted(map(str, expected))


def test_exact_dedup_compares_contents_where_digests_collide(spark):
    docs = documents(spark, [(i, f"text {i % 7}") for i in range(60)])
    found = exact_dedup.exact_dedup(docs, digest=lambda c: F.lit("same"), hot_share=0.01, salts=4).collect()
    assert {r.doc_id: (r.keep_id, r.group_size) for r in found} == {i: (max(k for k in range(60) if k % 7 == i % 7), sum(k % 7 == i % 7 for k in range(60))) for i in range(60)}


def test_salting_changes_nothing(spark):
    docs = documents(spark, [(i, "hot" if i % 3 else f"cold {i}") for i in range(300)])
    plain = sorted(map(tuple, exact_dedup.exact_dedup(docs, hot_share=1.0).collect()))
    assert plain == sorted(map(tuple, exact_dedup.exact_dedup(docs, hot_share=0.001, salts=8).collect()))


def test_dropping_exact_duplicates_keeps_columns_and_one_row_each(spark):
    docs = clashing(spark)
    kept = exact_dedup.drop_exact_duplicates(docs)
    assert kept.columns == docs.columns
    texts = [lower(r.text) for r in kept.select("text").collect()]
    assert len(texts) == len(set(texts)) == len({lower(t) for _, t, *_ in awkward_rows()})


def jaccard_components(rows, k, num, den):
    sets = {}
    for doc_id, text in rows:
        w = words(text)
        sets[doc_id] = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    label = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                if label[a] < label[b] and sets[a] and sets[b]:
                    both = len(sets[a] & sets[b])
                    if den * both >= num * (len(sets[a]) + len(sets[b]) - both):
                        label[b] = label[a]
                        changed = True
    return {i: (len(sets[i]), label[i]) for i in sets}


def near_rows():
    rows = []
    for g in range(6):
        base = prose(100 + g, 120).split()
        for c in range(9):
            w = list(base)
            for j in range(c * (g % 3 + 1)):
                w[(j * 13 + c) % len(w)] = f"edit{g}{c}{j}"
            rows.append((len(rows), " ".join(w)))
    rows += [(1000, "one two"), (1001, "ONE two"), (1002, ""), (1003, "one two three"), (1004, " ")]
    return rows


@pytest.mark.parametrize(("k", "num", "den"), [(3, 85, 100), (5, 80, 100)])
def test_near_dedup_against_brute_force(spark, k, num, den):
    rows = near_rows()
    expected = jaccard_components(rows, k, num, den)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_dedup(documents(spark, rows), k=k, num=num, den=den).collect()}
    assert found == expected


def test_near_dedup_splits_large_buckets(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 4)
    monkeypatch.setattr(near_dedup, "CHUNK", 3)
    rows = near_rows()
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_dedup(documents(spark, rows), k=3, num=85, den=100).collect()}
    assert found == jaccard_components(rows, 3, 85, 100)


def test_near_dedup_of_awkward_rows(spark):
    found = near_dedup.near_dedup(clashing(spark), k=3, num=85, den=100).collect()
    assert len(found) == len(awkward_rows())
    by = defaultdict(list)
    for r in found:
        by[r.doc_id].append(r)
    assert all(r.component_id == 1 for i in (1, 2, 3, 4) for r in by[i])
    assert {r.component_id for r in by[None]} == {1, None}
    assert [r.component_id for r in by[5]] == [5] and by[5][0].kept and by[7][0].kept
    assert all(r.kept for r in by[11])
    kept = near_dedup.drop_near_duplicates(clashing(spark), k=3, num=85, den=100)
    assert kept.columns == clashing(spark).columns
    assert sorted(r.doc_id for r in kept.select("doc_id").collect() if r.doc_id is not None) == [1, 5, 6, 7, 8, 9, 10, 11, 11, 12]


def test_full_set_bitmap_never_exceeds_the_difference():
    rng = np.random.default_rng(1)
    for n in (3, 200, 5000):
        a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        b = np.unique(np.concatenate((a[: n // 2], rng.integers(0, 2**63, n, dtype=np.uint64))))
        bits = int(np.bitwise_count((near_dedup.set_sketch(a) ^ near_dedup.set_sketch(b)).view(np.uint64)).sum())
        assert bits <= len(np.setxor1d(a, b))


def test_line_dedup_removes_the_copied_passage_and_nothing_else(spark):
    passage = ". ".join(prose(i, 9).replace(".", "") for i in range(50, 57)) + ".\n"
    rows = [(i, f"{prose(200 + i, 30)}\n{passage}{prose(300 + i, 30)}\nend {i}") for i in range(5)] + [(9, prose(9, 40))]
    found = {r.doc_id: r for r in line_dedup.line_dedup(documents(spark, rows)).collect()}
    assert found[0].text == rows[0][1] and found[9].text == rows[5][1]
    for i in range(1, 5):
        assert found[i].text == rows[i][1].replace(passage, "") and found[i].n_removed >= 1


def test_five_line_passages_go_from_every_later_copy(spark):
    passage = "".join(f"{prose(900 + i, 8).replace('.', '')}\n" for i in range(5))
    rows = [(i, f"{prose(200 + i, 30)}\n{passage}{prose(300 + i, 30)}") for i in range(40)]
    found = {r.doc_id: r.text for r in line_dedup.line_dedup(documents(spark, rows)).collect()}
    assert found[0] == rows[0][1]
    for i in range(1, 40):
        assert found[i] == rows[i][1].replace(passage, "")


def test_passages_inside_lines_lose_their_sentences(spark):
    passage = " ".join(prose(500 + i, 11).replace(".", "").capitalize() + "." for i in range(6))
    rows = [(i, f"{prose(200 + i, 40).replace('.', '')} {passage} {prose(300 + i, 40)}") for i in range(6)]
    found = {r.doc_id: r.text for r in line_dedup.line_dedup(documents(spark, rows)).collect()}
    for i in range(1, 6):
        left = sum(w in found[i].split() for w in set(passage.split()) - set(prose(200 + i, 40).split()) - set(prose(300 + i, 40).split()))
        assert len(rows[i][1].split()) - len(found[i].split()) >= 0.8 * 66 - 11 and left <= 22


def line_dedup_by_hand(rows):
    lines = {}
    for doc_id, text in rows:
        parts, at = [], 0
        for line in re.split(line_dedup.ENDS.replace("\\x0B", "\\x0b"), text):
            if line.strip(" \t\n\x0b\x0c\r"):
                parts.append([at, at + len(line), line.strip(" \t\n\x0b\x0c\r")])
            at += len(line)
        lines[doc_id] = parts
    places = defaultdict(list)
    for doc_id in sorted(lines):
        for k, (p, q) in enumerate(zip(lines[doc_id], lines[doc_id][1:], strict=False)):
            places[p[2], q[2]].append((doc_id, k))
    stays, held = set(), set()
    for found in places.values():
        if len(found) > 1:
            held |= {(d, k + j) for d, k in found for j in (0, 1)}
            stays |= {(found[0][0], found[0][1] + j) for j in (0, 1)}
    out = {}
    for doc_id, text in rows:
        for k in reversed(range(len(lines[doc_id]))):
            if (doc_id, k) in held - stays:
                text = text[: lines[doc_id][k][0]] + text[lines[doc_id][k][1] :]
        out[doc_id] = text
    return out


def test_line_dedup_against_brute_force(spark):
    r = random.Random(5)
    some = [prose(i, 6).replace(".", "") + r.choice(("\n", ". ", "\n\n", "! ", "")) for i in range(30)]
    rows = [(i, "".join(r.choice(some) for _ in range(r.randrange(1, 25)))) for i in range(60)]
    rows += [(100, "same\n" * 40), (101, "same\n" * 41), (102, "\n\n\n"), (103, "".join(f"only {i} of it\n" for i in range(700))), (104, "x\n" + "".join(f"only {i} of it\n" for i in range(700)))]
    found = {r.doc_id: r.text for r in line_dedup.line_dedup(documents(spark, rows)).collect()}
    assert found == line_dedup_by_hand(rows)
    assert found[100] == "same\n" * 2 and found[101] == "\n" and found[104] == "x\n"


def test_line_dedup_of_awkward_rows(spark):
    found = line_dedup.line_dedup(clashing(spark)).collect()
    assert len(found) == len(awkward_rows())
    by = {r.doc_id: r for r in found}
    assert by[5].text is None and by[6].text == "" and by[7].text == " \t\n "
    assert by[1].text == awkward_rows()[0][1] and by[9].text == awkward_rows()[8][1]
    assert by[2].text == ""  # a whole copy goes
    assert by[3].text == awkward_rows()[2][1]  # bytes differ


def test_empty_tables(spark):
    assert exact_dedup.exact_dedup(empty(spark)).count() == 0
    assert exact_dedup.drop_exact_duplicates(empty(spark)).count() == 0
    assert near_dedup.near_dedup(empty(spark)).count() == 0
    assert near_dedup.drop_near_duplicates(empty(spark)).count() == 0
    assert line_dedup.line_dedup(empty(spark)).count() == 0


def test_awkward_is_awkward(spark):
    assert awkward(spark).count() == len(awkward_rows())
