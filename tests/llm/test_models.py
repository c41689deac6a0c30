import math
import random
from collections import Counter, defaultdict

import numpy as np
import zstandard
from pyspark.sql import functions as F

from trackframe.llm import hashing, lang_id, lm_score, recurrent, toxicity
from trackframe.llm.hashing import word_hashes

from .helpers import awkward_rows, clashing, documents, empty, prose, words

EN = "the and of to in that it is was for on are with as his they at be this from have or by one had not but what all were when".split()
DE = "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach".split()


def sentences(seed, vocabulary, n):
    r = random.Random(seed)
    return " ".join(r.choice(vocabulary) for _ in range(n))


def test_language_id_on_held_out_texts(spark):
    rows = [(i, sentences(i, EN if i % 2 else DE, 5 + i % 60), "en" if i % 2 else "de") for i in range(160)]
    model = lang_id.fit(documents(spark, rows[:120]))
    found = {r.doc_id: r for r in lang_id.identify(documents(spark, rows[120:]), model).collect()}
    right = [found[i].lang_pred == lang for i, _, lang in rows[120:]]
    assert sum(right) >= 38 and all(0 <= r.score <= 1 for r in found.values())


def test_language_id_against_sizes_by_hand(spark):
    """Every prediction is the language whose dictionary makes the text's windows smallest, whatever the text's length."""
    rows = [(i, sentences(i, EN if i % 2 else DE, (3, 40, 900)[i % 3]), "en" if i % 2 else "de") for i in range(90)]
    model = lang_id.fit(documents(spark, rows[:60]))
    found = {r.doc_id: r for r in lang_id.identify(documents(spark, rows[60:]), model).collect()}
    for i, text, _ in rows[60:]:
        data, sizes = text.lower().encode(), {}
        for lang, content in zip(model.languages, model.contents, strict=True):
            raw = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            packer = zstandard.ZstdCompressor(level=lang_id.LEVEL, dict_data=raw, write_content_size=False, write_checksum=False, write_dict_id=False)
            sizes[lang] = sum(len(packer.compress(data[k : k + lang_id.WINDOW])) for k in range(0, len(data), lang_id.WINDOW))
        best, second = sorted(sizes.values())[:2]
        assert sizes[found[i].lang_pred] == best
        assert math.isclose(found[i].margin, (second - best) / second) and found[i].rejected == (found[i].margin < lang_id.MARGIN)


def test_wrong_labels_are_cleaned_from_the_sample():
    samples = {"en": [sentences(i, EN, 60).encode() for i in range(40)], "de": [sentences(i, DE, 60).encode() for i in range(36)] + [sentences(90 + i, EN, 60).encode() for i in range(4)]}
    kept = lang_id.cleaned(samples)
    assert len(kept["de"]) == 36 and len(kept["en"]) == 40


def test_language_id_of_awkward_rows(spark):
    docs = clashing(spark)
    model = lang_id.fit(docs)
    found = lang_id.identify(docs, model).collect()
    assert len(found) == len(awkward_rows())
    by = {r.doc_id: r for r in found}
    assert all(by[i].lang_pred == "und" and by[i].score == 0 and by[i].rejected for i in (5, 6, 7, 10))
    assert by[9].lang_pred in ("en", "de")
    assert lang_id.accepted(docs, model).columns == docs.columns
    assert lang_id.identify(empty(spark), model).count() == 0
    nothing = lang_id.fit(empty(spark))
    assert {r.lang_pred for r in lang_id.identify(docs, nothing).collect()} == {"und"}


def toxic_rows():
    rows, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        w = prose(i, 40).split()
        if bad:
            w[7], w[21] = "grubworm" + random.Random(i).choice(("", "s", "ish")), "MUDHEAD!!"
        rows.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    return rows, labels


def test_toxicity_on_held_out_rows(spark):
    rows, labels = toxic_rows()
    docs = documents(spark, rows)
    marked = spark.createDataFrame(labels[:300], "doc_id long, toxic int")
    model = toxicity.fit(docs, marked)
    found = {r.doc_id: r for r in toxicity.toxicity(docs, model).collect()}
    assert len(found) == 400 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in found.values())
    assert sum(found[i].predicted == y for i, y in labels[300:]) >= 98
    unseen = toxicity.toxicity(documents(spark, [(1, prose(5, 30) + " grubwormlike"), (2, prose(5, 30))]), model).orderBy("doc_id").collect()
    assert unseen[0].score > unseen[1].score  # by its expression


def kneser_ney_by_hand(rows):
    """rows: (text, model). How much likelier a word is in model 0 than in the mean of the others."""
    d_word, d_part = toxicity.DISCOUNTS
    pairs = defaultdict(set)
    for text, model in rows:
        w = "".join(c if c.isalnum() or ord(c) > 127 else " " for c in text.lower()).split()
        pairs[model] |= set(zip(w, ["", *w]))
    part = lambda w: w.encode()[: toxicity.PREFIX]
    words = {m: Counter(w for w, _ in s) for m, s in pairs.items()}
    parts = {m: Counter(p for p, _ in {(part(w), v) for w, v in s}) for m, s in pairs.items()}
    both, both_parts = sum(words.values(), Counter()), sum(parts.values(), Counter())
    of_part = Counter()
    for w, n in both.items():
        of_part[part(w)] += n

    def p(m, w):
        free = lambda c, d: sum(min(n, d) for n in c.values()) / sum(c.values())
        shared = (both_parts[part(w)] + 0.5) / (sum(both_parts.values()) + 1)
        low = max(parts[m][part(w)] - d_part, 0) / sum(parts[m].values()) + free(parts[m], d_part) * shared
        return max(words[m][w] - d_word, 0) / sum(words[m].values()) + free(words[m], d_word) * low * (both[w] + 0.5) / (of_part[part(w)] + 1)

    others = [m for m in pairs if m]
    return {w: math.log(p(0, w) / (sum(p(m, w) for m in others) / len(others))) for w in both}


def test_kneser_ney_against_brute_force(spark):
    rows = [(sentences(i, EN + DE[:6] if i % 4 else DE + ["grubworm", "grubworms", "Grubby!"], 25), 0 if i % 4 == 0 else 1 + i % 3) for i in range(80)]
    model = toxicity.kneser_ney(spark.createDataFrame(rows, "text string, model int"))
    expected = kneser_ney_by_hand(rows)
    assert len(expected) > 40 and max(expected.values()) > 1
    for w, gain in expected.items():
        assert math.isclose(model.gains(w)[0], gain, rel_tol=1e-6, abs_tol=1e-9), w
    text = "the grubworm der unknownword"
    beyond = [math.copysign(max(abs(g) - toxicity.MARGIN, 0), g) for g in (*(expected[w] for w in text.split()[:3]), model.other)]
    assert math.isclose(model.measure(text), sum(beyond) / 4, rel_tol=1e-6)


def test_toxicity_of_awkward_rows(spark):
    docs = clashing(spark)
    labels = spark.createDataFrame([(1, 1), (3, 0), (None, 1), (8, None), (9, 0), (11, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    found = toxicity.toxicity(docs, model).collect()
    assert len(found) == len(awkward_rows()) and all(r.score is not None and 0 <= r.score <= 1 for r in found)
    one = toxicity.fit(docs, labels.where("toxic = 1"))
    assert {r.predicted for r in toxicity.toxicity(docs, one).collect()} == {1}
    none = toxicity.fit(docs, labels.limit(0))
    assert {r.predicted for r in toxicity.toxicity(docs, none).collect()} == {0}
    assert toxicity.toxicity(empty(spark), model).count() == 0
    assert toxicity.fit(empty(spark), labels) is not None


SMALL = {"shape": recurrent.Shape(hidden=8, classes=4, width=4, tails=8), "replica_tokens": 4000}


def test_lm_counts_and_base_score_against_brute_force(spark):
    rows = [(i, sentences(i, EN if i % 2 else DE, 3 + i % 40) + f" rare{i % 9} only{i}") for i in range(200)] + [(500, None), (501, ""), (502, "unseenword THE the")]
    train = [r for r in rows if r[0] % 5]
    model = lm_score.fit(documents(spark, train), share_of_common=0.004, **SMALL)  # most words are rare here and take the join
    found = {r.doc_id: r for r in lm_score.lm_score(documents(spark, rows), model).collect()}
    counts = Counter()
    for _, t in train:
        counts.update([*words(t), None])
    n, v = sum(counts.values()), len(counts)
    for i, t in rows:
        tokens = [*words(t), None]
        assert found[i].train_tokens == n and found[i].n_tokens == len(tokens)
        assert found[i].n_known == sum(counts[w] > 0 for w in tokens)
        assert math.isclose(found[i].base_score, sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens), rel_tol=1e-9)
        assert found[i].score < 0
    held = [r for i, r in found.items() if i < 200 and not i % 5]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_lm_probabilities_sum_to_one(spark):
    """Next-word probabilities over every word that training has seen, the end, and one unseen word a bucket."""
    rows = [(i, sentences(i, EN + [f"t{k}" for k in range(30)], 20)) for i in range(60)]
    model = lm_score.fit(documents(spark, rows), **SMALL)
    shape, vocabulary = model.shape, sorted({w for _, t in rows for w in words(t)})
    context = model.encode(["the and of"])[0][0][:-1]
    state = recurrent.run_window(model.weights, np.concatenate(([0], context))[:, None].astype(np.int32), np.zeros((1, shape.hidden), np.float32))[-1]

    def of(target):
        return float(np.exp(recurrent.outputs(shape, model.weights, state, np.array([target]))[0][0]))

    total = of(lm_score.END)
    for w in vocabulary:
        (ids,), _, _, counts, _ = model.encode([w.decode()])
        total += of(ids[0]) * (1 if ids[0] < shape.head else 10 ** (model.log_share(counts)[0] - model.tails[ids[0] - shape.head]))
    for k in range(shape.tails):
        total += of(shape.head + k) * 10 ** (model.log_share(np.array([0]))[0] - model.tails[k])
    unused = sum(of(i) for i in range(shape.head) if i > (model.heads > 0).sum())
    assert math.isclose(total + unused, 1.0, rel_tol=1e-4)


def test_lm_trains_on_every_document(spark):
    """More tokens than a sample would hold, and copies, each in one of the rounds."""
    long = spark.range(80).select(F.concat(F.repeat(F.lit("one two of "), 7000), F.col("id") % 70).alias("text"))
    docs = long.union(documents(spark, [(1, "the end"), (2, "the end"), (3, None)]).select("text"))
    model = lm_score.fit(docs, shape=SMALL["shape"], replica_tokens=200_000)
    assert model.tokens == 80 * 21_002 + 7 and sum(model.trained) == model.tokens and len(model.trained) == lm_score.ROUNDS


def test_lm_of_awkward_rows(spark):
    docs = clashing(spark)
    model = lm_score.fit(docs, **SMALL)
    found = lm_score.lm_score(docs, model).collect()
    assert len(found) == len(awkward_rows())
    by = {r.doc_id: r for r in found}
    assert by[5].n_tokens == by[6].n_tokens == by[7].n_tokens == 1 and by[5].score == by[6].score
    assert by[9].n_tokens == 30_001 and math.isfinite(by[9].score)
    assert lm_score.lm_score(empty(spark), model).count() == 0
    nothing = lm_score.fit(empty(spark), **SMALL)
    assert {r.n_known for r in lm_score.lm_score(docs, nothing).collect()} == {0}


def test_recurrent_gradients_match_differences():
    shape = recurrent.Shape(hidden=5, classes=3, width=3, tails=2)
    rng = np.random.default_rng(3)
    p = {k: v.astype(np.float32) for k, v in recurrent.initial(shape, np.ones(shape.inputs)).items()}
    states, targets = rng.normal(size=(7, 5)).astype(np.float32), rng.integers(0, shape.inputs, 7)
    g = {k: np.zeros_like(p[k]) for k in ("c", "cb", "w", "wb")}
    _, back = recurrent.outputs(shape, p, states, targets, g)
    for array, gradient in ((p["c"], g["c"]), (p["w"], g["w"]), (states, back)):
        at = tuple(s // 2 for s in array.shape)
        keep = array[at]
        array[at] = keep + 1e-2
        up = -recurrent.outputs(shape, p, states, targets)[0].sum()
        array[at] = keep - 1e-2
        down = -recurrent.outputs(shape, p, states, targets)[0].sum()
        array[at] = keep
        assert math.isclose((up - down) / 2e-2, gradient[at], rel_tol=2e-2, abs_tol=2e-3)


def test_backpropagation_through_time_matches_differences():
    """One window of training with a rate of 1e-4: how the weights move tells the gradient of each, recurrent ones included."""
    shape = recurrent.Shape(hidden=4, classes=2, width=3, tails=2)
    rng = np.random.default_rng(4)
    p = {k: (v * 5 if k in "xu" else v).astype(np.float64) for k, v in recurrent.initial(shape, np.ones(shape.inputs)).items()}
    ids = np.append(rng.integers(1, shape.inputs, 19), 0).astype(np.int32)
    loss = lambda q: -recurrent.score(shape, q, [ids], 0)[0]
    moved = {k: v.copy() for k, v in p.items()}
    recurrent.train(shape, moved, {k: np.ones_like(v) for k, v in p.items()}, [ids], 0, rate=1e-4, streams=1)
    for name, at in (("u", (1, 2)), ("u", (0, 5)), ("u", (3, 9)), ("x", (0, 1)), ("x", (int(ids[3]), 6)), ("x", (int(ids[5]), 10)), ("c", (2, 1)), ("w", (1, 0, 2)), ("wb", (0, 1))):
        step = (p[name][at] - moved[name][at]) / 1e-4  # g / sqrt(1 + g * g)
        keep = p[name][at]
        p[name][at] = keep + 1e-2
        up = loss(p)
        p[name][at] = keep - 1e-2
        slope = (up - loss(p)) / 2e-2
        p[name][at] = keep
        assert math.isclose(step, slope / math.sqrt(1 + slope * slope), rel_tol=3e-2, abs_tol=2e-4), (name, at)


def test_outputs_take_two_softmaxes_a_block_whatever_the_classes(monkeypatch):
    """Against softmaxes written out row by row, over blocks that begin and end within classes; one exponential for all classes of a block."""
    shape = recurrent.Shape(hidden=6, classes=9, width=4, tails=5)
    rng = np.random.default_rng(6)
    p = {k: rng.normal(size=v.shape).astype(np.float32) for k, v in recurrent.initial(shape, np.ones(shape.inputs)).items()}
    states, targets = rng.uniform(-1, 1, (90, 6)).astype(np.float32), rng.integers(0, shape.inputs, 90).astype(np.int16)
    targets[:20] = 7  # more than a block of one word
    calls, softmax = [], recurrent._softmax
    monkeypatch.setattr(recurrent, "_softmax", lambda *a: calls.append(1) or softmax(*a))
    monkeypatch.setattr(recurrent, "ROWS", 16)
    found = recurrent.outputs(shape, p, states, targets)[0]
    log = lambda v: v - np.log(np.exp(v).sum())
    for s, t, one in zip(states.astype(float), targets.tolist(), found, strict=True):
        k, j = divmod(t, shape.width)
        outer = log(s @ p["c"] + p["cb"])
        expected = outer[k] + log(s @ p["w"][k] + p["wb"][k])[j] if t < shape.head else outer[t - shape.head + shape.classes]
        assert math.isclose(one, expected, rel_tol=1e-4)
    assert len(calls) <= 2 * math.ceil(90 / 16)


def test_rows_of_an_id_are_summed():
    rng = np.random.default_rng(7)
    for ids in (rng.zipf(1.4, 500) % 300, np.arange(9)[::-1].copy(), np.full(40, 70_000)):
        values = rng.normal(size=(3, len(ids), 5))
        found, sums = recurrent._summed(ids, values)
        assert found.tolist() == sorted(set(ids.tolist()))
        assert np.allclose(sums, np.stack([values[:, ids == i].sum(axis=1) for i in found], axis=1))


def test_scores_follow_the_definition_step_by_step():
    """Documents of all lengths in few streams, so that streams end within windows, with ids of 16 bits as they are staged."""
    shape = recurrent.Shape(hidden=4, classes=3, width=3, tails=2)
    p = recurrent.initial(shape, np.ones(shape.inputs))
    rng = np.random.default_rng(8)
    documents_ = [np.append(rng.integers(1, shape.inputs, n), 0).astype(np.int16) for n in (0, 1, 31, 32, 33, 64, 70)]
    for found, ids in zip(recurrent.score(shape, p, documents_, 0, streams=3), documents_, strict=True):
        state, total = np.zeros((1, 4), dtype=np.float32), 0.0
        for before, target in zip([0, *ids[:-1].tolist()], ids.tolist(), strict=True):
            state = recurrent.run_window(p, np.array([[before]]), state)[-1]
            total += float(recurrent.outputs(shape, p, state, np.array([target]))[0][0])
        assert math.isclose(found, total, rel_tol=1e-5)


def test_long_texts_are_hashed_in_blocks(monkeypatch):
    text = prose(8, 3000) + " " + "x" * 5000 + " end"
    whole = hashing.word_and_part_hashes(text, 2, False)
    monkeypatch.setattr(hashing, "BLOCK", 700)
    assert all(np.array_equal(a, b) for a, b in zip(whole, hashing.word_and_part_hashes(text, 2, False), strict=True))


def test_joined_texts_are_hashed_as_each_by_itself(monkeypatch):
    texts = [None, "", " ", "One two", "\nTHREE\t", "", "x" * 900, "a\x0bb c\u00a0d \u00c4rger", prose(3, 400), "end"]
    alone = [hashing.word_and_part_hashes(t, 2, False) for t in texts]
    for size in (1 << 15, 64):
        monkeypatch.setattr(hashing, "JOINED", size)
        words, parts, lengths = hashing.words_of_texts(texts, 2, False)
        assert lengths.tolist() == [len(w) for w, _ in alone]
        assert np.array_equal(words, np.concatenate([w for w, _ in alone])) and np.array_equal(parts, np.concatenate([p for _, p in alone]))
    assert [len(c) for c in hashing.words_of_texts([], 2, False)] == [0, 0, 0]


def test_scores_do_not_depend_on_company():
    shape = recurrent.Shape(hidden=6, classes=3, width=3, tails=2)
    p = recurrent.initial(shape, np.ones(shape.inputs))
    rng = np.random.default_rng(5)
    documents_ = [np.append(rng.integers(1, shape.inputs, n), 0).astype(np.int32) for n in (0, 3, 31, 32, 33, 100)]
    together = recurrent.score(shape, p, documents_, 0)
    alone = [recurrent.score(shape, p, [d], 0)[0] for d in documents_]
    assert np.allclose(together, alone, rtol=1e-4)


def test_words_are_hashed_apart():
    a = word_hashes("The cat  sat\ton THE mat x")
    assert len(a) == 6 and a[0] == a[4] and len(set(a.tolist())) == 5
