import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from trackframe.functions import dates, numbers, paths, texts
from trackframe.operators import detect, evaluate, labelsets, naming, progress, ranges, reconcile, sampling, select, series, trajectory

PRED = "video string, frame long, individual string, bodypart string, x double, y double, likelihood double"
NAN = float("nan")


def frames(df):
    return sorted(r.frame for r in df.collect())


def single(spark, values, start=0, p=None, part="bp0"):
    return spark.createDataFrame([("v", start + i, "a", part, float(x), 0.0, 0.9 if p is None else p[i]) for i, x in enumerate(values)], PRED)


# ---- detection


def test_uncertain_frames_keep_their_labels(spark):
    rows = single(spark, [0] * 4, 10, [0.9, 0.3, 0.9, NAN]).unionByName(single(spark, [0] * 4, 10, [0.9, 0.9, 0.9, 0.4], "bp1"))
    assert frames(detect.uncertain_outliers(rows, 0.5)) == [11, 13]
    assert frames(detect.uncertain_outliers(rows, 0.1)) == []


def test_jumps(spark):
    assert frames(detect.jump_outliers(single(spark, [0, 0, 10, 10]), 5)) == [2]
    assert frames(detect.jump_outliers(single(spark, [0, 0, 100, 0]), 5)) == [2, 3]
    assert frames(detect.jump_outliers(single(spark, [0, 0, 10, NAN, 10]), 5, colocate=False)) == [2]
    assert frames(detect.jump_outliers(single(spark, [0] * 3, p=[0.1, 0.9, 0.2]), 1)) == []


def test_jumps_sum_over_individuals(spark):
    rows = [("v", f, who, "nose", x if f == 2 and who == "a" else 0.0, y if f == 2 and who == "b" else 0.0, 0.9) for f in range(3) for who in "ab" for x, y in [(3.0, 4.0)]]
    df = spark.createDataFrame(rows, PRED)
    assert frames(detect.jump_outliers(df, 4)) == [2] and frames(detect.jump_outliers(df, 6)) == []


def test_list_is_sorted_and_distinct(spark):
    assert [r.frame for r in detect.list_outliers(spark.createDataFrame([("v",)], "video string"), [3, 1, 2, 1]).orderBy("frame").collect()] == [1, 2, 3]


@pytest.mark.parametrize(
    ("values", "k", "t", "expected"),
    [([1, 10, 2, 20], 2, 5, [1, 3]), ([2, 3, 4, 5, 6], 1, 1, [0, 1, 2, 3, 4]), ([1, 100, 2, 50, 3], 1, 1000, [1, 3]), ([NAN, 6, NAN], 1, 5, [0, 2]), ([NAN, 6, NAN], 2, 1, [1])],
)
def test_deviations(spark, values, k, t, expected):
    df = spark.createDataFrame([("v", i, float(v)) for i, v in enumerate(values)], "video string, frame long, deviation double")
    assert sorted(r.position for r in detect.deviation_outliers(df, k, t).collect()) == expected


def test_nan_mean(spark):
    df = spark.createDataFrame([("v", 0, NAN), ("v", 0, NAN), ("v", 1, 5.0), ("v", 1, 7.0), ("v", 2, NAN), ("v", 2, 3.0)], "video string, frame long, deviation double")
    found = {r.frame: r.deviation for r in detect.nanmean_deviation(df).collect()}
    assert math.isnan(found[0]) and found[1] == 6 and found[2] == 3


def test_trajectory_departure_is_found_and_failure_is_nan(spark):
    t = np.arange(120)
    x = 50 + 20 * np.sin(t / 6)
    x[60] += 90
    df = single(spark, x)
    found = trajectory.arma_deviation(df).orderBy(F.col("deviation").desc()).limit(2).collect()
    assert found[0].frame == 60 and found[0].deviation > 60
    assert np.isnan(trajectory.arma_residuals(np.array([1.0, 2.0]), np.array([True, True]), 3, 1)).all()
    assert frames(trajectory.fitting_outliers(single(spark, x, 1000), 1, 60.0, index_base="label"))[0] == 1060
    assert 60 in frames(trajectory.fitting_outliers(single(spark, x, 1000), 1, 60.0))


def test_detect_refuses_contradictions(spark):
    rows = single(spark, [0, 0, 10])
    for bad in ({"step": 0}, {"algorithm": "list"}, {"algorithm": "other"}):
        with pytest.raises(ValueError):
            detect.detect_outliers(rows, **bad)


# ---- series


def counts(spark, n):
    return spark.createDataFrame([("v", n)], "video string, frame_count long")


@pytest.mark.parametrize(("n", "start", "stop", "step", "expected"), [(100, 0.0, 1.0, 2, list(range(0, 100, 2))), (100, 0.1, 0.5, 1, list(range(10, 50))), (0, 0.0, 1.0, 1, [])])
def test_generated_candidates(spark, n, start, stop, step, expected):
    assert frames(series.candidate_range(counts(spark, n), start, stop, step)) == expected


@pytest.mark.parametrize(("given", "start", "stop", "expected"), [([0, 5, 50, 99, 100, 150], 0.0, 1.0, [5, 50, 99]), ([5, 10, 11, 49, 50, 60], 0.1, 0.5, [11, 49])])
def test_given_candidates_lie_strictly_inside(spark, given, start, stop, expected):
    df = spark.createDataFrame([("v", f) for f in given], "video string, frame long")
    assert frames(series.candidate_window_crop(df, counts(spark, 100), start, stop)) == expected


def test_windows_strides_and_totals(spark):
    df = spark.createDataFrame([("v", f) for f in range(4)], "video string, frame long")
    assert frames(series.frame_window(df, 0.25, 0.75)) == [1, 2]
    six = spark.createDataFrame([("v", f) for f in range(6)], "video string, frame long")
    assert frames(series.candidate_stride(six, 2)) == [0, 2, 4]
    assert [series.clustering_totals(counts(spark, n), 0.0, 1.0, s).first().total for n, s in ((100, 3), (0, 1))] == [34, 1]


@pytest.mark.parametrize(("given", "dense"), [([5], False), ([0, 1, 2], True), ([0, 200], True), ([0, 201], False)])
def test_density(spark, given, dense):
    df = spark.createDataFrame([("v", f) for f in given], "video string, frame long")
    assert series.candidate_density(df).first().stream == dense


def test_crops(spark):
    df = spark.createDataFrame([("v", 0, "a", "n", 0.0, 0.0, 0.0)], PRED)
    metadata = spark.createDataFrame([("v", True, 10, 10)], "video string, cropped boolean, x1 int, y1 int")
    config = spark.createDataFrame([("v", "5, 100, 5, 100"), ("w", "bad")], "video string, crop string")
    moved = series.crop_offset(df.where("true"), metadata, config.where("video = 'v'")).first()
    assert (moved.x, moved.y) == (5.0, 5.0)
    got = spark.createDataFrame([("0, 640, 0, 480",), ("a, 1, 2, 3",), ("1, 2, 3",), (None,), ("5, 5, 0, 1",)], "c string").select(paths.parse_crop(F.col("c")).alias("c")).collect()
    assert [r.c for r in got] == [[0, 640, 0, 480], None, None, None, [5, 5, 0, 1]]
    one = spark.createDataFrame([("5, 5, 0, 1",)], "c string")
    assert one.select(paths.parse_crop(F.col("c"), "error").alias("c")).first().c == [5, 5, 0, 1]
    with pytest.raises(Exception, match="without area"):
        one.select(paths.parse_crop(F.col("c"), "positive")).collect()
    with pytest.raises(Exception, match="malformed"):
        spark.createDataFrame([("x",)], "c string").select(paths.parse_crop(F.col("c"), "error")).collect()


# ---- selection


def test_selection(spark):
    df = spark.createDataFrame([("v", f) for f in range(0, 100, 10)], "video string, frame long")
    assert frames(select.uniform_selection(df, 4)) == [0, 30, 60, 90] and frames(select.uniform_selection(df, 20)) == list(range(0, 100, 10)) and frames(select.uniform_selection(df, 1)) == [0]
    rows = [("v", i, [float(i // 10 * 100), float(i % 3)]) for i in range(40)]
    features = spark.createDataFrame(rows, "video string, frame long, features array<double>")
    chosen = frames(select.kmeans_representatives(features, 4, seed=3))
    assert 1 <= len(chosen) <= 4 and chosen == frames(select.kmeans_representatives(features, 4, seed=3))
    assert frames(select.kmeans_representatives(features.where("frame < 3"), 4)) == [0, 1, 2]


def test_kmeans_iterations_are_passes_over_all_rows():
    data = np.concatenate((np.random.default_rng(1).normal(0, 0.1, 500), np.random.default_rng(2).normal(10, 0.1, 500)))[:, None]
    for seed in range(10):  # centers that begin in one group part only if the rows of both are visited
        labels = select.kmeans(data, 2, 1, 1, np.random.default_rng(seed))
        assert len(set(labels[:500])) == len(set(labels[500:])) == 1 and labels[0] != labels[-1]


# ---- label sets


def test_label_sets(spark):
    disk = spark.createDataFrame([("v", f"img{i}") for i in range(4)], "video string, image string")
    human = spark.createDataFrame([("v", "img0", 1.0, 2.0), ("v", "img2", NAN, NAN), ("v", "img9", NAN, 1.0)], "video string, image string, x double, y double")
    machine = spark.createDataFrame([("v", 0, "img1"), ("v", 1, "img2")], "video string, iteration int, image string")
    names = lambda df: sorted(r.image for r in df.collect())
    assert names(labelsets.finite_labels(human)) == ["img0", "img9"]
    assert names(labelsets.bare_frames(disk, human, machine.where("iteration = 0"))) == ["img2", "img3"]
    assert names(labelsets.removable_outliers(machine, human, 1)) == ["img2"]
    assert labelsets.pending_refinement(machine, human, human.limit(0), 0).collect()[0].pending == 1
    assert tuple(labelsets.purge_preview(disk, human).first()) == (1, 1, 4)
    listing = spark.createDataFrame([("v", True, False), ("v_labeled", True, False), (".h", True, False), ("l", True, True), ("f", False, False)], "name string, is_dir boolean, is_link boolean")
    assert [r.name for r in labelsets.real_directories(listing).collect()] == ["v"]


# ---- naming


@pytest.mark.parametrize(
    ("name", "key"),
    [
        ("M01_2024-01-15", "M01"), ("2024-01-15_M01", "M01"), ("2024-01-15_09-30-00_M01", "M01"), ("M01_20240115T093000", "M01"), ("2024-01-15T09-30-00_M01", "M01"), ("MF_11_2025_07_21", "MF_11"),
        ("20240115T093000", None), ("2024-01-15", None), ("___", None), ("Mouse_Session_1", None), ("15Jan2024_M1", "M1"), ("M1_Jan_2024", "M1"), ("M1_Jan_23", None), ("M2_15_Sept_24", "M2"),
        ("M3_01152024", "M3"), ("M4_31_12_2023", "M4"), ("M5_2024Jan", "M5"), ("M6_2024_13_40", None),
    ],
)
def test_keys_beside_dates(spark, name, key):
    assert spark.createDataFrame([(name,)], "s string").select(dates.group_key(F.col("s")).alias("k")).first().k == key


@pytest.mark.parametrize(("pattern", "stem", "key"), [(r"(M\d+)", "a_M12", "M12"), (r"M\d+", "a_M12", "M12"), (r"M(\d+)?", "Mouse", "M"), (r"Z+", "Mouse", "Mouse"), ("x*", "abc", "abc"), (r"(\d*)", "abc", "abc")])
def test_patterns(spark, pattern, stem, key):
    videos = spark.createDataFrame([(0, f"/d/{stem}.mp4")], "ord long, path string")
    assert naming.pattern_groups(videos, pattern).first().group == key


def test_bad_pattern_is_refused(spark):
    with pytest.raises(Exception, match="unterminated|missing"):
        naming.pattern_groups(spark.createDataFrame([(0, "a")], "ord long, path string"), "(")


def test_paths(spark):
    df = spark.createDataFrame([("/p/labeled-data/vidX/img1.png",), ("/p/labeled-data",), ("/p/other/img1.png",)], "p string").select(paths.relative_image(F.col("p")).alias("r")).collect()
    assert [tuple(r.r) for r in df] == [("vidX", "labeled-data/vidX/img1.png"), ("", "labeled-data"), ("other", "img1.png")]
    one = spark.createDataFrame([("/a/b.c/clip.x.MP4", "dlc-shuffle12/y")], "p string, q string")
    got = one.select(paths.stem(F.col("p")), paths.suffix(F.col("p")), paths.parent(F.col("p")), paths.shuffle_number(F.col("q"))).first()
    assert tuple(got) == ("clip.x", ".MP4", "/a/b.c", 12)


# ---- sampling

CAND = "video string, ord long, group string, existing long, pinned boolean"


def cand(spark, *rows):
    return spark.createDataFrame([(v, i, g, e, p) for i, (v, g, e, p) in enumerate(rows)], CAND)


@pytest.mark.parametrize(
    ("rows", "budget", "expected"),
    [
        ([(v, None, 0, False) for v in "abcd"], 25, "abc"), ([("a", None, 5, False), ("b", None, 0, False)], 20, "ab"), ([("a", None, 20, False)], 5, ""), ([("a", None, 0, False)], 25, "a"),
        ([("a", None, 0, True), ("b", None, 0, False)], 5, "a"),
    ],
)
def test_uniform_fill(spark, rows, budget, expected):
    assert "".join(sorted(r.video for r in sampling.uniform_fill(cand(spark, *rows), 10, budget).collect())) == expected


def greedy(rows, ceiling, budget):
    cap = {v: max(0, ceiling - e) for v, _, e, _ in rows}
    left = budget - sum(e for _, _, e, _ in rows)
    if left <= 0:
        return set()
    chosen, total = {v for v, _, _, p in rows if p}, sum(cap[v] for v, _, _, p in rows if p)
    groups = sorted({g for _, g, _, _ in rows if g})
    queue = {g: [v for v, h, e, p in rows if h == g and e > 0 and cap[v] and not p] + [v for v, h, e, p in rows if h == g and e == 0 and not p] for g in groups}
    covered = {g: sum(e + (cap[v] if p else 0) for v, h, e, p in rows if h == g) for g in groups}
    while total < left and any(queue.values()):
        g = min((g for g in groups if queue[g]), key=lambda g: (covered[g], g))
        v = queue[g].pop()
        chosen.add(v)
        total += cap[v]
        covered[g] += cap[v]
    return chosen


@pytest.mark.parametrize("seed", range(6))
def test_balanced_fill_equals_the_greedy_choice(spark, seed):
    rng = np.random.default_rng(seed)
    rows = [(f"v{i:02d}", f"g{rng.integers(4)}", int(rng.choice([0, 0, 3, 7, 10])), bool(rng.random() < 0.1)) for i in range(30)]
    budget = int(sum(e for _, _, e, _ in rows) + rng.integers(1, 160))
    found = sampling.balanced_fill(cand(spark, *rows), 10, budget)
    assert {r.video for r in found.collect()} == greedy(rows, 10, budget)


def test_balanced_coverage(spark):
    rows = cand(spark, ("a", "g1", 0, False), ("b", "g1", 0, False), ("c", "g2", 0, False), ("d", "g2", 0, False))
    chosen = sampling.balanced_fill(rows, 10, 20)
    assert {r.video for r in chosen.collect()} == {"b", "d"}
    assert sorted(map(tuple, sampling.per_group_coverage(rows, chosen, 10).collect())) == [("g1", 0, 1, 10, 2), ("g2", 0, 1, 10, 2)]
    status = sampling.budget_status(cand(spark, ("a", None, 0, True)), 10, 5).first()
    assert (status.met, status.unreachable, status.overshoot) == (False, False, True)


# ---- ranges


@pytest.mark.parametrize(
    ("total", "chunks", "expected"),
    [(100, 1, [(0, 100)]), (100, 0, [(0, 100)]), (100, 4, [(0, 25), (25, 50), (50, 75), (75, 100)]), (10, 4, [(0, 3), (3, 6), (6, 8), (8, 10)]), (3, 5, [(0, 1), (1, 2), (2, 3)]), (1, 4, [(0, 1)])],
)
def test_ranges(spark, total, chunks, expected):
    assert sorted((r.start, r.end) for r in ranges.frame_ranges(counts(spark, total), chunks).collect()) == expected


def test_integrity_and_stitching(spark):
    r = ranges.frame_ranges(spark.createDataFrame([("v", 10), ("w", 10)], "video string, frame_count long"), 2)
    results = spark.createDataFrame([("v", 0, 5, None), ("v", 1, 5, None), ("w", 0, 4, None), ("w", 1, 5, "late")], "video string, chunk long, rows long, error string")
    found = {x.video: x for x in ranges.chunk_integrity(r, results).collect()}
    assert found["v"].complete and not found["w"].complete and found["w"].first_error == "short"
    rows = spark.createDataFrame([("v", 1, 1.0), ("v", 0, 0.0), ("w", 0, 9.0)], "video string, frame long, x double")
    assert {x.video for x in ranges.stitch(rows, ranges.chunk_integrity(r, results)).collect()} == {"v"}
    assert {x.video: x["values"] for x in ranges.ordered_values(rows, "x").collect()}["v"] == [0.0, 1.0]


# ---- evaluation


def test_tidy_rows(spark):
    schema = "split string, video string, image string, individual string, bodypart string, x double, y double, likelihood double, gt_x double, gt_y double, v int"
    rows = [("train", "vid", "i", "a", "nose", 11.0, 10.0, 0.85, 10.0, 10.0, 2), ("train", "vid", "i", "a", "tail", 19.0, 21.0, 0.8, 20.0, 20.0, 0), ("test", "vid", "j", "a", "nose", 3.0, 4.0, 0.9, 0.0, 0.0, 2)]
    tidy = evaluate.evaluation_tidy(spark.createDataFrame(rows, schema), 0.85)
    got = {(r.image, r.bodypart): r for r in tidy.collect()}
    assert got["i", "nose"].error_px == 1 and got["i", "nose"].above_pcutoff and math.isnan(got["i", "tail"].error_px) and not got["i", "tail"].above_pcutoff
    assert evaluate.generalization_gap(tidy).first().gap == 4.0
    assert {r.split: r.images for r in evaluate.split_metrics(tidy).collect()} == {"train": 1, "test": 1}


def test_worst_keypoints(spark):
    values = [("b0", 1.0), ("b1", 9.0), ("b2", NAN), ("b3", 5.0), ("b4", 7.0), ("b5", 3.0), ("b6", 8.0), ("b7", None)]
    found = evaluate.worst_keypoints(spark.createDataFrame(values, "bodypart string, rmse double")).collect()
    assert [r.bodypart for r in found] == ["b1", "b6", "b4", "b3", "b5"]


def test_matching_and_precision(spark):
    schema = "image string, individual string, bodypart string, x double, y double, likelihood double, gt_x double, gt_y double, v int"
    rows = []
    for k in range(4):
        for who, dx in (("a", 0.0), ("b", 50.0)):
            for part, at in (("n", 0.0), ("t", 20.0)):
                rows.append((f"i{k}", who, part, dx + at + (0.1 if who == "a" else 0), dx + at, 0.9, dx + at, dx + at, 2))
    matches = evaluate.image_matches(spark.createDataFrame(rows, schema))
    assert all(r.oks > 0.9 for r in matches.collect())
    found = evaluate.average_precision(matches).first()
    assert found["map"] > 0.95 and found.mar > 0.95


def test_matching_runs_in_spark_and_equals_the_greedy_choice(spark):
    random = np.random.default_rng(5)
    schema = "image string, individual long, bodypart string, x double, y double, likelihood double, gt_x double, gt_y double, v int"
    rows, odd = [], (None, NAN, float("inf"))
    for image in range(60):
        for who in range(image % 6):
            for part in range(4):
                if random.random() < 0.8:
                    x, y, gx, gy = (float(v) if random.random() < 0.9 else odd[random.integers(3)] for v in random.integers(0, 30, 4))
                    likelihood = float(random.integers(0, 3)) / 4 if random.random() < 0.8 else odd[random.integers(2)]
                    rows.append((f"i{image}", who, f"b{part}", x, y, likelihood, gx, gy, int(random.integers(0, 3))))
    found = evaluate.image_matches(spark.createDataFrame([*rows, ("i3", None, "b0", 1.0, 1.0, 0.9, 1.0, 1.0, 2)], schema))
    assert "Python" not in (plan := found._jdf.queryExecution().executedPlan().toString()) and "Pandas" not in plan
    got = {(r.image, r.individual): r for r in found.collect()}
    assert set(got) == {(r[0], r[1]) for r in rows}
    for image in {r[0] for r in rows}:
        names = sorted({r[1] for r in rows if r[0] == image})
        cells = {(r[1], r[2]): [NAN if v is None else v for v in r[3:]] for r in rows if r[0] == image}
        own = [np.array([cells.get((n, f"b{k}"), [NAN] * 6) for k in range(4)]) for n in names]
        truth = [c[:, 3:] for c in own if ((c[:, 5] > 0) & np.isfinite(c[:, 3:5]).all(axis=1)).any()]
        means = [np.mean(held) if len(held := c[:, 2][~np.isnan(c[:, 2])]) else -1.0 for c in own]
        best = {i: s for i, _, s in evaluate.greedy_matches([c[:, :2] for c in own], means, truth)}
        for i, n in enumerate(names):
            r = got[image, n]
            assert r.truths == len(truth) and (means[i] if means[i] >= 0 else None) == (r.score if r.score is None else pytest.approx(r.score))
            assert r.oks is None if best.get(i) is None else r.oks == pytest.approx(best[i])


# ---- outcomes and progress


def test_reconciliation(spark):
    registered = spark.createDataFrame([(0, "a"), (1, "b")], "ord long, path string")
    requested = spark.createDataFrame([("a",), ("bogus",), ("a",)], "path string")
    assert [r.path for r in reconcile.registered_match(registered, requested).collect()] == ["a"]
    assert [r.path for r in reconcile.unmatched_requests(registered, requested).collect()] == ["bogus"]
    one, two = spark.createDataFrame([(0, "x")], "ord long, value string"), spark.createDataFrame([(0, "x"), (1, "y"), (2, "z")], "ord long, value string")
    assert {r.value for r in reconcile.positional_pairs(registered, one).collect()} == {"x"}
    with pytest.raises(ValueError):
        reconcile.positional_pairs(registered, two)
    out = reconcile.resolved_outputs(spark.createDataFrame([("v",), ("w",), ("u",)], "stem string"), spark.createDataFrame([("vS.h5",), ("vSz.h5",), ("wS1.h5",), ("wS2.h5",)], "name string"), "S")
    assert {r.stem: r.output for r in out.collect()} == {"v": "vS.h5", "w": "wS2.h5", "u": None}


def test_numbers_and_texts(spark):
    row = spark.range(1).select(
        texts.format_duration(F.lit(59)).alias("a"), texts.format_duration(F.lit(3661.9)).alias("b"), texts.format_duration(F.lit(None).cast("long")).alias("c"), texts.signed(F.lit(2.0)).alias("d"),
        texts.thousands(F.lit(1234567)).alias("e"), numbers.fraction_done(F.lit(5.0), F.lit(0.0)).alias("f"), numbers.downsampled(F.lit(640), F.lit(480), 30).alias("g"),
        texts.format_version(texts.parse_version(F.lit("cu124"))).alias("h"), texts.parse_version(F.lit("nope")).alias("i"), numbers.half_even(F.lit(2.5)).alias("j"),
    ).first()
    assert (row.a, row.b, row.c, row.d, row.e, row.f, tuple(row.g), row.h, row.i, row.j) == ("00:59", "1:01:01", "--:--", "+2.00", "1,234,567", 0.0, (30, 22), "12.4", None, 2.0)


def test_stalls_warn_once_a_silence(spark):
    rows = spark.sql("SELECT * FROM VALUES (1L, 'k', timestamp_ntz'2024-01-01 00:00:00'), (2L, 'k', timestamp_ntz'2024-01-01 00:30:00'), (3L, 'k', timestamp_ntz'2024-01-01 00:31:00') AS t(seq, key, ts)")
    assert [r.silence for r in progress.stalled_keys(rows, 1200).collect()] == [1800.0]
    assert len(progress.stalled_keys(rows, 1200, "2024-01-01 02:00:00").collect()) == 2
