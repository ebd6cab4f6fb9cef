"""Splits, encoding, lookups and curves where keys are many, or one holds a third of the rows."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from cohortscore.operators.columns import dyadic_blocks, range_lookup
from cohortscore.operators.encode import fit_category_table, fit_one_hot
from cohortscore.operators.keys import lookup_join, prefix_sums
from cohortscore.operators.metrics import roc_curve
from cohortscore.operators.split import k_folds, seeded_positions, split_by_share, stratified_folds, stratified_split
from cohortscore.operators.tally import ordered_points, tally


def place(i):
    return hashlib.md5(f"42:{'' if i is None else i}".encode()).hexdigest()


@pytest.mark.parametrize("small", [0, 100_000])
def test_lookup_join_equals_a_plain_join(spark, small):
    rows = [(i, "hot" if i % 3 == 0 else None if i % 7 == 0 else f"k{i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "id int, k string")
    table = spark.createDataFrame([("hot", 1), *[(f"k{i}", i) for i in range(0, 3000, 2)]], "k string, v int")
    got = lookup_join(df, table, ["k"], small, heavy_share=0.01)
    want = df.join(table, "k", "left")
    assert sorted(map(str, got.select("id", "k", "v").collect())) == sorted(map(str, want.select("id", "k", "v").collect()))


@pytest.mark.parametrize("small", [0, 100_000])
def test_prefix_sums(spark, small):
    values = [random.Random(1).randrange(9) for _ in range(500)]
    df = spark.createDataFrame(list(enumerate(values)), "i int, v int")
    total = 0
    got = {r["i"]: r["s"] for r in prefix_sums(df, [F.desc("i")], F.col("v"), "s", small).collect()}
    for i in range(499, -1, -1):
        assert got[i] == total
        total += values[i]


def many_classes(spark, classes, rows):
    """30 % of the rows without id, one class with a third of all."""
    df = spark.range(rows).select(
        F.when(F.col("id") % 10 < 7, F.col("id")).alias("id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("c"), F.xxhash64("id") % classes)).alias("y"),
    )
    return df.where("id IS NOT NULL OR y = 'hot'")


@pytest.mark.parametrize("small", [0, 100_000])
def test_splits_of_many_classes_equal_a_plain_ranking(spark, small):
    df = many_classes(spark, 300, 4000)
    rows = [tuple(r) for r in df.collect()]
    by_class = defaultdict(list)
    for i, y in rows:
        by_class[y].append((place(i), i is not None, i or 0))
    total = -(-len(rows) // 5)
    exact = {y: divmod(total * len(r), len(rows)) for y, r in by_class.items()}
    left = total - sum(q for q, _ in exact.values())
    more = set(sorted(exact, key=lambda y: (-exact[y][1], y))[:left])
    want = Counter()
    for y, own in by_class.items():
        own.sort()
        quota = exact[y][0] + (y in more)
        cut = own[quota - 1] if quota else ("", False, 0)
        for entry in own:
            want[y, entry[2] if entry[1] else None, "test" if entry <= cut else "train"] += 1
    got = stratified_split(df, "id", "y", 0.2, small_rows=small)
    assert Counter((r["y"], r["id"], r["split"]) for r in got.collect()) == want
    folds = Counter()
    skip = 0
    for y in sorted(by_class):
        own = by_class[y]
        base, rest = divmod(len(own), 4)
        ends, at = [], 0
        for k in range(3):
            at += base + ((k - skip) % 4 < rest)
            ends.append(own[at - 1] if at else ("", False, 0))
        skip = (skip + len(own)) % 4
        for entry in own:
            folds[y, entry[2] if entry[1] else None, sum(entry > e for e in ends)] += 1
    got = stratified_folds(df, "id", "y", 4, small_rows=small)
    assert Counter((r["y"], r["id"], r["fold"]) for r in got.collect()) == folds


def test_fifty_thousand_classes(spark):
    df = many_classes(spark, 50_000, 150_000)
    sizes = {r["y"]: r["count"] for r in df.groupBy("y").count().collect()}
    assert len(sizes) > 40_000
    parts = stratified_split(df, "id", "y", 0.2, small_rows=1000).groupBy("y", "split").count().collect()
    test = {r["y"]: r["count"] for r in parts if r["split"] == "test"}
    assert all(abs(test.get(y, 0) - n / 5) < 1 for y, n in sizes.items() if y != "hot")
    assert sum(r["count"] for r in parts) == sum(sizes.values())


def test_rows_without_id_spread_over_the_positions(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("id"), (F.col("id") % 2).alias("y"), F.col("id").alias("x"))
    got = seeded_positions(df, "id", "y", small_rows=1000)
    for y in (0, 1):
        rows = got.where(F.col("y") == y).orderBy("pos").collect()
        assert [r["pos"] for r in rows] == list(range(1, 15_001))
        places = [place(r["id"]) for r in rows]
        assert places == sorted(places)


def test_splits_of_nothing(spark):
    none = spark.createDataFrame([], "id long, y string")
    for split in (stratified_split(none, "id", "y"), stratified_folds(none, "id", "y"), k_folds(none, "id"), split_by_share(none, "id", 0.5), seeded_positions(none, "id", "y")):
        assert split.count() == 0


# Encoding --------------------------------------------------------------------


@pytest.mark.parametrize("small", [0, 100_000])
def test_indices_are_those_of_the_columns(spark, small):
    rows = [("a", "x", "y", 1), ("a", "y", None, 2), ("b", None, None, None), (None, "z", "x", 1), ("c", "x", "x", 3), ("b", "w", "z", 1)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, c string, d1 string, d2 string, k int")
    wide = fit_one_hot(df, ["c", "k"], {"d": ["d1", "d2"]})
    names = wide.columns()
    dictionary = fit_category_table(df, ["c", "k"], {"d": ["d1", "d2"]}, small_rows=small)
    assert dictionary.size == len(names)
    got = {r["id"]: r["indices"] for r in dictionary.encode(df).collect()}
    for r in wide.transform(df).collect():
        assert got[r["id"]] == [i for i, n in enumerate(names) if r[n] == 1]
    assert dictionary.encode(df).columns == ["id", "indices"]


def test_two_hundred_thousand_categories(spark):
    n = 200_000
    df = spark.range(n * 3 // 2).select(
        "id", F.when(F.col("id") >= n, F.lit("v000007")).otherwise(F.format_string("v%06d", "id")).alias("c")
    )
    dictionary = fit_category_table(df, ["c"], small_rows=1000)
    assert dictionary.size == n - 1  # the most frequent one is dropped
    encoded = dictionary.encode(df)
    right = F.when(F.col("id") < 7, F.array(F.col("id"))).when(
        (F.col("id") == 7) | (F.col("id") >= n), F.array().cast("array<long>")
    ).otherwise(F.array(F.col("id") - 1))
    assert encoded.count() == n * 3 // 2 and encoded.where(F.col("indices") != right).count() == 0


# Ranges ----------------------------------------------------------------------


def test_blocks_cover_a_range_once(spark):
    dice = random.Random(2)
    spans = [(low, low + dice.randrange(200)) for low in range(60)] + [(0, 1 << 62), (5, (1 << 40) + 3)]
    df = spark.createDataFrame(spans, "low long, high long").select("*", dyadic_blocks(F.col("low"), F.col("high")).alias("b"))
    for r in df.collect():
        at = sorted((x["block"] << x["level"], (x["block"] + 1) << x["level"]) for x in r["b"])
        assert len(at) <= 128
        ends = [r["low"]]
        for start, end in at:
            assert start == ends[-1]
            ends.append(end)
        assert ends[-1] == max(r["low"], r["high"]) or not at and r["high"] <= r["low"]


@pytest.mark.parametrize("small", [0, 100_000])
def test_wide_ranges_that_overlap(spark, small):
    dice = random.Random(3)
    ranges = [(-10, 10, "around", 5), (0, 10**9, "wide", 9), (5, 5, "nothing", 0), (7, 8, "seven", 1), (10**9 - 3, 3 * 10**9, "far", 2)]
    ranges += [(low, low + dice.randrange(10**8), f"r{low}", 3 + low % 4) for low in range(0, 10**9, 10**7 + 1)]
    codes = [None, -11, -10, 0, 7, 8, 10**9, 10**9 - 1, 3 * 10**9 - 1, 3 * 10**9, *[dice.randrange(10**9) for _ in range(300)], *[7] * 200, *[None] * 100]
    df = spark.createDataFrame(list(enumerate(codes)), "id int, code long")
    table = spark.createDataFrame(ranges, "low long, high long, label string, priority int")
    got = {r["id"]: r["label"] for r in range_lookup(df, F.col("code"), table, small_rows=small).collect()}
    for i, code in enumerate(codes):
        held = [(p, label) for low, high, label, p in ranges if code is not None and low <= code < high]
        assert got[i] == (min(held)[1] if held else None), code


# Curves ----------------------------------------------------------------------


@pytest.mark.parametrize("cell_rows", [None, 3])
def test_collinear_points_are_left_out(spark, cell_rows):
    dice = random.Random(4)
    rows = [(dice.randrange(2), round(dice.random(), 1), i / 200) for i in range(200)] + [(1, 2.0, 5.0)] * 3
    df = spark.createDataFrame(rows, "y int, a double, b double")
    points = ordered_points(tally(df, "y", ["a", "b"]), cell_rows=cell_rows)
    for name, at in (("a", 1), ("b", 2)):
        steps = []
        for x in sorted({r[at] for r in rows}, reverse=True):
            steps.append((x, sum(r[0] for r in rows if r[at] == x), sum(1 - r[0] for r in rows if r[at] == x)))
        p, n = sum(s[1] for s in steps), sum(s[2] for s in steps)
        want, tp, fp = {(float("inf"), 0.0, 0.0)}, 0, 0
        for k, (x, pos, neg) in enumerate(steps):
            tp, fp = tp + pos, fp + neg
            if k in (0, len(steps) - 1) or steps[k + 1][1:] != (pos, neg):
                want.add((x, fp / n, tp / p))
        got = {(r["threshold"], r["fpr"], r["tpr"]) for r in roc_curve(points).where(F.col("feature") == name).collect()}
        assert got == want
        assert roc_curve(points, drop_collinear=False).where(F.col("feature") == name).count() == len(steps) + 1 >= len(want)


def test_ranges_beyond_all_codes_are_not_cut(spark, monkeypatch):
    """What is stored of the ranges depends on the codes' span, clipped ranges keep their answers."""
    from cohortscore.operators import columns

    stored, plain = [], columns.settle
    monkeypatch.setattr(columns, "settle", lambda df: stored.append(plain(df)) or stored[-1])
    far = [(10**6 + i * 1000, 10**6 + i * 1000 + 999, f"far{i}", 0) for i in range(200)]
    ranges = spark.createDataFrame([*far, (-(10**9), 15, "low", 2), (15, 10**9, "high", 2), (12, 17, "mid", 1), (9, 5, "empty", 0)], "low long, high long, label string, priority int")
    df = spark.createDataFrame([(i, c) for i, c in enumerate([10, 12, 14, 16, 17, 20, None])], "id int, code long")
    got = {r["code"]: r["label"] for r in columns.range_lookup(df, F.col("code"), ranges).collect()}
    assert got == {10: "low", 12: "mid", 14: "mid", 16: "mid", 17: "high", 20: "high", None: None}
    assert next(t for t in stored if "block" in t.columns).count() < 40
    nothing = columns.range_lookup(df.where("code IS NULL"), F.col("code"), ranges).collect()
    assert [r["label"] for r in nothing] == [None]
