"""Boosted trees against a plain search of all splits."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortscore.operators import boosting, packed
from cohortscore.operators.boosting import BoostedModel, Settings, Tree, fit, fit_cuts, fit_many

FEATURES = ["a", "b", "c", "d"]


def table(n=2000, seed=3):
    dice = random.Random(seed)
    rows = []
    for i in range(n):
        a, b, c = dice.randrange(6), dice.randrange(2), dice.choice([None, 0.5, 1.5, 2.5])
        y = int(dice.random() < 0.15 + 0.1 * a * b + (0.3 if c is None else 0.0))
        rows.append((i, a, b, c, dice.randrange(30), y))
    return rows


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(table(), "id long, a int, b int, c double, d int, y int").repartition(3)


def plain_gain(g, h, s):
    w = -math.copysign(max(abs(g) - s.reg_alpha, 0), g) / (h + s.reg_lambda)
    if s.max_delta_step:
        w = max(-s.max_delta_step, min(s.max_delta_step, w))
    return w, -2 * (g * w + 0.5 * (h + s.reg_lambda) * w * w + s.reg_alpha * abs(w))


def plain_tree(x, y, margin, s, depth=0):
    """All cuts of all features at all values, by definition; a nested tuple."""
    p = 1 / (1 + np.exp(-margin))
    g, h = p - y, p * (1 - p)
    w, own = plain_gain(g.sum(), h.sum(), s)
    best = None
    if depth < s.max_depth:
        for f in range(x.shape[1]):
            for cut in [*sorted(set(x[~np.isnan(x[:, f]), f]))[:-1], math.inf]:  # the last: only missing values go right
                for missing_left in (True, False):
                    left = (x[:, f] <= cut) | (np.isnan(x[:, f]) & missing_left)
                    if min(h[left].sum(), h[~left].sum()) < s.min_child_weight:
                        continue
                    gain = plain_gain(g[left].sum(), h[left].sum(), s)[1] + plain_gain(g[~left].sum(), h[~left].sum(), s)[1] - own
                    if gain > max(1e-6, s.gamma) and (best is None or gain > best[0] + 1e-9):
                        best = (gain, f, cut, left)
    if best is None:
        return round(s.eta * w, 9)
    gain, f, cut, left = best
    sides = [plain_tree(x[m], y[m], margin[m], s, depth + 1) for m in (left, ~left)]
    return (f, cut, round(gain, 6), *sides)


def nested(tree: Tree, cuts, node=0):
    if tree.feature[node] < 0:
        return round(tree.value[node], 9)
    f, at = tree.feature[node], tree.left[node]
    cut = [*cuts[f], math.inf][tree.cut[node]]
    return (f, cut, round(tree.gain[node], 6), nested(tree, cuts, at), nested(tree, cuts, at + 1))


def close(a, b):
    if isinstance(a, tuple):
        return isinstance(b, tuple) and a[:2] == b[:2] and abs(a[2] - b[2]) < 1e-5 and all(map(close, a[3:], b[3:]))
    return not isinstance(b, tuple) and abs(a - b) < 1e-7


#: Rows stay where they are, or each model grows in a task.
WAYS = [0, 10_000]
PLAIN = {"rounds": 3, "max_depth": 3, "subsample": 1.0, "colsample": 1.0}


@pytest.mark.parametrize("task_rows", WAYS)
@pytest.mark.parametrize(
    "extra",
    [{}, {"reg_lambda": 7.0, "reg_alpha": 3.0}, {"gamma": 6.0}, {"min_child_weight": 40.0}, {"max_delta_step": 0.2, "reg_alpha": 1.0}],
)
def test_trees_equal_a_plain_search(rows, extra, task_rows):
    s = Settings(**{**PLAIN, **extra})
    model = fit(rows, FEATURES, "y", "id", s, task_rows=task_rows)
    got = {r["id"]: r for r in rows.collect()}
    x = np.array([[np.nan if got[i][f] is None else got[i][f] for f in FEATURES] for i in sorted(got)], dtype=float)
    y = np.array([got[i]["y"] for i in sorted(got)], dtype=float)
    margin = np.zeros(len(y))
    for tree in model.trees:
        assert close(nested(tree, model.cuts), plain_tree(x, y, margin, s))
        bins = np.stack([boosting.bin_column(x[:, i], c) for i, c in enumerate(model.cuts)], axis=1)
        margin += tree.scores(bins)
    scored = {r["id"]: r["p"] for r in model.score(rows, "p").collect()}
    assert np.allclose([scored[i] for i in sorted(scored)], 1 / (1 + np.exp(-margin)))


def test_sums_by_the_driver_and_by_spark_are_the_same(rows):
    s = Settings(rounds=3, max_depth=3)
    one, two = (fit(rows, FEATURES, "y", "id", s, task_rows=0, fan_in=n) for n in (64, 0))
    assert [t.feature for t in one.trees] == [t.feature for t in two.trees]
    assert np.allclose(one.trees[-1].value, two.trees[-1].value)


def test_trees_do_not_depend_on_partitions_or_blocks(rows):
    s = Settings(rounds=5, max_depth=3)
    one = fit(rows, FEATURES, "y", "id", s)
    for other in (fit(rows.repartition(5), FEATURES, "y", "id", s, task_rows=0, block_rounds=2), fit(rows, FEATURES, "y", "id", s, task_rows=0)):
        assert [t.feature for t in one.trees] == [t.feature for t in other.trees]
        assert np.allclose(one.trees[-1].value, other.trees[-1].value)


def average_precision(y, p):
    order = sorted(set(p), reverse=True)
    area = before = 0.0
    for cut in order:
        at = p >= cut
        recall = y[at].sum() / y.sum()
        area += (recall - before) * y[at].mean()
        before = recall
    return area


@pytest.mark.parametrize("task_rows", WAYS)
def test_early_stopping_keeps_the_best_prefix(rows, task_rows):
    tagged = rows.withColumn("held", F.col("id") % 3 == 0)
    s = Settings(rounds=40, max_depth=4, eta=0.6, patience=5)
    model = fit(tagged, FEATURES, "y", "id", s, held="held", task_rows=task_rows, block_rounds=4)
    grown = len(model.areas)
    held = tagged.where("held")
    y = np.array([r["y"] for r in held.orderBy("id").collect()], dtype=float)
    # The prefixes that were kept, judged one after the other.
    prefixes = range(1, len(model.trees) + 1)
    table = model.score(held, "p", prefixes).orderBy("id").toPandas()
    areas = [average_precision(y, table[f"p_{k}"].to_numpy()) for k in prefixes]
    assert np.allclose(areas, model.areas[: len(areas)])
    best = 0
    while best < grown and any(a > model.areas[best] for a in model.areas[best + 1 : best + 1 + s.patience]):
        best = next(i for i in range(best + 1, grown) if model.areas[i] > model.areas[best])
    assert len(model.trees) == best + 1 and grown < s.rounds
    assert 0 <= grown - (best + 1) - s.patience < 4  # the block in which patience ran out


def test_models_of_folds_grow_together(rows):
    folded = rows.withColumn("fold", (F.col("id") % 3).cast("int"))
    s = Settings(rounds=4, max_depth=2, subsample=1.0, colsample=1.0)
    together = fit_many(folded, FEATURES, "y", "id", [s] * 3, [0, 1, 2], "fold")
    alone = fit_many(folded, FEATURES, "y", "id", [s], [1], "fold")[0]
    assert [t.feature for t in together[1].trees] == [t.feature for t in alone.trees]
    assert np.allclose(together[1].trees[-1].value, alone.trees[-1].value)
    assert together[0].trees[0].value != together[1].trees[0].value


def test_a_stored_model_scores_the_same(rows):
    model = fit(rows, FEATURES, "y", "id", Settings(rounds=3, max_depth=3))
    again = BoostedModel.from_json(model.to_json())
    both = again.score(model.score(rows, "p"), "q")
    assert both.where("p <> q").count() == 0
    # A column that is gone counts as missing; others are carried along.
    assert set(again.score(rows.drop("d"), "p").columns) == {"id", "a", "b", "c", "y", "p"}
    gains = again.importances()
    assert list(gains) == FEATURES and gains["a"] > 0


def test_awkward_tables(spark, rows):
    s = Settings(rounds=2, max_depth=2)
    nothing = rows.limit(0)
    assert fit(nothing, FEATURES, "y", "id", s).trees == []
    assert fit(nothing, FEATURES, "y", "id", s).score(rows, "p").select("p").distinct().collect()[0]["p"] == 0.5
    one_class = fit(rows.withColumn("y", F.lit(1)), FEATURES, "y", "id", s)
    assert one_class.score(rows, "p").where("p <= 0.5").count() == 0
    blank = rows.withColumn("c", F.lit(None).cast("double")).withColumn("y", F.when(F.col("id") % 2 == 0, F.col("y")))
    assert fit_cuts(blank, ["c"]) == [[]]
    assert fit(blank, FEATURES, "y", "id", s).importances()["c"] == 0
    with pytest.raises(ValueError):
        fit_many(rows, FEATURES, "y", "id", [Settings(patience=3)], [None])


@pytest.mark.parametrize("patience", [None, 5])
def test_packed_rows_give_the_same_trees(rows, patience):
    folded = rows.withColumn("fold", (F.col("id") % 5).cast("int"))
    s = Settings(rounds=10, max_depth=4, eta=0.5, min_child_weight=3.0, patience=patience)
    several = [s] * 5, list(range(5)), "fold", 42
    slow = fit_many(folded, FEATURES, "y", "id", *several, task_rows=0)
    fast = fit_many(folded, FEATURES, "y", "id", *several, plain_rows=0)
    for a, b in zip(slow, fast):
        shapes = [[(t.feature, t.cut, t.missing_left, t.left) for t in m.trees] for m in (a, b)]
        assert shapes[0] == shapes[1]
        assert np.allclose(a.trees[-1].value, b.trees[-1].value)
        assert np.allclose(a.areas[: len(b.trees)], b.areas[: len(b.trees)])


def test_a_model_of_many_rows_takes_no_job_a_level(spark, monkeypatch):
    monkeypatch.setattr(boosting, "grow_level", None)
    rows = spark.range(210_000).selectExpr("id", "id % 7 AS a", "id % 11 AS b", "int(id % 7 > 3 OR id % 11 > 8) AS y")
    assert len(fit(rows, ["a", "b"], "y", "id", Settings(rounds=3, max_depth=3)).trees) == 3


def test_features_share_bytes():
    draw = np.random.default_rng(1)
    cards = [2] * 9 + [64, 5, 200]
    bins = np.stack([draw.integers(0, c, 3000) for c in cards], axis=1).astype(np.uint8)
    bins[draw.random(3000) < 0.1, 9] = boosting.MISSING
    spans = np.concatenate(([0], np.cumsum([c + 1 for c in cards])))
    held = packed.Held(np.arange(3000), np.zeros(3000), np.zeros(3000), bins, spans, packed.empty_bins(bins))
    assert len(held.columns) == 4
    grad, hess, slot = draw.normal(size=3000), draw.random(3000), draw.integers(0, 3, 3000)
    want = boosting.level_sums(bins, slot, grad, hess, 3, spans)
    assert np.allclose(held.sums(slot, np.arange(3000), grad, hess, 3), want)
