"""Forests grown in tasks."""

import uuid

import numpy as np
import pytest

from cohortscore.operators import forest
from cohortscore.operators.forest import impurity, tree_gains, tried_features
from cohortscore.operators.models import forest_importance

FEATURES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def rows(spark):
    draw = np.random.default_rng(2)
    n = 1500
    a, b, c = draw.normal(size=n), draw.integers(0, 2, n), draw.normal(size=n)
    y = (1.5 * a + b + 0.3 * draw.normal(size=n) > 0.5).astype(int)
    table = [(float(a[i]), int(b[i]), None if i % 30 == 0 else float(c[i]), 3, None if i % 100 == 0 else int(y[i])) for i in range(n)]
    return spark.createDataFrame(table, "a double, b int, c double, d int, y int")


def test_nodes_try_different_features():
    tried = tried_features(np.random.default_rng(1), 4000, 9, 3)
    assert (np.sort(tried, axis=1)[:, 1:] > np.sort(tried, axis=1)[:, :-1]).all()
    assert np.allclose(np.bincount(tried.ravel(), minlength=9) / 12000, 1 / 9, atol=0.02)


def grown(bins, y, weight, cards, depth):
    """Gains of the tree that tries all features, node by node."""
    gains = np.zeros(len(cards))
    whole = np.array([weight[y == c].sum() for c in (0, 1)], dtype=float)
    if not depth or not len(y) or not whole.all():
        return gains
    best = (0.0, -1, 0)
    for f in range(len(cards)):
        for cut in range(cards[f] - 1):
            left = np.array([weight[(y == c) & (bins[:, f] <= cut)].sum() for c in (0, 1)], dtype=float)
            gain = float(impurity(whole) - impurity(left) - impurity(whole - left))
            if left.sum() and (whole - left).sum() and gain > best[0] + 1e-9:
                best = (gain, f, cut)
    gain, f, cut = best
    if f >= 0:
        gains[f] += gain
        for side in (bins[:, f] <= cut, bins[:, f] > cut):
            gains += grown(bins[side], y[side], weight[side], cards, depth - 1)
    return gains


@pytest.mark.parametrize("depth", [1, 2, 4])
def test_a_tree_equals_the_plain_search(depth):
    draw = np.random.default_rng(8)
    cards = np.array([7, 5])
    bins = np.stack([draw.integers(0, c, 400) for c in cards], axis=1).astype(np.uint8)
    y = (bins[:, 0] + bins[:, 1] + draw.normal(size=400) > 5).astype(np.uint8)
    weight = np.random.default_rng(4).poisson(1.0, 400)
    found = tree_gains(bins, y, cards, 2, depth, np.random.default_rng(4))
    want = grown(bins, y, weight, cards, depth)
    assert found == pytest.approx(want / want.sum(), abs=0.02 if depth > 2 else 1e-9)


def test_importances_in_tasks_are_near_spark_ml(rows):
    tasks, ml = (
        {r["feature"]: r["gain"] for r in forest_importance(rows, FEATURES, "y", {"numTrees": 40, "maxDepth": 6}, task_rows=n).collect()}
        for n in (10**6, 0)
    )
    assert sum(tasks.values()) == pytest.approx(1.0) and tasks["d"] == 0.0
    assert all(abs(tasks[f] - ml[f]) < 0.05 for f in FEATURES)


def test_reruns_give_the_same_forest(rows):
    once, again = (forest_importance(part, FEATURES, "y", {"numTrees": 5}).collect() for part in (rows, rows))
    assert once == again


def test_each_tree_grows_once(rows, tmp_path, monkeypatch):
    folder, width = str(tmp_path), len(FEATURES)

    def marked(*given):
        open(f"{folder}/{uuid.uuid4().hex}", "w").close()
        return np.ones(width) / width

    monkeypatch.setattr(forest, "tree_gains", marked)
    forest_importance(rows, FEATURES, "y", {"numTrees": 3}).collect()
    assert len(list(tmp_path.iterdir())) == 3


def test_packed_bins_give_the_same_tree():
    draw = np.random.default_rng(3)
    cards = np.array([32, 7, *[2] * 9, 5])
    bins = np.stack([draw.integers(0, c, 3000) for c in cards], axis=1).astype(np.uint8)
    y = (bins[:, 0] + 8 * bins[:, 5] + 6 * draw.normal(size=3000) > 18).astype(np.uint8)
    layout = forest.bin_layout(cards)
    packed = forest.PackedBins.of(layout, forest.row_codes(layout, bins))
    assert packed.codes.shape == (3000, 4)
    plain, other = (tree_gains(b, y, cards, 4, 30, np.random.default_rng(6)) for b in (bins, packed))
    assert plain.tolist() == other.tolist()


def test_a_forest_of_more_than_a_million_rows_grows_in_tasks(spark, monkeypatch):
    monkeypatch.setattr("cohortscore.operators.models.RandomForestClassifier", None)
    many = spark.range(1_100_000).selectExpr("id % 7 AS a", "id % 11 AS b", "int(id % 7 > 3 OR id % 11 > 8) AS y")
    found = {r["feature"]: r["gain"] for r in forest_importance(many, ["a", "b"], "y", {"numTrees": 2, "maxDepth": 4}).collect()}
    assert sum(found.values()) == pytest.approx(1.0) and found["a"] > found["b"] > 0
