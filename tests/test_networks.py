"""Packed networks beside Spark ML's own fits."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortscore.operators import networks
from cohortscore.operators.metrics import ranking_metrics
from cohortscore.operators.models import fit_network, tune_network
from cohortscore.operators.networks import Fit, fit_together, loss_and_gradient, pack, row_weights
from cohortscore.operators.tally import ordered_points, tally

FEATURES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def rows(spark):
    """Far means, missing values, fractions, a constant, and rows without label."""
    draw = np.random.default_rng(11)
    n = 900
    a, b, c = draw.normal(1e4, 3.0, n), draw.integers(0, 3, n), draw.integers(0, 2, n)
    y = (a - 1e4 + 2.0 * b + draw.normal(size=n) > 4.0).astype(int)
    table = [
        (i, float(a[i]), int(b[i]), None if i % 40 == 0 else float(c[i]), 7, None if i % 101 == 0 else int(y[i])) for i in range(n)
    ]
    return spark.createDataFrame(table, "id long, a double, b int, c double, d int, y int").repartition(3, "id")


def test_weights_of_rows_are_means_of_blocks():
    copies = np.array([1, 3, 2, 1, 4])
    start = np.cumsum(copies) - copies
    owner = np.repeat(np.arange(5), copies)
    want = np.zeros(5)
    for i in range(0, 11, 4):
        block = owner[i : i + 4]
        np.add.at(want, block, 1 / len(block))
    assert np.allclose(row_weights(copies, start, np.full(5, 11), 4), want)


def test_gradient_is_the_slope_of_the_loss():
    draw = np.random.default_rng(3)
    layers = [4, 3, 3, 2]
    x, y, w = draw.normal(size=(20, 4)), draw.integers(0, 2, 20), draw.uniform(size=20)
    weights = draw.normal(size=4 * 3 + 3 + 3 * 3 + 3 + 3 * 2 + 2)
    _, gradient = loss_and_gradient(weights, layers, x, y, w)
    for i in range(len(weights)):
        step = np.eye(len(weights))[i] * 1e-6
        up, down = (loss_and_gradient(weights + s, layers, x, y, w)[0] for s in (step, -step))
        assert gradient[i] == pytest.approx((up - down) / 2e-6, abs=1e-6)


@pytest.mark.parametrize("scaler, weight", [("standard", 1.7), ("none", None)])
def test_packed_descent_equals_spark_ml(rows, scaler, weight):
    known = rows.withColumn("a", F.col("a") - 9990)
    params = {"blockSize": 64, "stepSize": 0.1, "solver": "gd", "maxIter": 15}
    both = [
        fit_network(known, FEATURES, "y", "id", 5, 2, scaler, params=params, pos_weight=weight, few_rows=few) for few in (10**6, 0)
    ]
    assert np.allclose(both[0].model.weights.toArray(), both[1].model.weights.toArray(), rtol=1e-7, atol=1e-9)
    assert both[1].params == both[0].params and both[1].features == both[0].features


def test_packed_quasi_newton_is_no_worse_than_spark_ml(rows):
    areas = []
    for few in (10**6, 0):
        scored = fit_network(rows, FEATURES, "y", "id", 6, 1, params={"maxIter": 60}, few_rows=few).score(rows, "p")
        areas.append(ranking_metrics(ordered_points(tally(scored, "y", ["p"]))).first()["pr_auc"])
    assert areas[1] > areas[0] - 0.01


def test_packed_search_equals_single_fits(rows):
    space = {"hidden": (3, 5, True), "depth": (1, 2, True), "blockSize": [64], "stepSize": (0.05, 0.2, False), "standardize": [1], "pos_weight": (1.0, 2.5, False)}
    plain, packed = (
        tune_network(rows, FEATURES, "y", "id", space, jobs=2, folds=2, max_iter=10, few_rows=few).orderBy("job_name").collect()
        for few in (10**6, 0)
    )
    assert [r["params"] for r in plain] == [r["params"] for r in packed]
    assert [r["objective"] for r in packed] == pytest.approx([r["objective"] for r in plain], abs=1e-6)


def test_packed_networks_share_their_passes(rows, monkeypatch):
    """As many jobs over the rows as steps, however many networks there are."""
    folded = rows.withColumn("fold", (F.col("id") % 3).cast("int"))
    fits = [Fit(3, 1, "standard", 1.0 + m / 2, k, 64, 0.1, "gd", 6) for m in range(3) for k in range(3)]
    packed = pack(folded, FEATURES, "y", "id", fits, "fold")
    jobs, plain = [], type(packed.blocks).mapInArrow
    monkeypatch.setattr(type(packed.blocks), "mapInArrow", lambda self, *given, **named: jobs.append(1) or plain(self, *given, **named))
    assert len(fit_together(packed, fits)) == 9 and len(jobs) <= 6
    assert networks.BLOCK == 128
