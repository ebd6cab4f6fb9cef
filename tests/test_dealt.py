"""Boosted trees on rows that are dealt over tasks running side by side."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortscore.operators import boosting, dealt, packed
from cohortscore.operators.boosting import Settings, fit, fit_many
from cohortscore.session import scratch

FEATURES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def rows(spark):
    draw = np.random.default_rng(5)
    n = 3000
    a, b, d = draw.integers(0, 6, n), draw.integers(0, 2, n), draw.integers(0, 30, n)
    c = draw.choice([np.nan, 0.5, 1.5, 2.5], n)
    y = draw.random(n) < 0.15 + 0.1 * a * b + 0.3 * np.isnan(c)
    table = [(i, int(a[i]), int(b[i]), None if np.isnan(c[i]) else float(c[i]), int(d[i]), int(y[i]), i % 3) for i in range(n)]
    # Two of these partitions have no rows.
    return spark.createDataFrame(table, "id long, a int, b int, c double, d int, y int, fold int").repartition(2)


def shapes(model):
    return [(t.feature, t.cut, t.missing_left, t.left) for t in model.trees]


def same(one, other):
    assert shapes(one) == shapes(other)
    assert all(np.allclose(a.value, b.value) for a, b in zip(one.trees, other.trees))


def test_more_rows_than_a_task_takes_need_no_job_a_level(rows, monkeypatch):
    s = Settings(rounds=6, max_depth=4)
    want = fit(rows, FEATURES, "y", "id", s, plain_rows=0)
    monkeypatch.setattr(boosting, "grow_level", None)
    same(want, fit(rows, FEATURES, "y", "id", s, task_rows=0))


def test_rows_that_do_not_fit_into_tasks_stay_where_they_are(rows, monkeypatch):
    s = Settings(rounds=3, max_depth=3)
    want = fit(rows, FEATURES, "y", "id", s, task_rows=0)
    monkeypatch.setattr(dealt, "grow_stage", None)
    same(want, fit(rows, FEATURES, "y", "id", s, task_rows=0, held_rows=0))
    same(want, fit(rows, FEATURES, "y", "id", s, task_rows=0, held_rows=0, fan_in=0))


@pytest.mark.parametrize("patience", [None, 3])
def test_few_models_at_a_time_give_the_same_trees(rows, monkeypatch, patience):
    monkeypatch.setattr(dealt, "GROUP", 2)
    monkeypatch.setattr(dealt, "SAVED_ROUNDS", 4)
    each = [Settings(rounds=n, max_depth=3, eta=0.5, patience=patience) for n in (9, 4, 6)]
    several = [rows, FEATURES, "y", "id", each, [0, 1, 2], "fold"]
    want, got = fit_many(*several, plain_rows=0), fit_many(*several, task_rows=0, block_rounds=4)
    for one, other in zip(want, got):
        same(one, other)
        if patience:
            n = min(len(one.areas), len(other.areas))
            assert n and np.allclose(one.areas[:n], other.areas[:n])


def test_large_nodes_are_summed_two_columns_at_a_time():
    draw = np.random.default_rng(1)
    cards = [2] * 9 + [64, 5, 200]
    bins = np.stack([draw.integers(0, c, 3000) for c in cards], axis=1).astype(np.uint8)
    bins[draw.random(3000) < 0.1, 9] = boosting.MISSING
    spans = np.concatenate(([0], np.cumsum([c + 1 for c in cards])))
    held = packed.Held(np.arange(3000), np.zeros(3000), np.zeros(3000), bins, spans, packed.empty_bins(bins))
    grad, hess = draw.normal(size=3000), draw.random(3000)
    assert np.allclose(held.node_sums(np.arange(3000), grad, hess), boosting.level_sums(bins, np.zeros(3000, dtype=int), grad, hess, 1, spans)[0])


def test_nothing_is_left_of_what_tasks_sent(spark, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(dealt, "run_folder", lambda spark, name: f"{tmp_path}/{name}-{len(list(tmp_path.iterdir()))}-{np.random.randint(10**9)}")
    with scratch(spark):
        fit(rows.withColumn("y", F.when(F.col("id") % 7 > 0, F.col("y"))), FEATURES, "y", "id", Settings(rounds=2, max_depth=2), task_rows=0)
    assert not list(tmp_path.iterdir())
