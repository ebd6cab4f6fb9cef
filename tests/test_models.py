"""p-values, stored scorers and searches."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortscore.operators.boosting import Settings
from cohortscore.operators.models import (
    best_settings, fit_boosted, fit_linear, fit_network, load_scorer, network_space, random_settings, save_scorer, tune_boosted, tune_linear,
)
from cohortscore.operators.select import _cross_products, fit_least_squares, moments, single_fits, student_tail
from cohortscore.session import run_folder

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    draw = np.random.default_rng(5)
    n = 600
    a, b, c = draw.normal(size=n), draw.integers(0, 3, n), draw.normal(size=n)
    y = (a + 0.5 * b + draw.normal(size=n) > 0.8).astype(int)
    table = [(i, float(a[i]), int(b[i]), None if i % 50 == 0 else float(c[i]), int(y[i])) for i in range(n)]
    return spark.createDataFrame(table, "id long, a double, b int, c double, y int")


@pytest.mark.parametrize("t, freedom", [(0.01, 50), (0.5, 3), (1.96, 1e5), (2.0, 10), (3.0, 1), (12.0, 4)])
def test_student_tail_equals_the_integral(t, freedom):
    x = np.linspace(-t, t, 400_001)
    log_scale = math.lgamma((freedom + 1) / 2) - math.lgamma(freedom / 2) - 0.5 * math.log(freedom * math.pi)
    density = np.exp(log_scale - (freedom + 1) / 2 * np.log1p(x * x / freedom))
    assert student_tail(t, freedom) == pytest.approx(1 - np.trapezoid(density, x), abs=1e-8)


def test_p_values_equal_least_squares_by_hand(rows):
    known = rows.where("c IS NOT NULL")
    m = moments(known, FEATURES, "y")
    table = known.toPandas()
    x = np.column_stack([np.ones(len(table)), table[FEATURES].to_numpy()])
    y = table["y"].to_numpy(dtype=float)
    inverse = np.linalg.inv(x.T @ x)
    slopes = inverse @ x.T @ y
    freedom = len(y) - 4
    errors = np.sqrt(np.diag(inverse) * ((y - x @ slopes) ** 2).sum() / freedom)
    fit = fit_least_squares(m, FEATURES)
    for i, f in enumerate(FEATURES, 1):
        t = abs(slopes[i] / errors[i])
        assert fit.t_values[f] == pytest.approx(t) and fit.p_values[f] == pytest.approx(student_tail(t, freedom))
    for f, t, p in single_fits(m):
        r = abs(np.corrcoef(table[f], y)[0, 1])
        assert t == pytest.approx(r * math.sqrt((len(y) - 2) / (1 - r * r))) and p == pytest.approx(student_tail(t, len(y) - 2))


def test_stored_scorers_score_the_same(spark, rows):
    scorers = [
        fit_boosted(rows, FEATURES, "y", {"rounds": 5, "max_depth": 3}, id_column="id"),
        fit_linear(rows, FEATURES, "y"),
        fit_network(rows, FEATURES, "y", "id", 4, 1, params={"maxIter": 5}),
    ]
    for scorer in scorers:
        again = load_scorer(spark.newSession(), save_scorer(spark, scorer, run_folder(spark, "scorer")))
        assert again.features == FEATURES and again.params == scorer.params and again.name == scorer.name
        both = again.score(scorer.score(rows.drop("b"), "p"), "q")
        assert both.where("p <> q OR p IS NULL").count() == 0


def test_boosting_weighs_classes_and_stops(rows):
    marked = rows.withColumn("held", F.col("id") % 4 == 0)
    scorer = fit_boosted(marked, FEATURES, "y", {"rounds": 60, "patience": 5}, "held", id_column="id")
    train = marked.where("NOT held")
    pos = train.where("y = 1").count()
    assert scorer.params["scale_pos_weight"] == pytest.approx((train.count() - pos) / pos)
    assert 0 < len(scorer.model.trees) <= len(scorer.model.areas) < 60


def test_searches_return_a_row_per_job(rows):
    results = tune_boosted(rows, FEATURES, "y", "id", {"rounds": (5, 9, True), "eta": (0.1, 0.3, False)}, jobs=3, folds=3)
    jobs = results.orderBy("job_name").collect()
    assert [j["job_name"] for j in jobs] == ["job-000", "job-001", "job-002"] and all(0.5 < j["objective"] <= 1 for j in jobs)
    best = best_settings(results)
    assert isinstance(best["rounds"], int) and 0.1 <= best["eta"] <= 0.3 and Settings(**best).rounds == best["rounds"]
    linear = tune_linear(rows, FEATURES, "y", "id", jobs=2, folds=2).collect()
    assert len(linear) == 2 and all(0.5 < j["objective"] <= 1 for j in linear)


def test_network_searches_take_the_weight_from_the_classes(rows):
    space = network_space(rows, "y")
    pos = rows.where("y = 1").count()
    w = (600 - pos) / pos
    assert space["pos_weight"][:2] == pytest.approx((max(1.0, math.sqrt(w)), max(1.5 * w, w + 0.1)))
    drawn = random_settings(space, 40)
    assert {s["standardize"] for s in drawn} == {0, 1} and {s["blockSize"] for s in drawn} == {64, 128, 256, 512}
    assert all(0.00001 <= s["stepSize"] <= 0.003 for s in drawn)


def test_cross_products_of_one_pass_equal_numpy(spark):
    """Around far means, with incomplete rows and tasks without rows."""
    draw = np.random.default_rng(7)
    x = draw.normal(size=(500, 3)) * [1.0, 10.0, 0.1] + [1e7, 0.0, -1e5]
    table = [(*map(float, row[:2]), None if i % 9 == 0 else float(row[2])) for i, row in enumerate(x)]
    df = spark.createDataFrame(table, "a double, b double, c double").repartition(3).union(spark.createDataFrame([], "a double, b double, c double"))
    n, mean, cross = _cross_products(df, ["a", "b", "c"])
    known = np.delete(x, np.arange(0, 500, 9), axis=0)
    assert n == len(known) and np.allclose(mean, known.mean(axis=0), rtol=1e-12)
    centred = known - known.mean(axis=0)
    assert np.allclose(cross, centred.T @ centred, rtol=1e-6, atol=1e-4)


def test_cross_products_come_from_one_job_of_all_tasks(spark):
    """Not from a job per partition, one after the other."""
    df = spark.range(400).select(F.col("id").cast("double").alias("a"), (F.col("id") % 7).cast("double").alias("b")).repartition(6)
    spark.sparkContext.setJobGroup("cross-products", "")
    _cross_products(df, ["a", "b"])
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("cross-products")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert 1 <= len(jobs) <= 2
