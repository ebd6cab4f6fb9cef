"""Packed logistic regressions beside Spark ML's own fits."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortscore.operators.linear import Logistic, fit_linear_together
from cohortscore.operators.models import fit_linear, tune_linear
from cohortscore.operators.networks import pack

FEATURES = ["a", "b", "c", "d", "e"]


@pytest.fixture(scope="module")
def rows(spark):
    """Far means, missing and infinite values, fractions, a constant, and rows without label."""
    draw = np.random.default_rng(11)
    n = 900
    a, b, c, e = draw.normal(1e3, 3.0, n), draw.integers(0, 3, n), draw.integers(0, 2, n), draw.normal(size=n)
    y = (a - 1e3 + 2.0 * b + draw.normal(size=n) > 4.0).astype(int)
    table = [
        (i, float(a[i]), int(b[i]), None if i % 40 == 0 else float("inf") if i % 40 == 1 else float(c[i]), 7, float(e[i]), None if i % 101 == 0 else int(y[i]))
        for i in range(n)
    ]
    return spark.createDataFrame(table, "id long, a double, b int, c double, d int, e double, y int").repartition(3, "id")


SETTINGS = [
    {}, {"fitIntercept": False, "maxIter": 8}, {"regParam": 0.05, "maxIter": 8}, {"regParam": 0.02, "elasticNetParam": 1.0},
    {"regParam": 0.08, "elasticNetParam": 0.4, "maxIter": 8}, {"regParam": 0.01, "elasticNetParam": 0.7, "fitIntercept": False, "maxIter": 8},
]


@pytest.mark.parametrize("params", SETTINGS)
def test_packed_fits_equal_spark_ml(rows, params):
    plain = fit_linear(rows, FEATURES, "y", params).model
    packed = fit_linear_together(pack(rows, FEATURES, "y", None, []), [Logistic(**params)])[0]
    assert np.allclose(packed.weights, plain.coefficients.toArray(), rtol=1e-6, atol=1e-9)
    assert packed.offset == pytest.approx(plain.intercept, rel=1e-6, abs=1e-9)


def test_packed_search_equals_single_fits(rows):
    plain, packed = (
        tune_linear(rows, FEATURES, "y", "id", jobs=3, folds=2, few_rows=few).orderBy("job_name").collect() for few in (10**6, 0)
    )
    assert [r["params"] for r in plain] == [r["params"] for r in packed]
    assert [r["objective"] for r in packed] == pytest.approx([r["objective"] for r in plain], abs=1e-9)


def test_rows_of_one_class_have_no_packed_fit(rows):
    assert fit_linear_together(pack(rows.where("y = 0"), FEATURES, "y", None, []), [Logistic()]) is None


def test_fits_share_their_passes(rows, monkeypatch):
    """As many jobs over the rows as the longest descent has, however many fits there are."""
    folded = rows.withColumn("fold", (F.col("id") % 3).cast("int"))
    fits = [Logistic(0.01 * m, 0.5, leaves_out=k, maxIter=2) for m in range(2) for k in range(2)]
    packed = pack(folded, FEATURES, "y", None, [], "fold")
    jobs, plain = [], type(packed.blocks).mapInArrow
    monkeypatch.setattr(type(packed.blocks), "mapInArrow", lambda self, *given, **named: jobs.append(1) or plain(self, *given, **named))
    alone = max(_jobs_of(packed, [fit], jobs) for fit in fits)
    assert _jobs_of(packed, fits, jobs) == alone


def _jobs_of(packed, fits, jobs):
    before = len(jobs)
    assert len(fit_linear_together(packed, fits)) == len(fits)
    return len(jobs) - before
