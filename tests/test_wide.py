"""Fits and stored tables of very many columns: rows are read once, by code that the JVM compiles."""

import math

import pytest
from pyspark.sql import functions as F

from cohortscore.operators import models
from cohortscore.operators.models import fit_linear
from cohortscore.operators.scale import fit_mean_fill
from cohortscore.plans import engineering
from cohortscore.session import METHOD_BYTES, compiled, settle
from cohortscore.sources.tables import encounter_schema

LIMIT = "spark.sql.codegen.hugeMethodLimit"


@pytest.fixture
def high_limit(spark):
    before = spark.conf.get(LIMIT)
    spark.conf.set(LIMIT, "65535")
    yield
    spark.conf.set(LIMIT, before)


def test_a_linear_fit_reads_its_rows_once(spark):
    reads = spark.sparkContext.accumulator(0)

    def counted(v):
        reads.add(1)
        return v

    rows = spark.range(400).select(
        F.udf(counted, "int")((F.col("id") % 7).cast("int")).alias("a"), (F.col("id") % 3).cast("int").alias("b"),
        F.expr("IF(id * 13 % 11 < 4, 1, 0)").alias("y"),
    )
    model = fit_linear(rows, ["a", "b"], "y").model
    assert reads.value == 400
    assert model.coefficients.size == 2


def test_a_linear_fit_equals_that_of_plain_vectors(spark):
    rows = spark.range(600).select(
        F.expr("CAST(IF(id % 9 = 0, NULL, id * 7 % 5) AS INT)").alias("a"),
        F.expr("IF(id % 50 = 0, double('inf'), IF(id % 51 = 0, double('nan'), id * 31 % 17 / 3.0D))").alias("b"),
        F.expr("id % 4 = 1").alias("c"), F.expr("CAST(id % 13 AS STRING)").alias("d"),
        F.expr("CAST(id * 13 % 11 < 4 AS INT)").alias("y"),
    )
    features = ["a", "b", "c", "d", "absent"]
    found = fit_linear(rows, features, "y").model
    plain = models.LogisticRegression(weightCol="weight", maxIter=15).fit(models.training_frame(rows, features, "y"))
    assert found.coefficients.toArray() == pytest.approx(plain.coefficients.toArray(), rel=1e-9, abs=1e-12)
    assert found.intercept == pytest.approx(plain.intercept, rel=1e-9)


def test_wide_jobs_run_in_short_methods(spark, monkeypatch, high_limit):
    seen = []

    def watched(df):
        seen.append(int(spark.conf.get(LIMIT)))
        return settle(df)

    monkeypatch.setattr(engineering, "settle", watched)
    monkeypatch.setattr(models, "settle", watched)
    rows = spark.createDataFrame([("Steady", "No", 1, 7), ("No", "<30", 2, 8)], "metformin string, readmitted string, num_procedures int, encounter_id long")
    assert not set(rows.columns) - {f.name for f in encounter_schema()} - {"encounter_id"}
    engineering.engineer(rows, ["encounter_id"])
    fit_linear(spark.range(20).select(F.expr("id % 3").alias("a"), F.expr("CAST(id % 2 AS INT)").alias("y")), ["a"], "y")
    assert seen and max(seen) <= METHOD_BYTES
    assert spark.conf.get(LIMIT) == "65535"


def test_the_limit_comes_back(spark, high_limit):
    with pytest.raises(ZeroDivisionError), compiled(spark), compiled(spark):
        raise ZeroDivisionError
    first, second = compiled(spark), compiled(spark)
    first.__enter__()
    second.__enter__()
    first.__exit__(None, None, None)  # as by threads, the first may end before the second
    assert spark.conf.get(LIMIT) == str(METHOD_BYTES)
    second.__exit__(None, None, None)
    assert spark.conf.get(LIMIT) == "65535"
    spark.conf.set(LIMIT, "1000")
    with compiled(spark):
        assert spark.conf.get(LIMIT) == "1000"


def test_means_leave_missing_values_out(spark):
    rows = spark.createDataFrame(
        [(1, 2.0, True, "3", None, 2**60, float("inf")), (None, float("nan"), False, "x", None, 2**60, 1.0), (4, 5.0, None, " 4 ", None, None, 2.0)],
        "`a.b` int, d double, t boolean, s string, e double, w long, i double",
    ).repartition(3)
    found = fit_mean_fill(rows, rows.columns)
    assert found.columns == rows.columns
    assert found.means == [2.5, 3.5, 0.5, 3.5, 0.0, float(2**60), math.inf]
    assert fit_mean_fill(rows.limit(0), ["d", "w"]).means == [0.0, 0.0]
