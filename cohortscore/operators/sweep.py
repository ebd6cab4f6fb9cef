"""Confusion counts of several scores at many cutoffs, in one pass.

Each row falls between two neighbouring cutoffs. Counting rows per gap and
summing the gaps from the top gives the counts at every cutoff, so the work
does not grow with the number of cutoffs and the shuffle carries at most
models x cutoffs rows per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortscore.operators.tally import long_scores

INF = float("inf")


def threshold_sweep(
    df: DataFrame, label: Column | str, scores: Sequence[str], thresholds: Sequence[float]
) -> DataFrame:
    """(model, threshold, tn, fp, fn, tp) with ``score >= threshold`` as positive."""
    rows = long_scores(df, label, scores).select(
        F.col("feature").alias("model"), "x", F.lit(1).cast("bigint").alias("n"), F.col("y").cast("bigint").alias("y")
    )
    return _sweep(rows, scores, thresholds)


def sweep_tally(t: DataFrame, models: Sequence[str], thresholds: Sequence[float]) -> DataFrame:
    """The same from a tally instead of the table."""
    rows = t.select(
        F.col("feature").alias("model"), "x", (F.col("pos") + F.col("neg")).alias("n"), F.col("pos").alias("y")
    )
    return _sweep(rows, models, thresholds)


def _sweep(rows: DataFrame, models: Sequence[str], thresholds: Sequence[float]) -> DataFrame:
    grid = sorted(set(thresholds))
    # Bucketizer finds the gap by exact comparison, not by division.
    gaps = Bucketizer(splits=[-INF, *grid, INF], inputCol="x", outputCol="gap").transform(rows)
    # Every gap once with zero rows, so that empty gaps appear too.
    cuts = ", ".join(f"{t!r}D" for t in grid)
    zero = F.lit(0).cast("bigint")
    empty = (
        rows.sparkSession.range(1)
        .select(F.posexplode(F.expr(f"array(cast(null as double), {cuts})")).alias("gap", "threshold"))
        .select(F.explode(F.array(*[F.lit(m) for m in models])).alias("model"), "gap", "threshold")
        .select("model", F.col("gap").cast("double").alias("gap"), "threshold", zero.alias("n"), zero.alias("y"))
    )
    no_threshold = F.lit(None).cast("double").alias("threshold")
    slots = (
        gaps.select("model", "gap", no_threshold, "n", "y")
        .unionByName(empty)
        .groupBy("model", "gap")
        .agg(
            F.max("threshold").alias("threshold"),
            F.sum("y").alias("pos"),
            F.sum(F.col("n") - F.col("y")).alias("neg"),
        )
    )
    # At most one row per cutoff and model from here on.
    down = Window.partitionBy("model").orderBy(F.desc("gap")).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("model")
    tp, fp = F.sum("pos").over(down), F.sum("neg").over(down)
    return slots.select(
        "model",
        "threshold",
        (F.sum("neg").over(whole) - fp).alias("tn"),
        fp.alias("fp"),
        (F.sum("pos").over(whole) - tp).alias("fn"),
        tp.alias("tp"),
    ).where(F.col("threshold").isNotNull())


def flag_tally(sweep: DataFrame, name: Column) -> DataFrame:
    """The tally of 0/1 flags that a sweep stands for, ``name`` naming each flag."""
    sides = F.array(
        F.struct(F.lit(1.0).alias("x"), F.col("tp").alias("pos"), F.col("fp").alias("neg")),
        F.struct(F.lit(0.0).alias("x"), F.col("fn").alias("pos"), F.col("tn").alias("neg")),
    )
    return (
        sweep.select(name.alias("feature"), F.explode(sides).alias("s"))
        .select("feature", "s.x", "s.pos", "s.neg")
        .where(F.col("pos") + F.col("neg") > 0)
    )
