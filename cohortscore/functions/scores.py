"""Scores, cutoff grids and threshold flags."""

from __future__ import annotations

import math
from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortscore.functions.numeric import quoted, to_double

# Allowed flag thresholds and the name of a flag column.
LOWEST_FLAG, HIGHEST_FLAG = 0.05, 1.0
FLAG_FORMAT = "%s_ge_%03dpct"


def ensemble_mean(a: Column, b: Column) -> Column:
    """Mean of two scores; NULL if either is."""
    return (a + b) / 2.0


def flag_thresholds(start: float, end: float, step: float, listed: Sequence[float] | None = None) -> list[float]:
    """Thresholds with two decimals, ascending and distinct, all in [0.05, 1]."""
    if listed is None:
        steps = math.floor((end - start) / step + 1e-9)
        listed = [start + i * step for i in range(steps + 1)]
    grid = sorted({round(float(t), 2) for t in listed})
    outside = [t for t in grid if not LOWEST_FLAG <= t <= HIGHEST_FLAG]
    if outside:
        raise ValueError(f"thresholds outside [{LOWEST_FLAG}, {HIGHEST_FLAG}]: {outside}")
    return grid


def flag_name(column: str, threshold: float) -> str:
    return FLAG_FORMAT % (column, round(threshold * 100))


def threshold_flags(
    df: DataFrame,
    columns: Sequence[str],
    start: float = 0.05,
    end: float = 1.0,
    step: float = 0.05,
    listed: Sequence[float] | None = None,
    preserve_na: bool = True,
) -> DataFrame:
    """Add one 0/1 flag per column and threshold, all in a single projection."""
    grid = flag_thresholds(start, end, step, listed)
    flags = []
    for c in columns:
        score = to_double(df, c)
        for t in grid:
            flag = (score >= t).cast("int")
            flags.append((flag if preserve_na else F.coalesce(flag, F.lit(0))).alias(flag_name(c, t)))
    return df.select("*", *flags)


def symmetric_thresholds(center: float, spread: float, step: float, digits: int) -> list[float]:
    """Grid of ``center`` plus/minus ``spread``, rounded, descending."""
    half = int(Fraction(str(spread)) / Fraction(str(step)))
    return [round(center + i * step, digits) for i in range(half, -half - 1, -1)]


def cutoff_label(threshold: Column) -> Column:
    return F.format_string("%.2f%%", threshold * 100)


def hard_prediction(score: Column, threshold: float) -> Column:
    return (score >= threshold).cast("int")


def looks_like_probability(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """(column, n, low, high, is_probability) for each column, in one pass."""
    parts = []
    for c in names:
        v = to_double(df, c)
        parts.append(
            F.struct(
                F.lit(c).alias("column"),
                F.count(v).alias("n"),
                F.min(v).alias("low"),
                F.max(v).alias("high"),
            )
        )
    ranges = df.agg(F.array(*parts).alias("r")).select(F.explode("r").alias("r")).select("r.*")
    ok = (F.col("n") > 0) & (F.col("low") >= 0) & (F.col("high") <= 1)
    return ranges.withColumn("is_probability", F.coalesce(ok, F.lit(False)))


def range_columns(values: Sequence[Column]) -> list[Column]:
    """Aggregates lo0, hi0, lo1, hi1, ...: the ranges of several columns."""
    lows = [F.min(v).alias(f"lo{i}") for i, v in enumerate(values)]
    return lows + [F.max(v).alias(f"hi{i}") for i, v in enumerate(values)]


def filled_scores(df: DataFrame, names: Sequence[str]) -> list[Column]:
    return [F.coalesce(to_double(df, c), F.lit(0.0)) for c in names]


def to_probability(df: DataFrame, names: Sequence[str], ranges=None) -> DataFrame:
    """Missing scores become 0; a column outside [0, 1] is squashed as a whole.

    The ranges of all columns come from one aggregate over the table, unless
    the caller has that row already; the projection that follows needs no join.
    """
    filled = filled_scores(df, names)
    ranges = ranges or df.agg(*range_columns(filled)).first()
    out = {}
    for i, (c, v) in enumerate(zip(names, filled)):
        low, high = ranges[f"lo{i}"], ranges[f"hi{i}"]
        inside = low is None or (low >= 0 and high <= 1)
        out[c] = v if inside else 1.0 / (1.0 + F.exp(-v))
    return df.withColumns(out)


def min_max_scale(df: DataFrame, names: Sequence[str], suffix: str = "_scaled") -> DataFrame:
    """(x - min) / (max - min); NULL for a constant column."""
    values = {c: to_double(df, c) for c in names}
    bounds = df.agg(*range_columns(list(values.values()))).first()
    out = {}
    for i, (c, v) in enumerate(values.items()):
        low, high = bounds[f"lo{i}"], bounds[f"hi{i}"]
        flat = low is None or high <= low
        out[c + suffix] = F.lit(None).cast("double") if flat else (v - low) / (high - low)
    return df.withColumns(out)
