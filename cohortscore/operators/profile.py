"""Column profiles: value counts, summaries, histograms, correlations, detection."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortscore.functions.numeric import quoted, to_double
from cohortscore.functions.scores import looks_like_probability
from cohortscore.operators.tally import long_scores, ordered_points, quantile_grid, value_tally
from cohortscore.session import settle

# Label names tried in this order.
LABEL_NAMES = ["label", "target", "readmitted", "y", "y_true", "is_readmitted", "Readmitted", "READMITTED"]


def value_counts(df: DataFrame, name: str) -> DataFrame:
    """(value, n) of the non-null values, most frequent first, ties by value."""
    value = quoted(name)
    counts = df.where(value.isNotNull()).groupBy(value.alias("value")).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), "value")


def top_categories(df: DataFrame, name: str, k: int = 10) -> DataFrame:
    return value_counts(df, name).limit(k)


def long_values(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """(column, value) with values as text, NULLs included."""
    text = df.select(*[quoted(c).cast("string").alias(c) for c in names])
    return text.unpivot([], [quoted(c) for c in names], "column", "value")


def profile_counts(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """(column, value, n) for all columns in one pass; NULL is a value here."""
    return long_values(df, names).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def full_profile(df: DataFrame) -> DataFrame:
    """One row per column: n, n_null, n_distinct, mode, and for numbers mean, std, min, q25, q50, q75, max.

    The table is read once, into counts per column and value; everything else
    comes from those. Means and squares are sums over distinct values, squares
    from the mean, so nothing is lost to cancellation. Quartiles are exact and
    interpolated. The mode is the most frequent value, of equals the first.
    """
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    counts = settle(profile_counts(df, df.columns))
    value, n = F.col("value"), F.col("n")
    facts = counts.groupBy("column").agg(
        F.sum("n").alias("n"), F.coalesce(F.sum(F.when(value.isNull(), n)), F.lit(0)).alias("n_null"),
        F.count("value").alias("n_distinct"), F.min(F.when(value.isNotNull(), F.struct((-n).alias("k"), "value")))["value"].alias("mode"),
    )
    numbers = counts.where(F.col("column").isin(numeric)).select("column", value.cast("double").alias("x"), "n").where(F.col("x").isNotNull())
    means = numbers.groupBy("column").agg((F.sum(F.col("x") * n) / F.sum("n")).alias("mean"))  # a row per column
    away = numbers.join(F.broadcast(means), "column").withColumn("d", F.col("x") - F.col("mean"))
    spread = F.sqrt(F.sum(F.col("d") * F.col("d") * n) / F.nullif(F.sum("n") - 1, F.lit(0)))
    moments = away.groupBy("column").agg(F.first("mean").alias("mean"), spread.alias("std"))
    tallied = numbers.select(F.col("column").alias("feature"), "x", n.alias("pos"), F.lit(0).cast("long").alias("neg"))
    grid = quantile_grid(ordered_points(tallied), 4)
    marks = grid.groupBy(F.col("feature").alias("column")).agg(
        *[F.max(F.when(F.col("k") == k, F.col("value"))).alias(name) for k, name in enumerate(["min", "q25", "q50", "q75", "max"])]
    )
    # One row per column on every side.
    return facts.join(F.broadcast(moments), "column", "left").join(F.broadcast(marks), "column", "left")


def modes(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """(column, mode, n): most frequent value, lowest text of ties."""
    counts = profile_counts(df, names).where(F.col("value").isNotNull())
    best = F.min_by(F.struct("value", "n"), F.struct(-F.col("n"), "value"))
    return counts.groupBy("column").agg(best.alias("b")).select("column", F.col("b.value").alias("mode"), "b.n")


def describe_text(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """(column, count, unique, top, freq) of text columns."""
    counts = profile_counts(df, names).where(F.col("value").isNotNull())
    best = F.min_by(F.struct("value", "n"), F.struct(-F.col("n"), "value"))
    return (
        counts.groupBy("column")
        .agg(F.sum("n").alias("count"), F.count("value").alias("unique"), best.alias("b"))
        .select("column", "count", "unique", F.col("b.value").alias("top"), F.col("b.n").alias("freq"))
    )


def describe_numeric(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """(column, count, mean, std, min, q25, q50, q75, max), quartiles exact."""
    points = ordered_points(value_tally(df, names))
    quartiles = quantile_grid(points, 4).groupBy("feature").agg(
        *[F.max(F.when(F.col("k") == k, F.col("value"))).alias(name) for k, name in ((1, "q25"), (2, "q50"), (3, "q75"))]
    )
    plain = long_scores(df, F.lit(1), names).groupBy("feature").agg(
        F.count("x").alias("count"),
        F.avg("x").alias("mean"),
        F.stddev_samp("x").alias("std"),
        F.min("x").alias("min"),
        F.max("x").alias("max"),
    )
    return plain.join(quartiles, "feature").select(
        F.col("feature").alias("column"), "count", "mean", "std", "min", "q25", "q50", "q75", "max"
    )


def null_counts(df: DataFrame) -> DataFrame:
    """(column, n_null) for every column, one aggregate over the table."""
    parts = [
        F.struct(F.lit(c).alias("column"), F.count_if(quoted(c).isNull()).alias("n_null")) for c in df.columns
    ]
    return df.agg(F.array(*parts).alias("p")).select(F.explode("p").alias("p")).select("p.*")


def distinct_over(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Distinct non-null values of several columns taken together."""
    values = F.array(*[quoted(c) for c in names])
    return df.select(F.explode(values).alias("value")).where(F.col("value").isNotNull()).distinct()


def class_balance(df: DataFrame, label: Column) -> DataFrame:
    """One row: pos, neg and scale_pos_weight = neg / max(pos, 1), 1 if no pos."""
    pos, neg = F.count_if(label == 1), F.count_if(label == 0)
    weight = F.when(pos == 0, F.lit(1.0)).otherwise(neg.cast("double") / F.greatest(pos, F.lit(1)))
    return df.agg(pos.alias("pos"), neg.alias("neg"), weight.alias("scale_pos_weight"))


def class_weights(df: DataFrame, label: Column) -> DataFrame:
    """(label, weight) = rows / (2 x rows of the class); empty unless two classes."""
    counts = df.where(label.isNotNull()).groupBy(label.alias("label")).agg(F.count("*").alias("n"))
    counts = counts.orderBy("label").limit(3)  # three labels tell that there are not two
    every = Window.partitionBy()
    weighed = counts.select(
        "label",
        (F.sum("n").over(every) / (2.0 * F.col("n"))).alias("weight"),
        F.count("n").over(every).alias("classes"),
    )
    return weighed.where(F.col("classes") == 2).drop("classes")


def weight_bounds(balance: DataFrame) -> DataFrame:
    """Search range of the positive weight around the one the classes suggest."""
    w = F.col("scale_pos_weight")
    return balance.select(
        F.greatest(F.lit(1.0), F.sqrt(w)).alias("low"), F.greatest(w * 1.5, w + 0.1).alias("high")
    )


def correlations(df: DataFrame, label: Column | str, features: Sequence[str]) -> DataFrame:
    """(feature, correlation): absolute Pearson correlation, NULL for constants."""
    long = long_scores(df, label, features)
    y = F.col("y").cast("double")
    spread = F.stddev_pop("x") * F.stddev_pop(y)
    share = F.abs(F.covar_pop("x", y)) / F.nullif(spread, F.lit(0.0))
    varies = (F.min("x") < F.max("x")) & (F.min("y") < F.max("y"))
    return long.groupBy("feature").agg(F.when(varies, share).alias("correlation"))


def quantiles(df: DataFrame, names: Sequence[str], parts: int = 1000) -> DataFrame:
    """(feature, k, q, value): the exact quantile grid of each column."""
    return quantile_grid(ordered_points(value_tally(df, names)), parts).select("feature", "k", "q", "value")


def histogram(df: DataFrame, names: Sequence[str], bins: int = 1000, on_missing: str = "error") -> DataFrame:
    """(column, bin, low, high, n, density, mean) with equal-width bins.

    All bins appear, the last one closed. Columns without numbers give no row;
    absent columns fail or are skipped by ``on_missing``.
    """
    absent = [c for c in names if c not in df.columns]
    if absent and on_missing == "error":
        raise KeyError(f"columns not found: {absent}")
    names = [c for c in names if c not in absent]
    stats = df.agg(
        *[f(to_double(df, c)).alias(f"{k}{i}") for i, c in enumerate(names)
          for k, f in (("lo", F.min), ("hi", F.max), ("n", F.count), ("mean", F.avg))]
    ).first()
    bounds = {
        c: (stats[f"lo{i}"], stats[f"hi{i}"], stats[f"n{i}"], stats[f"mean{i}"])
        for i, c in enumerate(names)
        if stats[f"n{i}"]
    }
    parts, empty = [], []
    for c, (low, high, n, mean) in bounds.items():
        if low == high:
            low, high = low - 0.5, high + 0.5
        width = (high - low) / bins
        slot = F.least(F.floor((to_double(df, c) - low) / (high - low) * bins), F.lit(bins - 1))
        parts.append(F.struct(F.lit(c).alias("column"), slot.cast("int").alias("bin")))
        empty.append(
            F.struct(
                F.lit(c).alias("column"), F.lit(low).alias("from"), F.lit(width).alias("width"),
                F.lit(n).cast("bigint").alias("total"), F.lit(mean).alias("mean"),
            )
        )
    seen = (
        df.select(F.explode(F.array(*parts)).alias("p"))
        .select("p.*")
        .where(F.col("bin").isNotNull())
        .groupBy("column", "bin")
        .agg(F.count("*").alias("n"))
    )
    grid = df.sparkSession.range(bins).select(
        F.col("id").cast("int").alias("bin"), F.explode(F.array(*empty)).alias("e")
    ).select("e.*", "bin")
    # Both sides hold at most one row per column and bin.
    counted = grid.join(seen, ["column", "bin"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    start = F.col("from") + F.col("bin") * F.col("width")
    return counted.select(
        "column",
        "bin",
        start.alias("low"),
        (start + F.col("width")).alias("high"),
        "n",
        (F.col("n") / (F.col("total") * F.col("width"))).alias("density"),
        "mean",
    )


def binary_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """(column, is_binary): values are 0/1 up to six decimals, three at most."""
    x = F.col("x")
    near = (F.abs(x) <= 5e-7) | (F.abs(x - 1) <= 5e-7)
    # All other values are one group, so few rows leave a task whatever the column holds.
    values = long_scores(df, F.lit(1), names).groupBy("feature", F.when(near, x).alias("v")).count()
    return values.groupBy(F.col("feature").alias("column")).agg(
        (F.bool_and(F.col("v").isNotNull()) & (F.count("v") <= 3)).alias("is_binary")
    )


def detect_label(df: DataFrame) -> str | None:
    """A known label name, else the first column holding nothing but 0 and 1."""
    for name in LABEL_NAMES:
        if name in df.columns:
            return name
    row = df.agg(
        *[
            F.coalesce(F.bool_and(to_double(df, c).isin(0.0, 1.0)), F.lit(False)).alias(f"c{i}")
            for i, c in enumerate(df.columns)
        ]
    ).first()
    return next((c for i, c in enumerate(df.columns) if row[f"c{i}"]), None)


def detect_score(df: DataFrame, tag: str) -> str | None:
    """The column that holds the scores of model ``tag``, by name and range."""
    ranges = looks_like_probability(df, df.columns).collect()  # one row per column
    likely = {r["column"] for r in ranges if r["is_probability"]}
    # Shapes of score names, tried in this order.
    shapes = [
        rf"^{tag}.*(proba|prob|score|pred_prob|pred_proba)$",
        rf"^(proba|prob|score)_{tag}$",
        rf"^{tag}.*(pred|output)$",
        rf"^{tag}.*$",
        tag,
        "",
    ]
    for shape in shapes:
        for c in df.columns:
            if c in likely and re.search(shape, c, re.IGNORECASE):
                return c
    fallback = f"{tag}_pred"
    return fallback if fallback in df.columns else None


def resolve_score(df: DataFrame, tag: str) -> str | None:
    """``<tag>_prob`` where it exists, else the detected column."""
    usual = f"{tag}_prob"
    return usual if usual in df.columns else detect_score(df, tag)


def best_jobs(results: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Row with the highest objective, per ``by`` group or over all."""
    best = F.max_by(F.struct(*[quoted(c) for c in results.columns]), F.struct("objective", "job_name"))
    return results.where(F.col("objective").isNotNull()).groupBy(*by).agg(best.alias("b")).select("b.*")
