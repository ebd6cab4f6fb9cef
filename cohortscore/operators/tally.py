"""Tallies: how often each distinct value of each column meets each class.

A tally has one row per (feature, x) with the counts ``pos`` and ``neg``. It is
built with map-side partial sums, so a value that fills a third of the table is
still one row per task before the shuffle. Ranking metrics, curves, optimal
cutoffs and exact quantiles all follow from running sums over a tally.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortscore.functions.numeric import quoted, to_double
from cohortscore.session import settle


def long_scores(df: DataFrame, label: Column | str, features: Sequence[str]) -> DataFrame:
    """(y, feature, x): one row per value, missing values and labels left out."""
    y = quoted(label) if isinstance(label, str) else label
    wide = df.select(
        y.cast("int").alias("y"), *[to_double(df, c).alias(c) for c in features]
    ).where(F.col("y").isNotNull())
    long = wide.unpivot(["y"], [quoted(c) for c in features], "feature", "x")
    return long.where(F.col("x").isNotNull())


def tally(df: DataFrame, label: Column | str, features: Sequence[str]) -> DataFrame:
    return count_values(long_scores(df, label, features))


def count_values(long: DataFrame) -> DataFrame:
    """The tally of (y, feature, x)."""
    return long.groupBy("feature", "x").agg(
        F.sum(F.col("y").cast("bigint")).alias("pos"),
        F.sum((1 - F.col("y")).cast("bigint")).alias("neg"),
    )


def value_tally(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """A tally without label: every row counts as ``pos``."""
    return tally(df, F.lit(1), features)


def placed(t: DataFrame, cell_rows: int | None = None) -> DataFrame:
    """The tally, stored in the order of feature and value, with the ``cell`` of each row.

    Rows are range-partitioned over all features at once and a cell is the
    partition a row is in, so cells hold about as many rows as each other, or,
    with ``cell_rows``, that many neighbours within a partition. A feature meets a new cell only where its values or the
    partition end: there are no more (feature, cell) pairs than cells and
    features together.
    """
    keys = ["feature", "x"]
    ranged = t.repartitionByRange(*keys)
    if cell_rows is None:
        return settle(ranged.withColumn("cell", F.spark_partition_id()))
    # The id counts the rows of a partition in its lower 33 bits.
    row = F.monotonically_increasing_id()
    cell = row - row.bitwiseAND(F.lit((1 << 33) - 1)) % cell_rows
    return settle(ranged.sortWithinPartitions(*keys).withColumn("cell", cell))


def ordered_points(t: DataFrame, *, bounded: bool = False, cell_rows: int | None = None) -> DataFrame:
    """Running class counts from the highest value down.

    Adds to each tally row ``tp`` and ``fp``, the positives and negatives at or
    above ``x``, the tally of the next lower value (``next_pos``, ``next_neg``,
    missing at the lowest), and the feature's totals. A global order cannot be summed in
    one window task at scale, so the rows are placed in cells: a short running
    sum over the cell totals gives each cell its start, and the rows of each
    cell are summed where they are. ``bounded=True`` promises a tally that is
    small by construction (flags, cutoff grids) and stays in one cell; a tally
    that ``placed`` has stored already is used as it is.
    """
    if bounded:
        t = t.withColumn("cell", F.lit(0))
    elif "cell" not in t.columns:
        t = placed(t, cell_rows)
    cells = t.groupBy("feature", "cell").agg(
        F.sum("pos").alias("cell_pos"),
        F.sum("neg").alias("cell_neg"),
        F.min("x").alias("cell_min"),
        F.max("x").alias("cell_max"),
        F.count("x").alias("cell_rows"),
        F.max_by(F.struct("pos", "neg"), "x").alias("cell_top"),
    )
    above = Window.partitionBy("feature").orderBy(F.desc("cell")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("feature")
    downwards = Window.partitionBy("feature").orderBy(F.desc("cell"))
    starts = cells.select(
        "feature",
        "cell",
        F.coalesce(F.sum("cell_pos").over(above), F.lit(0)).alias("pos_above"),
        F.coalesce(F.sum("cell_neg").over(above), F.lit(0)).alias("neg_above"),
        F.sum("cell_pos").over(whole).alias("p_total"),
        F.sum("cell_neg").over(whole).alias("n_total"),
        F.min("cell_min").over(whole).alias("x_min"),
        F.max("cell_max").over(whole).alias("x_max"),
        F.sum("cell_rows").over(whole).alias("n_distinct"),
        F.lead("cell_top").over(downwards).alias("below"),
    )
    inside = (
        Window.partitionBy("feature", "cell").orderBy(F.desc("x")).rowsBetween(Window.unboundedPreceding, 0)
    )
    local = t.select(
        "feature",
        "cell",
        "x",
        "pos",
        "neg",
        F.sum("pos").over(inside).alias("pos_here"),
        F.sum("neg").over(inside).alias("neg_here"),
        F.lead(F.struct("pos", "neg")).over(Window.partitionBy("feature", "cell").orderBy(F.desc("x"))).alias("next"),
    )
    # ``starts`` has no more rows than there are cells and features together.
    return local.join(F.broadcast(starts), ["feature", "cell"]).select(
        "feature",
        "x",
        "pos",
        "neg",
        (F.col("pos_here") + F.col("pos_above")).alias("tp"),
        (F.col("neg_here") + F.col("neg_above")).alias("fp"),
        F.coalesce("next", "below")["pos"].alias("next_pos"),
        F.coalesce("next", "below")["neg"].alias("next_neg"),
        "p_total",
        "n_total",
        "x_min",
        "x_max",
        "n_distinct",
    )


def quantile_grid(points: DataFrame, parts: int) -> DataFrame:
    """Exact linear-interpolated quantiles 0, 1/parts, ..., 1 per feature.

    Each value knows the ranks it covers from its running counts, hence the
    grid positions that fall on it; no sort and no join is needed. Also gives
    the number of rows at or above, and above, each quantile.
    """
    n = F.col("p_total") + F.col("n_total")
    at_or_above = F.col("tp") + F.col("fp")
    upto = n - at_or_above + F.col("pos") + F.col("neg")  # ranks below this value's end
    below = n - at_or_above  # ranks below this value's start

    last = F.col("last")

    def positions(start: Column, end: Column) -> Column:
        lo = _ceil_div(F.greatest(start, F.lit(0)) * parts, last)
        hi = F.when(end >= F.col("n"), F.lit(parts)).otherwise(_ceil_div(end * parts, last) - 1)
        return F.when(lo <= hi, F.sequence(lo, hi))

    base = points.select("feature", "x", n.alias("n"), F.greatest(n - 1, F.lit(1)).alias("last"),
                         at_or_above.alias("ge"), below.alias("below"), upto.alias("upto"))
    base = base.withColumn("gt", F.col("n") - F.col("upto"))
    marks = F.concat(
        F.coalesce(
            F.transform(positions(F.col("below"), F.col("upto")),
                        lambda k: F.struct(k.alias("k"), F.lit(True).alias("is_low"))),
            F.array().cast("array<struct<k: bigint, is_low: boolean>>"),
        ),
        F.coalesce(
            F.transform(positions(F.col("below") - 1, F.col("upto") - 1),
                        lambda k: F.struct(k.alias("k"), F.lit(False).alias("is_low"))),
            F.array().cast("array<struct<k: bigint, is_low: boolean>>"),
        ),
    )
    hit = base.select("feature", "x", "n", "last", "ge", "gt", F.explode(marks).alias("m"))
    low = F.col("m.is_low")
    both = hit.groupBy("feature", F.col("m.k").alias("k")).agg(
        F.max(F.when(low, F.col("x"))).alias("x_low"),
        F.max(F.when(~low, F.col("x"))).alias("x_high"),
        F.max(F.when(low, F.col("ge"))).alias("ge"),
        F.max(F.when(low, F.col("gt"))).alias("gt"),
        F.max("n").alias("n"),
        F.max("last").alias("last"),
    )
    both = both.where(F.col("x_low").isNotNull())
    part = ((F.col("k") * F.col("last")) % parts) / F.lit(float(parts))
    part = F.when(F.col("n") == 1, F.lit(0.0)).otherwise(part)
    step = F.when(part > 0, F.coalesce(F.col("x_high"), F.col("x_low")) - F.col("x_low")).otherwise(0.0)
    value = F.col("x_low") + step * part
    return both.select(
        "feature",
        "k",
        (F.col("k") / F.lit(float(parts))).alias("q"),
        value.alias("value"),
        F.when(value > F.col("x_low"), F.col("gt")).otherwise(F.col("ge")).alias("at_or_above"),
        F.col("gt").alias("above"),
        "n",
    )


def _ceil_div(a: Column, b: Column) -> Column:
    """Ceiling of a / b for non-negative bigints."""
    return F.call_function("div", a + b - 1, b)
