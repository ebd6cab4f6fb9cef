"""Seeded splits and folds that give the same answer on every run.

Rows are ordered by the md5 of seed and id. A split needs no sort of the table:
counting rows per leading hash digits finds the few cells in which a boundary
falls, only those cells are ranked, and the boundary hashes then assign every
row by comparison. Quotas and boundaries are tables with a row per class, so
there may be as many classes as there are rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortscore.functions.numeric import quoted
from cohortscore.operators.keys import SMALL_ROWS, lookup_join, prefix_sums
from cohortscore.session import settle

CELL_DIGITS = 4  # 65,536 cells, filled evenly by the hash


def order_hash(id_column: Column, seed: int) -> Column:
    """The place of an id in the seeded order; rows without id share one."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(id_column.cast("string"), F.lit(""))))


def _class(by: str | None) -> Column:
    return quoted(by).cast("string") if by else F.lit("all")


def _keyed(df: DataFrame, id_column: str, by: str | None, seed: int) -> DataFrame:
    keys = df.select(_class(by).alias("grp"), quoted(id_column).alias("id"))
    keys = keys.where(F.col("grp").isNotNull())
    return keys.withColumn("h", order_hash(F.col("id"), seed)).withColumn(
        "cell", F.substring("h", 1, CELL_DIGITS)
    )


def seeded_positions(
    df: DataFrame, id_column: str, by: str | None = None, seed: int = 42, out: str = "pos", small_rows: int = SMALL_ROWS
) -> DataFrame:
    """Add the 1-based position of each row in the seeded order of its class.

    For use where the position itself is wanted. Rows without id, or without
    class, are kept: a missing class is one of its own. Rows of one id are
    ordered by a hash of all their columns, so that many of them, like rows
    without id, spread over the range partitions of the whole order.
    """
    rows = settle(
        df.select(
            "*", _class(by).alias("__grp"), order_hash(quoted(id_column), seed).alias("__h"),
            F.xxhash64(*[quoted(c).cast("string") for c in df.columns]).alias("__row"),
        )
    )
    order = [F.col("__grp"), F.col("__h"), quoted(id_column), F.col("__row")]
    placed = prefix_sums(rows, order, F.lit(1), "__before", small_rows)
    sizes = settle(rows.groupBy("__grp").agg(F.count("*").alias("__n")))
    firsts = settle(prefix_sums(sizes, [F.col("__grp")], F.col("__n"), "__first", small_rows).drop("__n"))
    # A missing class comes first in the order, so it starts at nothing.
    joined = lookup_join(placed, firsts, ["__grp"], small_rows)
    position = F.col("__before") - F.coalesce("__first", F.lit(0)) + 1
    return joined.select(*[quoted(c) for c in df.columns], position.alias(out))


@dataclass
class Boundaries:
    """Per class (``grp``) the ascending ``cuts`` (hash, id): a row's part is the number of those it passes."""

    id_column: str
    by: str | None
    seed: int
    table: DataFrame
    small_rows: int = SMALL_ROWS

    def assign(self, df: DataFrame, out: str) -> DataFrame:
        """Add the part of each row. Where boundaries are few, rows stay where they are."""
        row_id = quoted(self.id_column)
        hashed = df.select("*", order_hash(row_id, self.seed).alias("__h"), _class(self.by).alias("grp"))
        joined = lookup_join(hashed, self.table, ["grp"], self.small_rows)

        def passed(cut: Column) -> Column:
            # A missing id comes first among those of its hash.
            later = F.when(cut["id"].isNull(), row_id.isNotNull()).otherwise(F.coalesce(row_id > cut["id"], F.lit(False)))
            return (F.col("__h") > cut["h"]) | ((F.col("__h") == cut["h"]) & later)

        part = F.size(F.filter("cuts", passed))
        return joined.select(*[quoted(c) for c in df.columns], part.alias(out))


def class_cells(df: DataFrame, id_column: str, by: str | None, seed: int) -> DataFrame:
    """(grp, cell, n): rows per hash cell of each class; 65,536 cells of a class at most."""
    keys = _keyed(df, id_column, by, seed)
    return settle(keys.groupBy("grp", "cell").agg(F.count("*").alias("n")))


def class_sizes(cells: DataFrame) -> DataFrame:
    """(grp, n), stored."""
    return settle(cells.groupBy("grp").agg(F.sum("n").alias("n")))


def fit_boundaries(
    df: DataFrame, cells: DataFrame, id_column: str, by: str | None, seed: int, ranks: DataFrame, small_rows: int = SMALL_ROWS
) -> Boundaries:
    """Hashes of the rows at the 1-based ``ranks`` (grp, part, rank) of each class's order.

    Rank 0 stands for "before the first row". Everything stays a table, however
    many classes there are. Rows of one id are one entry with a count.
    """
    ranks = settle(ranks)
    upto = Window.partitionBy("grp").orderBy("cell")
    ends = cells.withColumn("end", F.sum("n").over(upto))
    start = F.col("end") - F.col("n")
    homes = settle(
        ends.join(ranks, "grp")
        .where((F.col("rank") <= F.col("end")) & (F.col("rank") > start))
        .select("grp", "cell", "part", (F.col("rank") - start).alias("local"))
    )
    near = _keyed(df, id_column, by, seed).join(homes.select("grp", "cell").distinct(), ["grp", "cell"], "left_semi")
    entries = near.groupBy("grp", "cell", "h", "id").agg(F.count("*").alias("n"))
    inside = Window.partitionBy("grp", "cell").orderBy("h", "id")
    last = entries.withColumn("last", F.sum("n").over(inside))
    hits = last.join(homes, ["grp", "cell"]).where(
        (F.col("local") <= F.col("last")) & (F.col("local") > F.col("last") - F.col("n"))
    )
    # Every hash is greater than the empty text, so rank 0 is passed by all rows.
    none = ranks.where("rank = 0").select("grp", "part", F.lit("").alias("h"), F.lit(None).cast(df.schema[id_column].dataType).alias("id"))
    cuts = hits.select("grp", "part", "h", "id").unionByName(none)
    table = cuts.groupBy("grp").agg(F.collect_list(F.struct("h", "id")).alias("cuts"))
    return Boundaries(id_column, by, seed, settle(table), small_rows)


def _whole_ranks(df: DataFrame, ranks: Sequence[int]) -> DataFrame:
    rows = [("all", i, r) for i, r in enumerate(ranks)]
    return df.sparkSession.createDataFrame(rows, "grp string, part int, rank long")


def _size_of_all(cells: DataFrame) -> int:
    return cells.agg(F.sum("n")).first()[0] or 0


def split_by_share(df: DataFrame, id_column: str, train_share: float, seed: int = 42, out: str = "split") -> DataFrame:
    """The first ``floor(share * n)`` rows of the seeded order are train."""
    cells = class_cells(df, id_column, None, seed)
    k = int(_size_of_all(cells) * Fraction(str(train_share)))
    cut = fit_boundaries(df, cells, id_column, None, seed, _whole_ranks(df, [k]))
    return _tagged(cut.assign(df, out), out, "train", "test")


def _tagged(df: DataFrame, out: str, first: str, second: str) -> DataFrame:
    return df.withColumn(out, F.when(F.col(out) <= 0, F.lit(first)).otherwise(F.lit(second)))


def class_quotas(sizes: DataFrame, total: int, small_rows: int = SMALL_ROWS) -> DataFrame:
    """(grp, quota): ``total`` shared out to classes (grp, n) by size, largest remainders first; exact."""
    n = max(sizes.agg(F.sum("n")).first()[0] or 0, 1)
    wide = F.col("n").cast("decimal(38,0)") * F.lit(total).cast("decimal(19,0)")
    shares = settle(
        sizes.select("grp", wide.alias("share")).select(
            "grp", F.expr(f"share DIV {n}").cast("long").alias("base"), F.expr(f"share % {n}").alias("rest")
        )
    )
    left = total - (shares.agg(F.sum("base")).first()[0] or 0)
    ordered = prefix_sums(shares, [F.desc("rest"), F.col("grp")], F.lit(1), "before", small_rows)
    return ordered.select("grp", (F.col("base") + (F.col("before") < left).cast("long")).alias("quota"))


def stratified_split(
    df: DataFrame, id_column: str, label: str, test_share: float = 0.20, seed: int = 42, out: str = "split",
    small_rows: int = SMALL_ROWS,
) -> DataFrame:
    """Holdout of ``ceil(share * n)`` rows with the classes in proportion.

    Rows without a label are dropped. Rows without id stay together in a class.
    """
    cells = class_cells(df, id_column, label, seed)
    sizes = class_sizes(cells)
    n_test = math.ceil(_size_of_all(sizes) * Fraction(str(test_share)))
    ranks = class_quotas(sizes, n_test, small_rows).select("grp", F.lit(0).alias("part"), F.col("quota").alias("rank"))
    cut = fit_boundaries(df, cells, id_column, label, seed, ranks, small_rows)
    return _tagged(cut.assign(df.where(quoted(label).isNotNull()), out), out, "test", "train")


def _fold_ends(n: Column, k: int, skip: Column) -> Column:
    """Ranks at which the first k - 1 of k folds over n rows end; larger folds start after ``skip`` folds."""
    ends = []
    for i in range(k - 1):
        larger = sum(((F.pmod(F.lit(j) - skip, F.lit(k)) < n % k).cast("long") for j in range(i + 1)), F.lit(0))
        ends.append(F.floor(n / k) * (i + 1) + larger)
    return F.posexplode(F.array(*ends)).alias("part", "rank")


def _folded(df: DataFrame, out: str) -> DataFrame:
    return df.withColumn(out, F.greatest(F.col(out), F.lit(0)))


def k_folds(df: DataFrame, id_column: str, k: int = 5, seed: int = 42, out: str = "fold") -> DataFrame:
    """Folds 0..k-1: consecutive blocks of the seeded order."""
    cells = class_cells(df, id_column, None, seed)
    if k == 1:
        return df.withColumn(out, F.lit(0))
    n = _size_of_all(cells)
    ranks = df.sparkSession.createDataFrame([("all", n)], "grp string, n long").select("grp", _fold_ends(F.col("n"), k, F.lit(0)))
    cut = fit_boundaries(df, cells, id_column, None, seed, ranks)
    return _folded(cut.assign(df, out), out)


def stratified_folds(
    df: DataFrame, id_column: str, label: str, k: int = 5, seed: int = 42, out: str = "fold", small_rows: int = SMALL_ROWS
) -> DataFrame:
    """Folds with the classes in proportion; fold sizes differ by one row at most.

    Each class is cut into k consecutive blocks; the larger blocks of a class
    follow on from those of the class before it. Rows without a label are
    dropped, rows without id stay together in a class.
    """
    labelled = df.where(quoted(label).isNotNull())
    if k == 1:
        return labelled.withColumn(out, F.lit(0))
    cells = class_cells(df, id_column, label, seed)
    before = prefix_sums(class_sizes(cells), [F.col("grp")], F.col("n"), "before", small_rows)
    ranks = before.select("grp", _fold_ends(F.col("n"), k, F.col("before") % k))
    cut = fit_boundaries(df, cells, id_column, label, seed, ranks, small_rows)
    return _folded(cut.assign(labelled, out), out)


def seeded_sample(df: DataFrame, id_column: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows in seeded random order (a top-n, no full sort)."""
    h = order_hash(quoted(id_column), seed)
    return df.orderBy(h, quoted(id_column)).limit(n)
