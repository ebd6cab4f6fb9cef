"""Joins and running sums over keys of which one may hold a third of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortscore.functions.numeric import quoted
from cohortscore.session import settle

#: Rows of a table that is broadcast whole, and of one whose running sum is taken in one task.
SMALL_ROWS = 100_000
#: A key is heavy if it has this share of the rows or more, so there are no more heavy keys than its inverse.
HEAVY_SHARE = 0.001


def lookup_join(
    rows: DataFrame, table: DataFrame, on: Sequence[str], small_rows: int = SMALL_ROWS, heavy_share: float = HEAVY_SHARE
) -> DataFrame:
    """``rows`` left joined with a stored ``table`` that has each key once.

    A small table is broadcast, after a count. Of a larger one only the part of
    heavy keys is, which its share bounds; all other rows meet the rest in a
    shuffle, where no key is heavy. Null keys match nothing and are not shuffled.
    """
    on = list(on)
    if table.count() <= small_rows:
        return rows.join(F.broadcast(table), on, "left")
    known = None
    for c in on:
        known = quoted(c).isNotNull() if known is None else known & quoted(c).isNotNull()
    counts = settle(rows.where(known).groupBy(*on).agg(F.count("*").alias("__n")))
    total = counts.agg(F.sum("__n")).first()[0] or 0
    heavy = counts.where(F.col("__n") >= max(2.0, heavy_share * total)).select(*on, F.lit(True).alias("__heavy"))
    tagged = rows.join(F.broadcast(heavy), on, "left")
    some = table.join(F.broadcast(heavy), on, "left_semi")
    aside = ~known | F.col("__heavy").isNotNull()
    first = tagged.where(aside).drop("__heavy").join(F.broadcast(some), on, "left")
    return first.unionByName(tagged.where(~aside).drop("__heavy").join(table.hint("shuffle_hash"), on, "left"))


def prefix_sums(
    rows: DataFrame, order: Sequence[Column], value: Column, out: str, small_rows: int = SMALL_ROWS
) -> DataFrame:
    """``rows`` (stored) with the sum of ``value`` over all rows before each in the whole ``order``.

    Few rows, which are counted, are summed in one window. Others are stored in
    range partitions over the whole order, so that equal leading keys spread;
    partition totals give each its start. Rows equal in all of ``order`` come
    in any order.
    """
    names = [quoted(c) for c in rows.columns]
    if rows.count() <= small_rows:
        before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return rows.select(*names, F.coalesce(F.sum(value).over(before), F.lit(0)).alias(out))
    placed = settle(rows.repartitionByRange(*order).withColumn("__cell", F.spark_partition_id()))
    totals = placed.groupBy("__cell").agg(F.sum(value).alias("__total"))  # one row per partition
    earlier = Window.orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("__cell", F.coalesce(F.sum("__total").over(earlier), F.lit(0)).alias("__start"))
    inside = Window.partitionBy("__cell").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = placed.select(*names, "__cell", F.coalesce(F.sum(value).over(inside), F.lit(0)).alias("__local"))
    return local.join(F.broadcast(starts), "__cell").select(*names, (F.col("__start") + F.col("__local")).alias(out))
