"""Exact duplicates by a content sort.

Rows are range-partitioned by sampled splitters over their normalised text,
sorted in each partition by Spark's external sorter, and neighbours whose whole
texts are equal form a run. Splitters are taken from the leading characters and
a hash of the whole text, which bounds what the driver samples; runs are told
apart by the whole text. A salt is part of the sort key, so a group of copies
of any size becomes many runs on many tasks; a second sort of the run heads, at
most one per salt and text, joins the runs again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortscore.llm.common import ascii_lower, packed, unpacked

#: Leading characters of the text that splitters see.
SPLITTER_CHARS = 32
#: Sorted runs that one text can be spread over.
SALTS = 64


def _place(text: Column, row_id: Column, salts: int) -> list[Column]:
    return [
        F.substring(text, 1, SPLITTER_CHARS).alias("_lead"),
        F.xxhash64(text).alias("_hash"),
        # Never null, or a filter for it would part the two uses of one exchange.
        F.coalesce(F.pmod(F.xxhash64(row_id), F.lit(salts)), F.lit(0)).cast("int").alias("_salt"),
    ]


def _order(column: Column, keep: str) -> Column:
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is 'smallest' or 'largest'")
    return column.asc_nulls_last() if keep == "smallest" else column.desc_nulls_last()


def copy_groups(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", keep: str = "smallest", salts: int = SALTS
) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal if identical after lower-casing A-Z; null counts as empty,
    so null and empty texts are one group. Of equal texts the row with the
    smallest (or largest) id stays. A null id stays only where all ids of its
    group are null. Of rows that repeat id and text exactly one stays. Other
    columns are ignored; an empty table gives no rows.
    """
    row_id = F.col(f"`{id_column}`")
    rows = docs.select(row_id.alias("doc_id"), ascii_lower(F.col(f"`{text_column}`")).alias("_norm"))
    run = W.partitionBy("_lead", "_hash", "_salt", "_norm").orderBy(_order(F.col("doc_id"), keep))
    runs = (
        rows.select("doc_id", "_norm", *_place(F.col("_norm"), F.col("doc_id"), salts))
        .repartitionByRange("_lead", "_hash", "_salt")
        .select(
            "*",
            F.first("doc_id").over(run).alias("_first"),
            F.row_number().over(run).alias("_place"),
            F.count(F.lit(1)).over(run.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)).alias("_rows"),
        )
    )
    same = W.partitionBy("_lead", "_hash", "_norm")
    best = F.min("_first") if keep == "smallest" else F.max("_first")
    groups = (
        runs.where(F.col("_place") == 1)
        .select("_lead", "_hash", "_norm", "_salt", "_first", "_rows")
        .repartitionByRange("_lead", "_hash")
        .select(
            F.col("_hash").alias("_h"),
            F.col("_salt").alias("_s"),
            F.col("_first").alias("_f"),
            best.over(same).alias("keep_id"),
            F.sum("_rows").over(same).alias("group_size"),
            # Where all ids are null, the run of the first salt has the row that stays.
            F.min(F.when(F.col("_first").isNull(), F.col("_salt"))).over(same).alias("_null_salt"),
        )
    )
    members = runs.select("doc_id", "_hash", "_salt", "_first", "_place", F.sha2("_norm", 256).alias("text_sha256"))
    joined = members.join(
        groups,
        (F.col("_hash") == F.col("_h")) & (F.col("_salt") == F.col("_s")) & F.col("_first").eqNullSafe(F.col("_f")),
    )
    winner = F.col("_first").eqNullSafe(F.col("keep_id")) & (
        F.col("keep_id").isNotNull() | (F.col("_salt") == F.col("_null_salt"))
    )
    return joined.select(
        "doc_id", "keep_id", "group_size", ((F.col("_place") == 1) & winner).alias("kept"), "text_sha256"
    )


def drop_copies(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", keep: str = "smallest", salts: int = SALTS
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; cases as in ``copy_groups``.

    Heads of the first sort go through the second with their whole rows, so
    the decision needs no join back to the texts.
    """
    text = ascii_lower(F.col(f"`{text_column}`"))
    row_id = F.col("_row").getField(id_column)
    norm = ascii_lower(F.col("_row").getField(text_column))
    rows = packed(docs, *_place(text, F.col(f"`{id_column}`"), salts))
    for keys in (["_lead", "_hash", "_salt"], ["_lead", "_hash"]):
        run = W.partitionBy(*keys, "_norm").orderBy(_order(F.col("_id"), keep), F.col("_salt"))
        rows = (
            rows.repartitionByRange(*keys)
            .select("*", norm.alias("_norm"), row_id.alias("_id"))
            .select("*", F.row_number().over(run).alias("_place"))
            .where(F.col("_place") == 1)
            .select("_row", "_lead", "_hash", "_salt")
        )
    return unpacked(rows)
