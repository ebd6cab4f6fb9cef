"""Mixing sources to target weights.

Every source gets a budget of words. Its documents are put in a random but
repeatable order by hash keys, range-sorted within the source, and distributed
prefix sums of sizes tell where the budget ends. A budget above the source's
size repeats the source in whole epochs first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortscore.llm.common import WORD, packed, word_count
from cohortscore.session import settle

#: Leading hex digits of the key that make a cell; a source has 16 to this power cells.
CELL_DIGITS = 3
#: Most epochs that a source may be repeated.
MAX_EPOCHS = 3
#: Sources up to which their cuts, some 100 bytes each, are broadcast; salts of a source beyond that.
BROADCAST_SOURCES, SALTS = 100_000, 64
#: Weights of the sources in order, repeating.
WEIGHTS = (1, 2, 3)


def _keyed(docs: DataFrame, id_column: str, text_column: str, source_column: str, seed: str) -> DataFrame:
    row_id = F.col(f"`{id_column}`")
    return docs.select(
        row_id.alias("doc_id"),
        F.col(f"`{source_column}`").alias("source"),
        word_count(F.col(f"`{text_column}`")).alias("size"),
        _key(row_id, seed).alias("key"),
    )


def _key(row_id, seed: str):
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(row_id.cast("string"), F.lit(""))))


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """source, source_size, target, budget from rows of (source, size).

    Sources in code point order, null last, take the weights in turn and share
    the total size. A target stops at ``max_epochs`` times its source; the
    excess goes to the others by weight until none is above. That is one level
    per unit of weight, min(cap, level x weight), and the level follows from
    running sums over the sources ordered by cap per weight. One row per
    source: windows and broadcasts here never see documents.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    turn = F.row_number().over(W.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(turn, F.lit(len(weights))) + 1)
    ranked = by_source.select("source", "source_size", weight.alias("w")).select(
        "*",
        (F.lit(max_epochs) * F.col("source_size")).alias("cap"),
        (F.lit(max_epochs) * F.col("source_size") / F.col("w")).alias("ratio"),
    )
    whole = W.partitionBy(F.lit(0))
    before = whole.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(W.unboundedPreceding, -1)
    levels = ranked.select(
        "*",
        F.sum("source_size").over(whole).alias("total"),
        F.sum("w").over(whole).alias("all_w"),
        F.coalesce(F.sum("cap").over(before), F.lit(0)).alias("caps_before"),
        F.coalesce(F.sum("w").over(before), F.lit(0.0)).alias("w_before"),
    ).select("*", ((F.col("total") - F.col("caps_before")) / (F.col("all_w") - F.col("w_before"))).alias("level"))
    # The first source whose cap is not reached sets the level of itself and all after it.
    level = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "source", "level"))).over(whole)
    return levels.select("source", "source_size", "w", "cap", "ratio", level["level"].alias("at")).select(
        "source",
        "source_size",
        F.least(F.col("cap").cast("double"), F.coalesce(F.col("at") * F.col("w"), F.lit(0.0))).alias("target"),
    ).select("*", F.floor("target").cast("long").alias("budget"))


def source_cuts(keyed: DataFrame, targets: DataFrame, cell_digits: int = CELL_DIGITS) -> DataFrame:
    """Per source where its budget ends: epochs, cut_key, cut_words, cut_size.

    Rows are range-sorted by source and cell of the key. Cell totals, summed
    up within the source, start each cell's own running sums, so no task holds
    a source. Rows that share a key (repeated ids) form one step.
    """
    at = F.substring("key", 1, cell_digits).alias("cell")
    steps = (
        keyed.select("source", "key", at, "size")
        .repartitionByRange("source", "cell")
        .groupBy("source", "cell", "key")
        .agg(F.sum("size").alias("step"))
    )
    cell = W.partitionBy("source", "cell")
    running = steps.select("*", F.sum("step").over(cell.orderBy("key")).alias("within"))
    totals = keyed.groupBy("source", at).agg(F.sum("size").alias("cell_size"))
    starts = totals.select(
        F.col("source").alias("s"),
        F.col("cell").alias("c"),
        "cell_size",
        F.coalesce(
            F.sum("cell_size").over(W.partitionBy("source").orderBy("cell").rowsBetween(W.unboundedPreceding, -1)),
            F.lit(0),
        ).alias("start"),
    )
    rest = F.when(F.col("source_size") > 0, F.col("budget") % F.col("source_size")).otherwise(0)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("budget") / F.col("source_size"))).otherwise(0)
    budgets = targets.select(
        F.col("source").alias("t"), "source_size", "target", epochs.cast("long").alias("epochs"), rest.alias("rest")
    )
    # Of each source only the cell that the budget ends in needs its running sums looked at.
    ends = starts.join(budgets, F.col("s").eqNullSafe(F.col("t"))).where(
        (F.col("start") < F.col("rest")) & (F.col("rest") <= F.col("start") + F.col("cell_size"))
    )
    cuts = (
        running.join(ends, F.col("source").eqNullSafe(F.col("s")) & (F.col("cell") == F.col("c")))
        .select("s", "key", "step", (F.col("start") + F.col("within")).alias("upto"), "rest")
        .where((F.col("upto") >= F.col("rest")) & (F.col("upto") - F.col("step") < F.col("rest")))
        .select(
            "s",
            F.col("key").alias("cut_key"),
            (F.col("rest") - F.col("upto") + F.col("step")).alias("cut_words"),
            F.col("step").alias("cut_size"),
        )
    )
    return budgets.join(cuts, F.col("t").eqNullSafe(F.col("s")), "left").select(
        "t", "source_size", "target", "epochs", "cut_key", "cut_words", "cut_size"
    )


def _with_cuts(rows: DataFrame, source, cuts: DataFrame) -> DataFrame:
    """``rows`` with the cut of their source, without moving a large source to one task.

    Cuts are broadcast if there are few sources, which is counted. With more,
    each cut is repeated for every salt and rows are joined by source and salt.
    """
    cuts = settle(cuts)
    if cuts.count() <= BROADCAST_SOURCES:
        return rows.join(F.broadcast(cuts), source.eqNullSafe(F.col("t")))
    salt = F.pmod(F.xxhash64("key"), F.lit(SALTS))
    spread = cuts.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    return rows.join(spread, source.eqNullSafe(F.col("t")) & (salt == F.col("salt")))


def _taken():
    part = (
        F.when(F.col("key") < F.col("cut_key"), F.col("size"))
        .when(
            (F.col("key") == F.col("cut_key")) & (F.col("cut_size") > 0),
            F.expr("(cut_words * size) div cut_size"),
        )
        .otherwise(F.lit(0))
    )
    return (F.col("epochs") * F.col("size") + part).cast("long")


def mix(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    weights: tuple = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    seed: str = "mix",
) -> DataFrame:
    """One row per input row: doc_id, source, size, source_size, target, taken.

    Size counts words, null and empty texts have none. A null source is a
    source of its own, last in order. The document that a budget ends in is
    taken in part; rows that share its id share that part by size. Sources of
    size zero have target zero. An empty table gives no rows. Order and result
    depend on ids, sizes and ``seed`` only, never on the partitioning.
    """
    keyed = settle(_keyed(docs, id_column, text_column, source_column, seed))
    cuts = source_cuts(keyed, source_targets(keyed, weights, max_epochs))
    return _with_cuts(keyed, F.col("source"), cuts).select(
        "doc_id", "source", "size", "source_size", "target", _taken().alias("taken")
    )


def mixed_rows(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    weights: tuple = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    seed: str = "mix",
) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a row for each time a document is taken.

    The last time may be a part, whose text ends after the words taken. Cases
    as in ``mix``.
    """
    keyed = settle(_keyed(docs, id_column, text_column, source_column, seed))
    cuts = source_cuts(keyed, source_targets(keyed, weights, max_epochs))
    row_id, text = F.col(f"`{id_column}`"), F.col(f"`{text_column}`")
    rows = packed(
        docs,
        _key(row_id, seed).alias("key"),
        word_count(text).alias("size"),
        F.col(f"`{source_column}`").alias("_source"),
    )
    taken = _with_cuts(rows, F.col("_source"), cuts).select("_row", "size", _taken().alias("taken"))
    # How many words each time: the size for every whole time, then what is left.
    times = F.transform(
        F.sequence(F.lit(0), (F.ceil(F.col("taken") / F.col("size")) - 1).cast("int")),
        lambda k: F.least(F.col("size"), F.col("taken") - k * F.col("size")),
    )
    each = taken.where(F.col("taken") > 0).select("_row", "size", F.explode(times).alias("words"))
    whole = F.col("_row").getField(text_column)
    part = F.array_join(F.slice(F.regexp_extract_all(whole, F.lit(rf"[\x20\x09-\x0D]*{WORD}"), F.lit(0)), 1, F.col("words")), "")
    kept_text = F.when(F.col("words") < F.col("size"), part).otherwise(whole)
    return each.select(
        *[
            (kept_text if c == text_column else F.col("_row").getField(c)).alias(c)
            for c in docs.columns
        ]
    )
