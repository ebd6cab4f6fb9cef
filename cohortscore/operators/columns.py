"""Column sets: conforming, dropping, renaming and aligning to a serving schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortscore.functions.numeric import finite_or_zero, quoted, to_double
from cohortscore.operators.keys import SMALL_ROWS, lookup_join
from cohortscore.session import settle

# Columns a serving frame never scores.
NOT_FEATURES = ["label", "y", "id", "patient_id"]
ID_COLUMNS = {"encounter_id", "patient_nbr", "id"}


def missing_columns(df: DataFrame, names: Sequence[str]) -> list[str]:
    return [c for c in names if c not in df.columns]


def require_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    missing = missing_columns(df, names)
    if missing:
        raise KeyError(f"{len(missing)} columns missing, first: {missing[:10]}")
    return df


def conform_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of ``schema``, in order; absent ones are NULL."""
    present = set(df.columns)
    return df.select(
        *[
            (quoted(f.name).cast(f.dataType) if f.name in present else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    dropped = set(names)
    return df.select(*[quoted(c) for c in df.columns if c not in dropped])


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def move_to_front(df: DataFrame, name: str) -> DataFrame:
    require_columns(df, [name])
    return df.select(quoted(name), *[quoted(c) for c in df.columns if c != name])


def keep_unless(df: DataFrame, name: str, value) -> DataFrame:
    """Rows where ``name`` is not ``value``; NULL rows are kept."""
    return df.where(~quoted(name).eqNullSafe(F.lit(value)))


def complete_rows(df: DataFrame, names: Sequence[str]) -> DataFrame:
    require_columns(df, names)
    return df.dropna("any", subset=[f"`{c}`" for c in names])


def select_ranked(df: DataFrame, ranked: Sequence[str]) -> DataFrame:
    require_columns(df, ranked)
    return df.select(*[quoted(c) for c in ranked])


def numeric_columns(df: DataFrame, without: Sequence[str] = ()) -> list[str]:
    kinds = (T.NumericType, T.BooleanType)
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, kinds) and f.name not in without]
    if not names:
        raise ValueError("no numeric columns")
    return names


def select_numeric(df: DataFrame, label: str | None = None) -> DataFrame:
    names = numeric_columns(df, [label] if label else [])
    keep = ([label] if label else []) + names
    return df.select(*[quoted(c) for c in keep])


def apply_selected_features(df: DataFrame, selected: Sequence[str], label: str) -> DataFrame:
    """Selected features in list order, absent ones as 0.0, then the label if present."""
    present = set(df.columns)
    features = [quoted(c) if c in present else F.lit(0.0).alias(c) for c in selected]
    return df.select(*features, *([quoted(label)] if label in present else []))


def align_to_schema(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Features in list order as doubles, absent ones 0.0; ``keep`` columns lead."""
    present = set(df.columns)
    aligned = [
        quoted(c).cast("double").alias(c) if c in present else F.lit(0.0).alias(c) for c in features
    ]
    return df.select(*[quoted(c) for c in keep], *aligned)


def _served(df: DataFrame, feature: str, label: str) -> Column | None:
    hidden = {label, *NOT_FEATURES}
    return to_double(df, feature) if feature in df.columns and feature not in hidden else None


def prepare_frame(
    df: DataFrame, features: Sequence[str], label: str = "readmitted", keep: Sequence[str] = ()
) -> DataFrame:
    """Serving input: list order, single precision, anything not finite as 0.0."""
    out = []
    for c in features:
        value = _served(df, c, label)
        clean = F.lit(0.0) if value is None else F.coalesce(finite_or_zero(value), F.lit(0.0))
        out.append(clean.cast("float").alias(c))
    return df.select(*[quoted(c) for c in keep], *out)


def non_finite_count(df: DataFrame, features: Sequence[str], label: str = "readmitted") -> DataFrame:
    """One row: how many feature values ``prepare_frame`` has to replace."""
    total = F.lit(0).cast("bigint")
    for c in features:
        value = _served(df, c, label)
        if value is not None:
            good = F.coalesce(F.abs(value) < float("inf"), F.lit(False))
            total = total + F.count_if(~good)
    return df.agg(total.alias("non_finite"))


def schema_diff(df: DataFrame, features: Sequence[str]) -> dict[str, list[str]]:
    """Missing and extra columns, and both ends of the expected order."""
    have, want = set(df.columns), set(features)
    return {
        "missing": [c for c in features if c not in have],
        "extra": [c for c in df.columns if c not in want],
        "head": list(features[:5]),
        "tail": list(features[-5:]),
    }


def id_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.lower() in ID_COLUMNS]


def attach_scores(df: DataFrame, scores: DataFrame, key: str) -> DataFrame:
    """Scores that arrive as a table, back to their rows; NULL where none came."""
    return df.join(scores, key, "left")


def lookup(df: DataFrame, codes: DataFrame, key: str) -> DataFrame:
    """Labels of a code table beside each row; unknown codes give NULL.

    Spark broadcasts the code table by its own size check.
    """
    return df.join(codes, key, "left")


#: Added to codes and bounds, so that they are not negative; they lie within it at either side of 0.
_CODE_BIAS = 1 << 62


def dyadic_blocks(low: Column, high: Column) -> Column:
    """The half-open range [low, high) of non-negative longs as (level, block): block numbers of size 2^level.

    Each level adds one block at either side at most, so a range of width w
    has no more than 2 log2(w) + 2 blocks.
    """
    state = F.struct(low.alias("low"), high.alias("high"), F.array().cast("array<struct<level:int,block:bigint>>").alias("blocks"))

    def step(s: Column, level: Column) -> Column:
        open_ = s["low"] < s["high"]
        odd_low, odd_high = open_ & (s["low"] % 2 == 1), open_ & (s["high"] % 2 == 1)
        up = F.when(odd_low, s["low"] + 1).otherwise(s["low"])
        down = F.when(odd_high, s["high"] - 1).otherwise(s["high"])
        at_low = F.struct(level.alias("level"), s["low"].alias("block"))
        at_high = F.struct(level.alias("level"), down.alias("block"))
        none = F.array().cast("array<struct<level:int,block:bigint>>")
        added = F.concat(
            s["blocks"], F.when(odd_low, F.array(at_low)).otherwise(none), F.when(odd_high, F.array(at_high)).otherwise(none)
        )
        return F.struct(F.shiftright(up, 1).alias("low"), F.shiftright(down, 1).alias("high"), added.alias("blocks"))

    # Where low has reached high nothing is added any more.
    return F.aggregate(F.sequence(F.lit(0), F.lit(63)), state, step)["blocks"]


def range_lookup(
    df: DataFrame, code: Column, ranges: DataFrame, out: str = "label", small_rows: int = SMALL_ROWS
) -> DataFrame:
    """First matching range (low, high, label, priority) of an integer code, however wide the ranges are.

    The half-open ranges fall into blocks of powers of two and each distinct
    code asks for the blocks around it, at the levels that ranges have, so the
    lookup is an equi-join. Of the ranges that hold a code the lowest priority
    wins, of equals the least label. Ranges whose high is not above their low
    hold nothing. Codes that are missing or no integers have no label and are
    not shuffled. Codes and bounds lie within 2^62 of 0. Frequent codes never meet in one task: distinct codes
    are looked up, and the answers joined back with the frequent ones broadcast.
    """
    low, high = (F.col(c).cast("long") + _CODE_BIAS for c in ("low", "high"))
    rows = df.withColumn("__code", code.try_cast("long") + _CODE_BIAS)
    codes = settle(rows.where(F.col("__code").isNotNull()).select("__code").distinct())
    asked_for = codes.agg(F.min("__code").alias("least"), F.max("__code").alias("most")).first()
    least = F.lit(asked_for["least"]).cast("long")
    behind = F.lit(min((asked_for["most"] or 0) + 1, 2 * _CODE_BIAS - 1)).cast("long")
    # Of ranges that reach beyond all codes only the part between them is cut into blocks; without codes that is none.
    within = ranges.select(F.greatest(low, least).alias("low"), F.least(high, behind).alias("high"), "label", "priority", (high > low).alias("__holds"))
    low, high = F.col("low"), F.col("high")
    blocks = settle(
        within.where(F.col("__holds") & (high > low) & least.isNotNull()).select(F.explode(dyadic_blocks(low, high)).alias("b"), "label", "priority").groupBy(
            "b.level", "b.block"
        ).agg(F.min(F.struct("priority", "label")).alias("r"))
    )
    levels = [r["level"] for r in blocks.select("level").distinct().orderBy("level").collect()]  # 63 at most
    asked = codes.select("__code", F.explode(F.array(*[F.lit(level) for level in levels]).cast("array<int>")).alias("level"))
    asked = asked.withColumn("block", F.expr("shiftright(__code, level)"))
    answers = settle(asked.join(blocks, ["level", "block"]).groupBy("__code").agg(F.min("r")["label"].alias(out)))
    return lookup_join(rows, answers, ["__code"], small_rows).drop("__code")


def by_tag(df: DataFrame, tag: str, value: str) -> DataFrame:
    """Rows of one split, without the tag column."""
    return df.where(quoted(tag) == value).drop(tag)
