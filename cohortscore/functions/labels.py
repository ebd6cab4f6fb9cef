"""Outcome labels: text and numbers to 0/1."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortscore.functions.numeric import quoted, text_to_double, to_double

# Spellings of the two classes.
NEGATIVE_WORDS = ["NO", "No", "no", "0", "FALSE", "False", "false"]
POSITIVE_WORDS = ["YES", "Yes", "yes", "1", "TRUE", "True", "true", "<30", ">30"]


def _word(text: Column) -> Column:
    return F.when(text.isin(NEGATIVE_WORDS), F.lit(0.0)).when(text.isin(POSITIVE_WORDS), F.lit(1.0))


def normalize_label(df: DataFrame, name: str) -> Column:
    """Words to 0/1 (others NULL); numeric columns keep their number."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return _word(quoted(name))
    return to_double(df, name)


def coerce_label(df: DataFrame, name: str) -> Column:
    """Like ``normalize_label``, but other text is read as a number if it is one."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.coalesce(_word(quoted(name)), text_to_double(quoted(name)))
    return to_double(df, name)


def binary_label(df: DataFrame, name: str) -> Column:
    """0/1 int: normalised label cut at one half, NULL kept."""
    value = normalize_label(df, name)
    return F.when(value.isNotNull(), (value >= 0.5).cast("int"))


def violation_columns(label: Column) -> list[Column]:
    """Aggregates: rows without a label, and rows whose label is neither 0 nor 1."""
    y = label.cast("double")
    return [
        F.count_if(y.isNull()).alias("missing"),
        F.count_if(y.isNotNull() & ~y.isin(0.0, 1.0)).alias("not_binary"),
    ]


def label_violations(df: DataFrame, label: Column) -> DataFrame:
    """One row with both counts."""
    return df.agg(*violation_columns(label))


def refuse_incomplete(counts, name: str) -> None:
    if counts["missing"] or counts["not_binary"]:
        raise ValueError(
            f"label {name!r}: {counts['missing']} missing, {counts['not_binary']} non-binary values"
        )


def strict_label(df: DataFrame, name: str, out: str = "label") -> DataFrame:
    """Add the 0/1 label; rows without one are dropped, other values refused."""
    y = normalize_label(df, name)
    bad = label_violations(df, y).first()
    if bad["not_binary"]:
        raise ValueError(f"{bad['not_binary']} rows of {name!r} are neither 0 nor 1")
    return df.withColumn(out, y.cast("int")).where(F.col(out).isNotNull())


def complete_label(df: DataFrame, name: str, out: str = "label") -> DataFrame:
    """Add the lenient label; fail if any row is left without a binary one."""
    y = coerce_label(df, name)
    refuse_incomplete(label_violations(df, y).first(), name)
    return df.withColumn(out, y.cast("int"))
