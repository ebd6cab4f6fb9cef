"""Lenient numbers: text that is no number becomes NULL, and so does NaN."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Decimal notation only. Spark's cast would also take Java forms such as "1d".
NUMBER_PATTERN = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"


def quoted(name: str) -> Column:
    """Column by its literal name, dots and brackets included."""
    return F.col(f"`{name}`")


def is_number(text: Column) -> Column:
    return F.coalesce(text.rlike(NUMBER_PATTERN), F.lit(False))


def text_to_double(text: Column) -> Column:
    return F.when(is_number(text), F.trim(text).try_cast("double"))


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def to_double(df: DataFrame, name: str) -> Column:
    """Column ``name`` as a nullable double, whatever its declared type."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        return text_to_double(quoted(name))
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return nan_to_null(quoted(name).cast("double"))
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return quoted(name).cast("double")
    return F.lit(None).cast("double")  # dates, arrays and the like hold no number


def round_half_even(value: Column, digits: int = 0) -> Column:
    scale = float(10**digits)
    return F.rint(value * scale) / scale


def ratio(top: Column, bottom: Column, zero_division: float | None = 0.0) -> Column:
    """``top / bottom`` as double, ``zero_division`` where the bottom is zero."""
    other = F.lit(zero_division).cast("double")
    return F.when(bottom == 0, other).otherwise(
        top.cast("double") / F.nullif(bottom.cast("double"), F.lit(0.0))
    )


def clip_upper(value: Column, upper: int) -> Column:
    """Cap at ``upper``; NULL stays NULL (``least`` would return the cap)."""
    return F.when(value > upper, F.lit(upper)).otherwise(value)


def finite_or_zero(value: Column) -> Column:
    return F.when(F.abs(value) < float("inf"), value).otherwise(0.0)
