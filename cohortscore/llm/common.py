"""Expressions and helpers that several operators of the subpackage share."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A word is a run of characters other than space and the five ASCII controls 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"


def ascii_lower(text: Column) -> Column:
    """A-Z become a-z, every other character stays; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def word_count(text: Column) -> Column:
    """Words of a text as a long; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def packed(df: DataFrame, *columns: Column) -> DataFrame:
    """All columns of ``df`` in one struct ``_row`` beside ``columns``, so that no name can clash."""
    return df.select(F.struct(*[df[f"`{c}`"] for c in df.columns]).alias("_row"), *columns)


def unpacked(df: DataFrame) -> DataFrame:
    """The columns that ``packed`` put away."""
    return df.select("_row.*")
