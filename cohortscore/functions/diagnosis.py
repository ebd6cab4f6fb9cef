"""Diagnosis codes to chapter labels, without UDF and without join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortscore.functions.numeric import is_number, text_to_double

# Half-open code ranges in priority order, the first match wins.
CHAPTER_RANGES = [
    (340, 459, "circulatory"), (785, 786, "circulatory"),
    (745, 748, "circulatory"), (459, 460, "circulatory"),
    (460, 520, "respiratory"), (786, 787, "respiratory"), (748, 749, "respiratory"),
    (520, 580, "digestive"), (787, 788, "digestive"), (749, 752, "digestive"),
    (800, 1000, "injury"),
    (710, 740, "musculoskeletal"), (754, 757, "musculoskeletal"),
    (580, 630, "urogenital"), (788, 789, "urogenital"), (752, 754, "urogenital"),
    (140, 240, "neoplasm"), (1, 140, "infection"),
    (290, 320, "mentaldis"), (280, 290, "blooddis"),
    (320, 360, "nervous"), (360, 390, "nervous"), (740, 743, "nervous"),
    (630, 680, "pregnancy"),
    (780, 782, "other"), (784, 785, "other"), (790, 800, "other"),
    (743, 745, "other"), (757, 760, "other"),
    (240, 250, "metabolic"), (251, 280, "metabolic"),
    (680, 710, "skin"), (782, 783, "skin"),
    (789, 790, "other"), (783, 784, "metabolic"),
]
EXTERNAL_CAUSE = r"^[VE][0-9]+"
EXTERNAL_CAUSE_ANYWHERE = r"[VE][0-9]+"
UNGROUPED = "Nothing"


def _chapter_table() -> Column:
    slots = [""] * max(high for _, high, _ in CHAPTER_RANGES)
    for low, high, label in reversed(CHAPTER_RANGES):
        slots[low:high] = [label] * (high - low)
    return F.split(F.lit(",".join(slots)), ",")  # folded to one array literal


def chapter_of(code: Column) -> Column:
    """Chapter label of a numeric code (decimals cut off), NULL if none."""
    whole = text_to_double(code).try_cast("int")
    return F.nullif(F.get(_chapter_table(), whole), F.lit(""))


def external_cause_to_injury(code: Column, anywhere: bool = False) -> Column:
    """Replace the V/E part of a code; what follows it is kept."""
    return F.regexp_replace(code, EXTERNAL_CAUSE_ANYWHERE if anywhere else EXTERNAL_CAUSE, "injury")


def ungrouped_to_nothing(code: Column, null_as_nothing: bool = False) -> Column:
    filled = F.when(is_number(code), F.lit(UNGROUPED)).otherwise(code)
    return F.coalesce(filled, F.lit(UNGROUPED)) if null_as_nothing else filled


def diagnosis_group(code: Column, anywhere: bool = False, null_as_nothing: bool = False) -> Column:
    rest = ungrouped_to_nothing(external_cause_to_injury(code, anywhere), null_as_nothing)
    return F.coalesce(chapter_of(code), rest)


def range_table(spark) -> DataFrame:
    """The ranges as a table (low, high, label, priority), for lookups by join."""
    rows = [(lo, hi, label, i) for i, (lo, hi, label) in enumerate(CHAPTER_RANGES)]
    return spark.createDataFrame(rows, "low int, high int, label string, priority int")
