"""Raw encounters to a model table of integers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortscore.functions.diagnosis import diagnosis_group
from cohortscore.functions.numeric import clip_upper, quoted
from cohortscore.functions.recode import (
    AGE_BRACKETS, ANY_MEDICATION, DISCHARGE_LABELS, MEDICATION_CHANGED, MEDICATION_USED,
    READMITTED_WITHIN_30, fill_missing, merge_admission_types, recode, recode_int, recode_ordinal, recode_position,
)
from cohortscore.operators.columns import conform_columns, keep_unless
from cohortscore.operators.encode import OneHot, cast_all_int, fit_one_hot
from cohortscore.session import compiled, settle
from cohortscore.sources.tables import COUNT_COLUMNS, DIAGNOSES, MEDICATIONS, encounter_schema

# Columns that become dummies.
DUMMY_COLUMNS = [
    "race", "age", "gender", "discharge_disposition", "max_glu_serum",
    "A1Cresult", "admission_type_id", "admission_source_id",
]
HIGHEST_SOURCE = 8


def clean_encounters(
    raw: DataFrame, keep: Sequence[str] = (), none_as_null: bool = False,
    simultaneous: bool = False, null_as_nothing: bool = False,
) -> DataFrame:
    """Recoded encounters, label first, deaths left out; one projection and one filter.

    ``keep`` names columns (ids) to carry along at the end. ``none_as_null``
    keeps "not taken" tests missing; ``simultaneous`` and ``null_as_nothing``
    choose the variants of the admission type and diagnosis recodes.
    """
    df = conform_columns(raw, encounter_schema())
    col = quoted
    tests = {
        c: F.when(col(c) != "None", col(c)) if none_as_null else fill_missing(col(c), "NotTaken", ["None"])
        for c in ("A1Cresult", "max_glu_serum")
    }
    cleaned = df.select(
        recode_int(col("readmitted"), READMITTED_WITHIN_30).alias("readmitted"),
        *[col(c) for c in COUNT_COLUMNS],
        *[recode_int(col(c), MEDICATION_USED).alias(f"medication_{c}") for c in MEDICATIONS],
        recode_int(col("change"), MEDICATION_CHANGED).alias("change"),
        recode_int(col("diabetesMed"), ANY_MEDICATION).alias("any_medication"),
        *[diagnosis_group(col(c), null_as_nothing=null_as_nothing).alias(c) for c in DIAGNOSES],
        recode_ordinal(col("age"), AGE_BRACKETS).alias("age"),
        merge_admission_types(col("admission_type_id"), simultaneous).alias("admission_type_id"),
        recode_position(col("discharge_disposition_id"), DISCHARGE_LABELS).alias("discharge_disposition"),
        clip_upper(col("admission_source_id"), HIGHEST_SOURCE).alias("admission_source_id"),
        fill_missing(col("race"), "Other").alias("race"),
        recode(col("gender"), {"Unknown/Invalid": "Female"}).alias("gender"),
        tests["A1Cresult"].alias("A1Cresult"),
        tests["max_glu_serum"].alias("max_glu_serum"),
        *[col(c) for c in keep],
    )
    return keep_unless(cleaned, "discharge_disposition", "died")


def fit_encoder(cleaned: DataFrame, separate_diagnoses: bool = False) -> OneHot:
    """Dummies for the eight columns; the diagnoses together, or one by one."""
    if separate_diagnoses:
        return fit_one_hot(cleaned, [*DIAGNOSES, *DUMMY_COLUMNS])
    return fit_one_hot(cleaned, DUMMY_COLUMNS, {"diagnosis": DIAGNOSES})


def engineer(raw: DataFrame, keep: Sequence[str] = (), encoder: OneHot | None = None, **options) -> tuple[DataFrame, OneHot]:
    """(model table, encoder): cleaned, encoded, every feature an int.

    With a given ``encoder`` its categories apply; new ones are 0 everywhere.
    The cleaned rows are stored once for both the encoder and its use.
    """
    with compiled(raw.sparkSession):
        cleaned = settle(clean_encounters(raw, keep, **options))
    encoder = encoder or fit_encoder(cleaned)
    return cast_all_int(encoder.transform(cleaned), keep), encoder
