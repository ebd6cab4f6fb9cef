"""Value recodes of the encounter columns, each one expression."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Categories as they appear in the data and the codes they get.
READMITTED_WITHIN_30 = {"NO": 0, ">30": 0, "<30": 1}
MEDICATION_USED = {"No": 0, "Steady": 1, "Down": 1, "Up": 1}
MEDICATION_CHANGED = {"No": 0, "Ch": 1}
ANY_MEDICATION = {"Yes": 1, "No": 0}
AGE_BRACKETS = [
    "[0-10)", "[10-20)", "[20-30)", "[30-40)", "[40-50)",
    "[50-60)", "[60-70)", "[70-80)", "[80-90)", "[90-100)",
]
DISCHARGE_LABELS = [
    "home", "hospital", "nursing", "nursing", "hospice",
    "hhealth", "leftAMA", "hhealth", "hospital", "hospital",
    "died", "hospital", "hospice", "hospice", "hospital",
    "outpatient", "outpatient", "unknown", "died", "died",
    "died", "outpatient", "hospital", "nursing", "unknown",
    "unknown", "nursing", "psych", "hospital", "outpatient",
]


def recode(value: Column, codes: Mapping, keep_others: bool = True) -> Column:
    """Replace the listed values; others stay as they are or become NULL."""
    text = value.cast("string")
    chain = None
    for old, new in codes.items():
        hit = text == str(old)
        chain = F.when(hit, F.lit(new)) if chain is None else chain.when(hit, F.lit(new))
    if not keep_others:
        return chain
    return chain.otherwise(value)


def recode_int(value: Column, codes: Mapping) -> Column:
    """Recode to int; a residue that is no integer becomes NULL."""
    text = value.cast("string")
    return recode(text, {k: str(v) for k, v in codes.items()}).try_cast("int")


def recode_ordinal(value: Column, ordered: Sequence[str]) -> Column:
    """1-based position in ``ordered``; other text is kept if it is an integer."""
    return recode_int(value, {v: i for i, v in enumerate(ordered, start=1)})


def recode_position(code: Column, labels: Sequence[str]) -> Column:
    """``labels[code - 1]``; codes outside the list keep their own text."""
    table = F.split(F.lit(",".join(labels)), ",")
    position = code.try_cast("int")
    return F.coalesce(F.get(table, position - 1), code.cast("string"))


def merge_admission_types(code: Column, simultaneous: bool = False) -> Column:
    """Types 5, 6 and 8 all mean "unknown" and become 5.

    ``simultaneous=True`` maps 8 to 6 and 6 to 5 in one step instead, so that
    an 8 ends as 6.
    """
    last = 6 if simultaneous else 5
    return F.when(code == 8, F.lit(last)).when(code == 6, F.lit(5)).otherwise(code)


def fill_missing(value: Column, default: str, tokens: Sequence[str] = ()) -> Column:
    missing = value.isNull()
    if tokens:
        missing = missing | value.isin(*tokens)
    return F.when(missing, F.lit(default)).otherwise(value)
