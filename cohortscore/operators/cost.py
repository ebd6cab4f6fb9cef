"""What acting on a prediction costs and saves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortscore.functions.numeric import round_half_even

# Cost per enrolled patient, success rate, cost of a readmission.
PROGRAM_COST, SUCCESS_RATE, READMISSION_COST = 500.0, 0.5, 15000.0


def cost_columns(
    counts: DataFrame,
    patients: Column | None = None,
    savings_denominator: Column | None = None,
    program_cost: float = PROGRAM_COST,
    success_rate: float = SUCCESS_RATE,
    readmission_cost: float = READMISSION_COST,
) -> DataFrame:
    """Add the seven cost columns to confusion counts.

    ``patients`` defaults to the row's own number of cases. Per-patient savings
    are divided by ``savings_denominator`` where given, else by the patients.
    """
    n = patients if patients is not None else F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn")
    n = F.nullif(n.cast("double"), F.lit(0.0))
    other = F.nullif(savings_denominator.cast("double"), F.lit(0.0)) if savings_denominator is not None else n
    total = (F.col("tp") + F.col("fp")).cast("double") * program_cost
    prevented = round_half_even(success_rate * F.col("tp").cast("double"))
    saved = round_half_even(prevented * readmission_cost, 2)
    net = saved - total
    # The names of the columns, as readers of the tables know them.
    return counts.withColumns(
        {
            "total_cost_of_implimenting_program": total,
            "per_patient_outlay": round_half_even(total / n, 2),
            "readmissions_prevented": prevented,
            "savings_from_readmissions_prevention": saved,
            "per_patient_savings_from_readmissions_prevention": round_half_even(saved / other, 2),
            "net_savings_to_hosptial_system": net,
            "net_per_patient_savings": round_half_even(net / n, 2),
        }
    )


def baselines(totals: DataFrame) -> DataFrame:
    """Everyone flagged and no-one flagged, from one row of class totals (pos, neg)."""
    zero = F.lit(0).cast("bigint")

    def case(name, tp, fp, fn, tn):
        parts = {"tn": tn, "fp": fp, "fn": fn, "tp": tp}
        return F.struct(F.lit(name).alias("model"), *[v.alias(k) for k, v in parts.items()])

    pos, neg = F.col("pos"), F.col("neg")
    cases = F.array(
        case("all_prediction", pos, neg, zero, zero), case("no_prediction", zero, zero, pos, neg)
    )
    return totals.select(F.explode(cases).alias("c")).select("c.*")


def top_tables(table: DataFrame, k: int = 10) -> dict[str, DataFrame]:
    """Greatest area, greatest savings, and fewest misses then savings."""
    return {
        "greatest_auc": table.orderBy(F.desc_nulls_last("auc_roc"), "feature").limit(k),
        "greatest_savings": table.orderBy(F.desc_nulls_last("net_per_patient_savings"), "feature").limit(k),
        "fewest_misses": table.orderBy("fn", F.desc_nulls_last("net_per_patient_savings"), "feature").limit(k),
    }
