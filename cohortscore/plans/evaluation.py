"""The evaluations of scored tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortscore.functions.labels import binary_label, coerce_label, refuse_incomplete, violation_columns
from cohortscore.functions.numeric import quoted, to_double
from cohortscore.functions.scores import (
    FLAG_FORMAT, cutoff_label, ensemble_mean, filled_scores, flag_name, flag_thresholds, range_columns,
    symmetric_thresholds, to_probability,
)
from cohortscore.operators.columns import require_columns
from cohortscore.operators.cost import baselines, cost_columns, top_tables
from cohortscore.operators.metrics import (
    hard_auc, normalized_confusion, point_metrics, pr_curve, rate_metrics, roc_curve, summarize_points, tally_metrics,
)
from cohortscore.operators.profile import detect_label, histogram, resolve_score
from cohortscore.operators.sweep import flag_tally, sweep_tally, threshold_sweep
from cohortscore.operators.tally import ordered_points, placed, tally
from cohortscore.session import settle

# Cutoffs of the point report and of the cutoff search.
REPORT_THRESHOLDS = [0.2, 0.3, 0.5]
SEARCH_GRID = (0.11, 0.05, 0.0001, 5)


@dataclass
class Evaluation:
    label: str
    xgb: str
    nn: str
    summary: DataFrame
    points: DataFrame
    roc: DataFrame
    pr: DataFrame
    confusion: DataFrame


def evaluate(
    df: DataFrame, label: str | None = None, xgb: str | None = None, nn: str | None = None,
    thresholds: Sequence[float] = REPORT_THRESHOLDS, confusion_at: float = 0.5,
) -> Evaluation:
    """Summary, point metrics, curves and confusion of two scores and their mean.

    Columns not named are detected. The table is read twice: once to check the
    label and the ranges of the scores, once for the tally of the three scores,
    from which everything is derived.
    """
    label = label or detect_label(df)
    xgb, nn = xgb or resolve_score(df, "xgb"), nn or resolve_score(df, "nn")
    if label is None or xgb is None or nn is None:
        raise ValueError(f"columns not found: label={label} xgb={xgb} nn={nn}")
    require_columns(df, [label, xgb, nn])
    base = df.select(quoted(label), quoted(xgb), quoted(nn))
    y, scores = coerce_label(base, label), [xgb, nn]
    facts = base.agg(*violation_columns(y), *range_columns(filled_scores(base, scores))).first()
    refuse_incomplete(facts, label)
    scored = to_probability(base, scores, facts).select(
        y.cast("int").alias("__y"),
        quoted(xgb).alias("xgb"),
        quoted(nn).alias("nn"),
        ensemble_mean(quoted(xgb), quoted(nn)).alias("ensemble_avg"),
    )
    models = ["xgb", "nn", "ensemble_avg"]
    counts = placed(tally(scored, F.col("__y"), models))
    ordered = ordered_points(counts)
    sweep = sweep_tally(counts, models, sorted({*thresholds, confusion_at}))
    points = point_metrics(sweep.where(F.col("threshold").isin(list(thresholds))))
    return Evaluation(
        label, xgb, nn,
        summarize_points(ordered, {m: m for m in models}),
        points.select("threshold", "accuracy", "precision", "recall", "f1", "tn", "fp", "fn", "tp", "model"),
        roc_curve(ordered, drop_collinear=False),
        pr_curve(ordered),
        sweep.where(F.col("threshold") == confusion_at),
    )


def export_metrics(
    df: DataFrame, label: str, scores: Sequence[str], start: float = 0.05, end: float = 0.95, step: float = 0.05,
    strategy: str = "youden", savings_per_table_row: bool = False,
) -> DataFrame:
    """Metrics and costs of every score and of every threshold flag on it.

    The scores are tallied once. A flag is a cut of its score, so its counts
    come from the sweep over that tally, not from the table. Per-patient
    figures divide by all rows of the table, labelled or not;
    ``savings_per_table_row`` divides the savings by the number of metric rows
    there are, which is fewer where a score gives none.
    """
    grid = flag_thresholds(start, end, step)
    y = binary_label(df, label)
    counts = placed(tally(df, y, scores))
    flags = sweep_tally(counts, scores, grid)
    percent = F.round(F.col("threshold") * 100).cast("int")
    name = F.format_string(FLAG_FORMAT, F.col("model"), percent)
    points = ordered_points(counts).unionByName(ordered_points(flag_tally(flags, name), bounded=True))
    patients = df.count()
    table = tally_metrics(points, strategy)
    per_row = F.count(F.lit(1)).over(Window.partitionBy()) if savings_per_table_row else None  # one row per metric
    return cost_columns(table, F.lit(patients), per_row)


@dataclass
class Export:
    metrics: DataFrame
    tops: dict[str, DataFrame]
    confusion: DataFrame
    histograms: DataFrame


def export(df: DataFrame, label: str = "readmitted", xgb: str = "xgb_prob", nn: str = "nn_prob", k: int = 10) -> Export:
    """The export evaluation: metric table, top tables, confusion cells, histograms."""
    base = df.select(
        quoted(label),
        to_double(df, xgb).alias(xgb),
        to_double(df, nn).alias(nn),
        ensemble_mean(to_double(df, xgb), to_double(df, nn)).alias("ensemble_prob"),
    )
    scores = [xgb, nn, "ensemble_prob"]
    metrics = settle(export_metrics(base, label, scores))
    named = [xgb, flag_name(xgb, 0.35), flag_name("ensemble_prob", 0.35)]
    confusion = normalized_confusion(metrics.where(F.col("feature").isin(named)), "all")
    cells = confusion.select("feature", "tn", "fp", "fn", "tp", "tn_share", "fp_share", "fn_share", "tp_share")
    return Export(metrics, top_tables(metrics, k), cells, histogram(base, scores))


# ---- cutoff search ----------------------------------------------------------


def assess_cutoffs(counts: DataFrame) -> DataFrame:
    """The assessment columns of confusion counts (model, threshold, tn, fp, fn, tp)."""
    full = cost_columns(hard_auc(rate_metrics(point_metrics(counts, None))))
    return full.select(
        cutoff_label(F.col("threshold")).alias("Cutoff_Percentage"),
        F.col("roc_auc").alias("ROC_AUC"),
        F.col("net_per_patient_savings").alias("Net_Cost_Savings"),
        F.col("readmissions_prevented").alias("Prevented_Readmissions"),
        F.col("recall").alias("Recall"),
        F.col("precision").alias("Precision"),
        F.col("f1").alias("F1_Score"),
        F.col("accuracy").alias("Accuracy"),
        F.col("pr_auc").alias("PR AUC"),
        F.col("tp").alias("True_Positives"),
        F.col("fp").alias("False_Positives"),
        F.col("fn").alias("False_Negatives"),
        F.col("specificity").alias("Specificity"),
        F.col("per_patient_savings_from_readmissions_prevention").alias("Per-Patient Savings"),
        F.col("per_patient_outlay").alias("Up_front_Expense"),
        F.col("model").alias("Type_of_assessment"),
        "threshold",
    )


def cutoff_table(
    df: DataFrame, label: Column | str, scores: dict[str, str], grid: Sequence[float] | None = None
) -> DataFrame:
    """Every cutoff of every score, and both baselines; ``scores``: column to name.

    The baselines count every labelled row, also those without a score.
    """
    grid = list(grid or symmetric_thresholds(*SEARCH_GRID))
    y = quoted(label) if isinstance(label, str) else label
    swept = threshold_sweep(
        df.select(y.alias("__y"), *[to_double(df, c).alias(m) for c, m in scores.items()]),
        F.col("__y"), list(scores.values()), grid,
    )
    swept = settle(swept)  # models x cutoffs rows
    totals = df.agg(F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg"))
    flat = baselines(totals).withColumn(
        "threshold", F.when(F.col("model") == "all_prediction", F.lit(1.0)).otherwise(F.lit(0.0))
    )
    table = assess_cutoffs(swept.unionByName(flat))
    plain = F.regexp_replace("Cutoff_Percentage", r"\.00%", "%")
    is_flat = F.col("Type_of_assessment").isin("all_prediction", "no_prediction")
    return table.withColumn(
        "Cutoff_Percentage", F.when(is_flat, plain).otherwise(F.col("Cutoff_Percentage"))
    )


def best_rows(table: DataFrame, metric: str, by: str = "Type_of_assessment") -> DataFrame:
    """Rows with the highest metric per type, ties kept (a table of cutoffs)."""
    order = Window.partitionBy(by).orderBy(F.desc_nulls_last(metric))
    return table.withColumn("__rank", F.rank().over(order)).where("__rank = 1").drop("__rank")


def first_best(table: DataFrame, metric: str, by: str = "Type_of_assessment") -> DataFrame:
    """One best row per type: of ties the highest cutoff."""
    order = Window.partitionBy(by).orderBy(F.desc_nulls_last(metric), F.desc("threshold"))
    return table.withColumn("__rank", F.row_number().over(order)).where("__rank = 1").drop("__rank")


def best_cases(table: DataFrame) -> DataFrame:
    """Best cutoffs by area and by savings per model, and both baselines, named."""
    searched = table.where(~F.col("Type_of_assessment").isin("all_prediction", "no_prediction"))
    flat = table.where(F.col("Type_of_assessment").isin("all_prediction", "no_prediction"))
    by_area = best_rows(searched, "ROC_AUC").withColumn("case", F.concat("Type_of_assessment", F.lit("_auc")))
    by_cost = best_rows(searched, "Net_Cost_Savings").withColumn("case", F.concat("Type_of_assessment", F.lit("_cost")))
    return by_area.unionByName(by_cost).unionByName(flat.withColumn("case", F.col("Type_of_assessment")))


def best_saving(df: DataFrame, label: Column | str, scores: Sequence[str], thresholds: Sequence[float], k: int = 10) -> DataFrame:
    """Which score and cutoff saves most per patient? One pass, then a short table."""
    counts = threshold_sweep(df, label, scores, thresholds)
    return (
        cost_columns(point_metrics(counts))
        .orderBy(F.desc("net_per_patient_savings"), "model", "threshold")
        .limit(k)
    )
