"""Evaluation results at rest: metric tables, JSON summaries, artifacts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SUMMARY_ROW = "array<struct<model: string, roc_auc: double, pr_auc: double, brier: double>>"


def run_stamp(spark: SparkSession) -> str:
    """UTC time of the run, as used in file names."""
    return spark.range(1).select(
        F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyyMMdd-HHmmss")
    ).first()[0]


def write_metric_tables(summary: DataFrame, points: DataFrame, folder: str, run_id: str) -> dict[str, str]:
    """Both tables as CSV, one partition per run so that runs add up."""
    out = {}
    for name, table in (("summary", summary), ("point_metrics", points)):
        path = f"{folder.rstrip('/')}/{name}"
        table.withColumn("run_id", F.lit(run_id)).write.mode("append").option("header", True).partitionBy(
            "run_id"
        ).csv(path)
        out[name] = path
    return out


def summary_json(summary: DataFrame, facts: Mapping[str, object]) -> DataFrame:
    """One row of JSON text: the facts of the run and the summary rows.

    The summary has one row per model.
    """
    rows = F.sort_array(F.collect_list(F.struct("model", "roc_auc", "pr_auc", "brier"))).alias("summary")
    named = []
    for key, value in facts.items():
        if isinstance(value, Mapping):
            column = F.struct(*[F.lit(v).alias(k) for k, v in value.items()])
        elif isinstance(value, (list, tuple)):
            column = F.array(*[F.lit(v) for v in value])
        else:
            column = F.lit(value)
        named.append(column.alias(key))
    return summary.agg(rows).select(F.to_json(F.struct(*named, "summary")).alias("value"))


def read_summary_json(spark: SparkSession, path: str) -> DataFrame:
    """(model, roc_auc, pr_auc, brier) of a written summary."""
    parsed = F.from_json("value", f"struct<summary: {SUMMARY_ROW}>")["summary"]
    return spark.read.text(path).select(F.inline(parsed))


def write_json(text: DataFrame, path: str) -> str:
    text.write.mode("overwrite").text(path)
    return path


def write_artifacts(spark: SparkSession, described: str, model, folder: str) -> str:
    """The fitted model and, beside it, its description as JSON."""
    model.write().overwrite().save(f"{folder.rstrip('/')}/model")
    frame = spark.range(1).select(F.lit(described).alias("value"))
    return write_json(frame, f"{folder.rstrip('/')}/artifacts")
