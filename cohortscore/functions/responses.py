"""Scores out of raw text: batch responses, JSON and training logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortscore.functions.numeric import quoted, text_to_double

# How a training log states its validation metrics.
LOG_PATTERNS = {
    "auc": r"validation[-:]auc[:=]([0-9\.]+)",
    "aucpr": r"validation[-:]aucpr[:=]([0-9\.]+)",
}


def response_values(raw: Column) -> Column:
    """Array of doubles in a raw response.

    Either JSON with a ``predictions`` list, of numbers or of one-number
    lists, or plain numbers separated by commas and line ends.
    """
    nested = F.from_json(raw, "struct<predictions: array<array<double>>>")["predictions"]
    flat = F.from_json(raw, "struct<predictions: array<double>>")["predictions"]
    pieces = F.filter(
        F.transform(F.split(raw, r"[,\r\n]"), lambda piece: F.trim(piece)), lambda piece: piece != ""
    )
    plain = F.transform(pieces, text_to_double)
    firsts = F.transform(nested, lambda pair: F.get(pair, F.lit(0)))
    has_json = F.get_json_object(raw, "$.predictions").isNotNull()
    is_nested = F.get_json_object(raw, "$.predictions[0][0]").isNotNull()
    return F.when(has_json & is_nested, firsts).when(has_json, flat).otherwise(plain)


def parse_responses(responses: DataFrame) -> DataFrame:
    """(batch_id, n_rows, raw) to (batch_id, pos, score, complete).

    ``complete`` tells whether the response held exactly ``n_rows`` numbers. A
    missing or empty response keeps one row, without position and score.
    """
    values = responses.select("batch_id", "n_rows", response_values(F.col("raw")).alias("values"))
    values = values.withColumn("values", F.coalesce("values", F.array().cast("array<double>")))
    complete = (F.size("values") == F.col("n_rows")) & ~F.exists("values", lambda v: v.isNull())
    return values.select(
        "batch_id",
        F.coalesce(complete, F.lit(False)).alias("complete"),
        F.posexplode_outer("values").alias("pos", "score"),
    )


def require_complete(parsed: DataFrame) -> DataFrame:
    """Fail if any batch came back with the wrong number of scores."""
    broken = parsed.where(~F.col("complete")).select("batch_id").distinct().limit(5).collect()
    if broken:
        raise ValueError(f"responses with a wrong number of scores: {[r[0] for r in broken]}")
    return parsed.where(F.col("pos").isNotNull()).select("batch_id", "pos", "score")


def scores_from_json(df: DataFrame, column: str, keys: list[str]) -> DataFrame:
    """Explode ``predictions[*].score`` of a JSON column."""
    shape = "struct<predictions: array<struct<score: double>>>"
    parsed = F.from_json(quoted(column), shape)["predictions"]
    exploded = df.select(*[quoted(k) for k in keys], F.posexplode(parsed).alias("pos", "item"))
    return exploded.select(*[quoted(k) for k in keys], "pos", F.col("item.score").alias("score"))


def log_metrics(lines: DataFrame, column: str = "line") -> DataFrame:
    """All validation metrics a log states: (metric, value) beside the line's columns."""

    def hits_of(metric: str, pattern: str) -> Column:
        found = F.regexp_extract_all(quoted(column), F.lit(pattern), F.lit(1))
        return F.transform(
            found, lambda text: F.struct(F.lit(metric).alias("metric"), text_to_double(text).alias("value"))
        )

    found = [hits_of(metric, pattern) for metric, pattern in LOG_PATTERNS.items()]
    others = [quoted(c) for c in lines.columns if c != column]
    hits = lines.select(*others, F.explode(F.concat(*found)).alias("hit"))
    return hits.select(*others, "hit.metric", "hit.value")
