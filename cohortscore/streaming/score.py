"""Scoring encounters as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cohortscore.operators.models import Scorer


def arriving(spark: SparkSession, folder: str, schema: T.StructType, form: str = "parquet") -> DataFrame:
    return spark.readStream.schema(schema).format(form).load(folder)


def score_stream(stream: DataFrame, scorer: Scorer, out: str = "predicted_proba") -> DataFrame:
    """The batch projection and model, row by row: no state, append mode."""
    return scorer.score(stream, out)


def write_scores(scored: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Score what has arrived, then stop; the checkpoint makes files exactly-once."""
    writer = scored.writeStream.outputMode("append").format("parquet")
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start(folder)
