"""Newest files of a folder by kind."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def list_files(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """(path, modified): file metadata only, contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob)
    return files.load(folder).select("path", F.col("modificationTime").alias("modified"))


def _newest(listing: DataFrame, kind: Column) -> DataFrame:
    tagged = listing.select(F.explode(kind).alias("kind"), "path", "modified")
    return tagged.groupBy("kind").agg(F.max_by("path", F.struct("modified", "path")).alias("path"))


def latest_predictions(listing: DataFrame) -> DataFrame:
    """(kind, path): newest scored file for ``test`` and for ``train``."""
    name = F.lower("path")
    scored = listing.where(name.endswith("_with_predictions.csv"))
    kinds = F.filter(
        F.array(F.lit("test"), F.lit("train")), lambda k: F.contains(F.lower(F.col("path")), k)
    )
    return _newest(scored, kinds)


def latest_reports(listing: DataFrame) -> DataFrame:
    """(kind, path): newest summary table, point-metric table and report page."""
    path = F.col("path")
    hits = {
        "summary": path.endswith(".csv") & path.contains("summary_"),
        "point_metrics": path.endswith(".csv") & path.contains("point_metrics_"),
        "report": path.endswith(".html") & path.contains("report_"),
    }
    kinds = F.array_compact(F.array(*[F.when(hit, F.lit(kind)) for kind, hit in hits.items()]))
    return _newest(listing, kinds)
