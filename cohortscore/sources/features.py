"""Feature lists: ordered names that form the contract between steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortscore.functions.numeric import quoted

# Headers a feature list may carry, in order of preference.
LIST_HEADERS = ["selected_features", "feature", "features"]


def list_column(df: DataFrame) -> str:
    for name in LIST_HEADERS:
        if name in df.columns:
            return name
    if len(df.columns) == 1:
        return df.columns[0]
    raise ValueError(f"no feature list among columns {df.columns}")


def feature_list(df: DataFrame) -> DataFrame:
    """(feature) from a table with a known header or a lone column."""
    return df.select(quoted(list_column(df)).cast("string").alias("feature")).dropna()


def headerless_list(lines: DataFrame) -> DataFrame:
    """(pos, feature) from (pos, line): first CSV field, blanks dropped.

    A header word in the very first line is dropped too.
    """
    text = F.trim(F.get(F.split("line", ","), F.lit(0)))
    first = lines.agg(F.min("pos").alias("p")).scalar()
    is_header = (F.col("pos") == first) & F.lower("feature").isin(LIST_HEADERS)
    named = lines.select("pos", text.alias("feature"))
    return named.where(F.coalesce(F.col("feature") != "", F.lit(False)) & ~is_header)


def text_list(lines: DataFrame) -> DataFrame:
    """(pos, feature) from (pos, line): one trimmed name per line, blanks dropped."""
    return lines.select("pos", F.trim("line").alias("feature")).where(F.col("feature") != "")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(pos, line) of a small text file, in file order."""
    return spark.read.text(path).select(F.monotonically_increasing_id().alias("pos"), F.col("value").alias("line"))


def read_list(spark: SparkSession, path: str) -> DataFrame:
    """A list file: CSV by its first field, other files line by line."""
    lines = read_lines(spark, path)
    return headerless_list(lines) if path.lower().endswith(".csv") else text_list(lines)


def names_of(features: DataFrame, order: str = "pos") -> list[str]:
    """The list on the driver: one short name per model column."""
    return [r["feature"] for r in features.orderBy(order).select("feature").collect()]


def resolve_list(candidates: DataFrame) -> DataFrame:
    """(source, pos, feature) of the first source that has any feature.

    ``candidates``: (priority, source, pos, feature), one row per name.
    """
    usable = candidates.where(F.trim("feature") != "")
    best = usable.agg(F.min("priority").alias("p")).scalar()
    return usable.where(F.col("priority") == best).select("source", "pos", F.trim("feature").alias("feature"))


def follow_pointers(pointers: DataFrame, lists: DataFrame) -> DataFrame:
    """Candidates reached through files that name another file.

    ``pointers``: (priority, source, target); ``lists``: (path, pos, feature).
    """
    return pointers.join(lists, F.trim("target") == F.col("path")).select(
        "priority", "source", "pos", "feature"
    )


def resolve_files(spark: SparkSession, paths: list[str]) -> tuple[list[str], str]:
    """Names and source of the first readable, non-empty list file.

    A path ending in ``.pointer`` holds the path of the list to read.
    """
    for path in paths:
        try:
            target = path
            if path.endswith(".pointer"):
                target = read_lines(spark, path).orderBy("pos").first()["line"].strip()
            names = names_of(read_list(spark, target))
        except Exception as problem:  # an absent candidate is no error
            if "PATH_NOT_FOUND" not in str(problem):
                raise
            continue
        if names:
            return names, path
    raise FileNotFoundError(f"no feature list in any of {paths}")


def write_feature_list(features: DataFrame, path: str, run_id: str, job: str | None = None) -> None:
    """Keep the list of a run; earlier runs stay. ``job`` adds a copy for one job."""
    rows = features.select("pos", "feature")
    rows.withColumns({"run_id": F.lit(run_id), "job": F.lit(job or "")}).write.mode("append").partitionBy(
        "run_id", "job"
    ).parquet(path)


def latest_list(lists: DataFrame) -> DataFrame:
    """(pos, feature) of the newest run in a table with a ``run_id`` column."""
    newest = lists.agg(F.max("run_id").alias("r")).scalar()
    return lists.where(F.col("run_id") == newest)


def membership(names: DataFrame, schema: DataFrame, present: bool) -> DataFrame:
    """Listed features that are (not) in the schema's feature names."""
    return names.join(schema, "feature", "left_semi" if present else "left_anti")


def list_difference(df: DataFrame, a: Column, b: Column, keep: list[str] = ()) -> DataFrame:
    """Names only in list ``a`` and only in list ``b``, per row."""
    return df.select(*keep, F.array_except(a, b).alias("only_a"), F.array_except(b, a).alias("only_b"))
