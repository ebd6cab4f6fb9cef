"""The registered queries and their checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if check:
            CHECKS[name] = check
        return function

    return add


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """All doubles rounded, so that sums in another order compare equal."""
    return df.select(
        *[
            F.round(F.col(f"`{f.name}`"), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )
