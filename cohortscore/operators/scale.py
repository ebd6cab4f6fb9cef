"""Scaling and imputation, fitted on the training rows."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortscore.functions.numeric import quoted, to_double
from cohortscore.session import compiled


@dataclass
class Scaler:
    """(x - shift) / scale per feature; a constant feature becomes 0."""

    kind: str
    features: list[str]
    shift: list[float]
    scale: list[float]

    def transform(self, df: DataFrame) -> DataFrame:
        if self.kind == "none":
            return df
        out = {}
        for c, shift, scale in zip(self.features, self.shift, self.scale):
            out[c] = (to_double(df, c) - shift) / (scale or 1.0)
        return df.withColumns(out)

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> Scaler:
        return Scaler(**json.loads(text))


def scaler_kind(kind: str | None, standardize: bool | None = None) -> str:
    """The scaler asked for; the older on/off switch wins where it is given."""
    if standardize is not None:
        return "standard" if standardize else "none"
    return (kind or "none").lower()


def fit_scaler(train: DataFrame, features: Sequence[str], kind: str | None = "standard") -> Scaler:
    """Standard (population deviation), min-max or none; one aggregate."""
    kind = scaler_kind(kind)
    features = list(features)
    if kind == "none":
        return Scaler(kind, features, [0.0] * len(features), [1.0] * len(features))
    pairs = {"standard": (F.avg, F.stddev_pop), "minmax": (F.min, F.max)}
    if kind not in pairs:
        raise ValueError(f"unknown scaler {kind!r}")
    first, second = pairs[kind]
    row = train.agg(
        *[first(to_double(train, c)).alias(f"a{i}") for i, c in enumerate(features)],
        *[second(to_double(train, c)).alias(f"b{i}") for i, c in enumerate(features)],
    ).first()
    shift = [float(row[f"a{i}"] or 0.0) for i in range(len(features))]
    other = [float(row[f"b{i}"] or 0.0) for i in range(len(features))]
    scale = other if kind == "standard" else [b - a for a, b in zip(shift, other)]
    return Scaler(kind, features, shift, scale)


@dataclass
class MeanFill:
    columns: list[str]
    means: list[float]

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns(
            {c: F.coalesce(to_double(df, c), F.lit(m)) for c, m in zip(self.columns, self.means)}
        )


def fit_mean_fill(train: DataFrame, columns: Sequence[str]) -> MeanFill:
    """Column means without the missing values; 0 where all are missing.

    Each task adds up its rows batch by batch and sends a sum and a count per column.
    """
    columns = list(columns)
    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    narrow = train.select(
        *[(quoted(c) if isinstance(train.schema[c].dataType, whole) else to_double(train, c)).alias(f"x{i}") for i, c in enumerate(columns)]
    )
    width = len(columns)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, present = np.zeros(width), np.zeros(width)
        for batch in batches:
            known = [c.drop_null().to_numpy(zero_copy_only=False) for c in batch.columns]
            total += [v.sum(dtype=float) for v in known]
            present += [len(v) for v in known]
        yield pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()) for v in (total, present)], names=["total", "present"])

    total, present = np.zeros(width), np.zeros(width)
    with compiled(train.sparkSession):
        for row in narrow.mapInArrow(task, "total binary, present binary").collect():  # a row per task
            total, present = total + np.frombuffer(row["total"]), present + np.frombuffer(row["present"])
    return MeanFill(columns, np.divide(total, present, out=np.zeros(width), where=present > 0).tolist())


def column_means(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, mean), 0 where all values are missing."""
    parts = [
        F.struct(F.lit(c).alias("column"), F.coalesce(F.avg(to_double(df, c)), F.lit(0.0)).alias("mean"))
        for c in columns
    ]
    return df.agg(F.array(*parts).alias("p")).select(F.explode("p").alias("p")).select("p.*")


