"""Feature ranking and selection."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortscore.functions.numeric import quoted

TOP_K = 150
TRAIN_BUDGET = {"aic": lambda n, k: 2.0 * k, "bic": lambda n, k: math.log(n) * k}


def rank_features(gains: DataFrame, gain: str = "gain_cv") -> DataFrame:
    """(feature, gain_cv, cum_importance, position), highest gain first.

    One row per feature, so the order fits a single window.
    """
    order = Window.orderBy(F.desc(gain), "feature")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum(gain).over(Window.partitionBy())
    share = F.sum(gain).over(upto) / F.nullif(total, F.lit(0.0))
    return gains.select(
        "feature",
        F.col(gain).alias("gain_cv"),
        share.alias("cum_importance"),
        F.row_number().over(order).alias("position"),
    )


def select_top(ranking: DataFrame, k: int = TOP_K) -> DataFrame:
    return ranking.where(F.col("position") <= k).select(F.col("feature").alias("selected_features"), "position")


def select_cumulative(ranking: DataFrame, share: float) -> DataFrame:
    """Features while the cumulated importance is at most ``share``."""
    return ranking.where(F.col("cum_importance") <= share).select(
        F.col("feature").alias("selected_features"), "position"
    )


def select_features(ranking: DataFrame, k: int = TOP_K, cumulative: float = 0.0) -> DataFrame:
    return select_cumulative(ranking, cumulative) if cumulative > 0 else select_top(ranking, k)


def keep_share(ranked: DataFrame, by: str, k: int) -> DataFrame:
    """The k best features by ``by``, missing values last."""
    order = Window.orderBy(F.desc_nulls_last(by), "feature")
    return ranked.withColumn("position", F.row_number().over(order)).where(F.col("position") <= k)


def average_importances(per_fold: DataFrame, folds: int = 5) -> DataFrame:
    """(feature, gain_cv): importance summed over the folds, divided by their number."""
    return per_fold.groupBy("feature").agg((F.sum("gain") / folds).alias("gain_cv"))


def largest_p_value(table: DataFrame) -> DataFrame:
    """The feature a backward step removes: largest p-value, name breaks ties."""
    return table.orderBy(F.desc("p_value"), "feature").limit(1)


# ---- least squares from one pass ------------------------------------------


@dataclass
class Moments:
    """Centred cross products of features and outcome; p x p numbers."""

    n: int
    features: list[str]
    cross: np.ndarray  # features and, last, the outcome


def _assembled(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    doubles = df.select(*[quoted(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    return VectorAssembler(inputCols=doubles.columns, outputCol="v", handleInvalid="skip").transform(doubles).select("v")


def _cross_products(df: DataFrame, columns: Sequence[str]) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of complete rows, column means and centred cross products, from one pass.

    Each task multiplies its rows batch by batch, around its own first row, and
    sends p x p numbers; tasks are joined around the common means.
    """
    doubles = df.select(*[quoted(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    width = len(columns)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, start, total, cross = 0, None, np.zeros(width), np.zeros((width, width))
        for batch in batches:
            x = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1)
            x = x[~np.isnan(x).any(axis=1)]
            if not len(x):
                continue
            start = x[0].copy() if start is None else start
            x -= start
            n, total, cross = n + len(x), total + x.sum(axis=0), cross + x.T @ x
        if n:
            mean = total / n
            cross -= n * np.outer(mean, mean)
            values = [pa.array([a.tobytes()], pa.binary()) for a in (start + mean, cross)]
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), *values], names=["n", "mean", "cross"])

    n, mean, cross = 0, np.zeros(width), np.zeros((width, width))
    for row in doubles.mapInArrow(task, "n long, mean binary, cross binary").collect():  # a row per task, all tasks side by side
        own, between = row["n"], np.frombuffer(row["mean"]) - mean
        cross += np.frombuffer(row["cross"]).reshape(width, width) + np.outer(between, between) * (n * own / (n + own))
        n, mean = n + own, mean + between * (own / (n + own))
    return n, mean, cross


def moments(df: DataFrame, features: Sequence[str], label: str) -> Moments:
    """Everything a linear model needs, from one pass over the table."""
    n, _, cross = _cross_products(df, [*features, label])
    return Moments(n, list(features), cross)


def regularised_beta(a: float, b: float, x: float) -> float:
    """The incomplete beta integral I_x(a, b), by its continued fraction."""
    if not 0.0 < x < 1.0:
        return min(max(x, 0.0), 1.0)
    if x > (a + 1) / (a + b + 2):
        return 1.0 - regularised_beta(b, a, 1.0 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    # Of the fraction's terms the one at 2m and the one at 2m + 1 go together.
    upper, lower = 1.0, 1.0 / (1.0 - (a + b) * x / (a + 1))
    value = lower
    for m in range(1, 10_000):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        for term in (even, odd):
            upper, lower = 1.0 + term / upper, 1.0 / (1.0 + term * lower)
            value *= upper * lower
        if abs(1.0 - upper * lower) < 1e-15:
            break
    return front * value


def student_tail(t: float, freedom: float) -> float:
    """The probability that a Student's t value is at least as far from 0 as ``t``."""
    return regularised_beta(freedom / 2, 0.5, freedom / (freedom + t * t)) if freedom > 0 else 1.0


@dataclass
class LinearFit:
    features: list[str]
    rss: float
    t_values: dict[str, float]
    p_values: dict[str, float]
    criterion: float


def fit_least_squares(m: Moments, features: Sequence[str], criterion: str = "aic") -> LinearFit:
    """Least squares with intercept on some of the features.

    Solved from the moments, so a further model costs no pass over the data.
    Collinear features share the minimum-norm solution.
    """
    at = [m.features.index(f) for f in features]
    gram, side, total = m.cross[np.ix_(at, at)], m.cross[at, -1], m.cross[-1, -1]
    inverse = np.linalg.pinv(gram, hermitian=True)
    slopes = inverse @ side
    rss = max(float(total - side @ slopes), 1e-300)
    rank = int(np.linalg.matrix_rank(gram, hermitian=True)) if at else 0
    freedom = m.n - rank - 1
    errors = np.sqrt(np.maximum(np.diag(inverse), 0.0) * rss / freedom)
    t = {f: float(abs(b) / e) if e > 0 else 0.0 for f, b, e in zip(features, slopes, errors)}
    log_likelihood = -m.n / 2 * (math.log(2 * math.pi) + math.log(rss / m.n) + 1)
    score = -2 * log_likelihood + TRAIN_BUDGET[criterion](m.n, rank + 1)
    return LinearFit(list(features), rss, t, {f: student_tail(v, freedom) for f, v in t.items()}, score)


def single_fits(m: Moments) -> list[tuple[str, float, float]]:
    """(feature, absolute t, p-value) of each feature as the only one of a model."""
    fits = [fit_least_squares(m, [f]) for f in m.features]
    return [(f, fit.t_values[f], fit.p_values[f]) for f, fit in zip(m.features, fits)]


def backward_elimination(
    m: Moments, criterion: str = "aic", max_rounds: int = 20, tolerance: float = 1e-4
) -> list[dict]:
    """Drop the least significant feature per round; (round, removed, criterion).

    That is the one with the largest p-value; with equal degrees of freedom,
    and where p-values vanish, the smallest |t|.
    Stops when the criterion moves by less than ``tolerance``.
    """
    kept, steps = list(m.features), []
    for number in range(1, max_rounds + 1):
        before = fit_least_squares(m, kept, criterion)
        weakest = min(kept, key=lambda f: (before.t_values[f], f))
        kept = [f for f in kept if f != weakest]
        if not kept:
            break
        after = fit_least_squares(m, kept, criterion)
        steps.append(
            {"round": number, "removed": weakest, "criterion": after.criterion, "kept": len(kept)}
        )
        if abs(after.criterion - before.criterion) < tolerance:
            break
    return steps


def pca_scores(df: DataFrame, features: Sequence[str], scaled: bool = False) -> list[tuple[str, float]]:
    """(feature, sum of absolute loadings over all components), highest first.

    ``scaled=False`` fits the values as they are; True standardises them first.
    """
    source = df
    if scaled:
        from cohortscore.operators.scale import fit_scaler

        source = fit_scaler(df, features).transform(df)
    vectors = _assembled(source, features)
    loadings = PCA(k=len(features), inputCol="v", outputCol="c").fit(vectors).pc.toArray()
    scores = zip(features, np.abs(loadings).sum(axis=1).tolist())
    return sorted(scores, key=lambda pair: (-pair[1], pair[0]))
