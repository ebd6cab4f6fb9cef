"""Logistic regressions fitted side by side on packed rows.

All fits of a search share their passes: an evaluation is one job over the
rows as ``networks`` packs them, in which each task adds up losses and
gradients of every fit, whose size depends on the fits alone, and the driver
takes the steps. Standardisation is on the weights, so that all fits read the
same matrix. Losses, penalties, first weights and steps (quasi-Newton, and
orthant-wise with an L1 penalty) are those of Spark ML's logistic regression.
"""

from __future__ import annotations

import math
from collections.abc import Generator, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cohortscore.operators.networks import Descent, Packed, chunks, joined_moments, value_moments
from cohortscore.operators.tally import count_values

_MEMORY = 10
#: Values that the objective is compared with.
_WINDOW = 20


@dataclass(frozen=True)
class Logistic:
    """One fit: its settings under Spark ML's names, and the fold that it leaves out."""

    regParam: float = 0.0
    elasticNetParam: float = 0.0
    fitIntercept: bool = True
    maxIter: int = 15
    tol: float = 1e-6
    leaves_out: int | None = None


@dataclass
class Fitted:
    """Weights of the values as they are, and offset."""

    weights: np.ndarray
    offset: float


# ---- steps -----------------------------------------------------------------


class SearchFailed(Exception):
    """No step along a direction is good enough."""


def direction_of(gradient: np.ndarray, pairs: Sequence[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The quasi-Newton direction after ``pairs`` of steps and changes of the gradient, oldest first."""
    found, factors = gradient.copy(), []
    for s, d in reversed(pairs):
        factors.append((s @ found) / (s @ d))
        found = found - factors[-1] * d
    if pairs:
        s, d = pairs[-1]
        if not s @ d >= 0:
            raise SearchFailed
        found = found * ((s @ d) / (d @ d))
    for (s, d), a in zip(pairs, reversed(factors)):
        found = found + (a - (d @ found) / (s @ d)) * s
    return -found


def _between(a: tuple, b: tuple) -> float:
    """The least point of the cubic through two points (step, value, slope), away from both."""
    (t, f, g), (u, h, k) = a, b
    d1 = g + k - 3 * (f - h) / (t - u)
    square = d1 * d1 - g * k
    d2 = math.sqrt(square) if square >= 0 else math.nan
    step = u - (u - t) * (k + d2 - d1) / (k - g + 2 * d2)
    return min(max(step, t + 0.1 * (u - t)), t + 0.9 * (u - t))


Search = Generator[float, tuple[float, float], float]


def wolfe_step(value: float, slope: float, step: float) -> Search:
    """A step that meets both strong conditions of Wolfe; asks for value and slope of steps."""
    if slope > 0:
        raise SearchFailed
    low = (0.0, value, slope)

    def zoom(low: tuple, high: tuple) -> Search:
        for _ in range(10):
            t = _between(high, low) if low[0] > high[0] else _between(low, high)
            at = (t, *(yield t))
            if at[1] > value + 1e-4 * t * slope or at[1] >= low[1]:
                high = at
            else:
                if abs(at[2]) <= 0.9 * abs(slope):
                    return t
                if at[2] * (high[0] - low[0]) >= 0:
                    high = low
                low = at
        raise SearchFailed

    for i in range(10):
        at = (step, *(yield step))
        if not math.isfinite(at[1]):
            step /= 2.0
            continue
        if at[1] > value + 1e-4 * step * slope or (i and at[1] >= low[1]):
            return (yield from zoom(low, at))
        if abs(at[2]) <= 0.9 * abs(slope):
            return step
        if at[2] >= 0:
            return (yield from zoom(at, low))
        low, step = at, step * 1.5
    raise SearchFailed


def backtracked_step(plain: float, value: float, slope: float, step: float, shrink: float) -> Search:
    """A step that meets both strong conditions of Wolfe, or the last of twenty.

    As in Spark ML, the first step is judged by ``plain``, the value before it without penalty.
    """
    found = (plain, (yield step)[1])
    for number in range(20):
        if found[0] > value + step * slope * 1e-4:
            factor = shrink
        elif found[1] < 0.9 * slope:
            factor = 2.1
        elif found[1] > -0.9 * slope:
            factor = shrink
        else:
            break
        if not 1e-10 <= step * factor <= 1e10:
            raise SearchFailed
        if number == 19:
            break
        step *= factor
        found = yield step
    return step


def descend(fit: Logistic, x: np.ndarray, l1: np.ndarray) -> Descent:
    """Quasi-Newton steps from ``x``; with a penalty ``l1`` each stays in an orthant."""
    sparse = bool(l1.any())

    def adjusted(x: np.ndarray, value: float, gradient: np.ndarray) -> tuple[float, np.ndarray]:
        if not sparse:
            return value, gradient
        still = np.where(gradient - l1 > 0, gradient - l1, np.where(gradient + l1 < 0, gradient + l1, 0.0))
        return value + float(np.abs(l1 * x).sum()), np.where(l1 == 0, gradient, np.where(x == 0, still, gradient + np.sign(x) * l1))

    value, gradient = yield x
    whole, slopes = adjusted(x, value, gradient)
    first, pairs, failed, number, seen = whole, [], False, 0, [math.inf]
    while number < fit.maxIter and np.linalg.norm(slopes) > max(fit.tol * whole, 1e-8):
        if len(seen) > 1 and abs(whole - max(seen)) <= fit.tol * first:
            break
        try:
            ahead = direction_of(slopes, pairs)
            if sparse:
                ahead = np.where(ahead * slopes < 0, ahead, 0.0)
                orthant = np.where(x != 0, np.sign(x), np.sign(-slopes))
                begin = 0.5 / np.linalg.norm(gradient) if not number else 1.0
                search = backtracked_step(value, whole, float(slopes @ ahead), begin, 0.5 if number else 0.1)
            else:
                search = wolfe_step(value, float(gradient @ ahead), 1.0 if number else 1.0 / np.linalg.norm(ahead))
            answer = None
            while True:
                try:
                    step = search.send(answer)
                except StopIteration:
                    break
                there = x + step * ahead
                if sparse:
                    there = np.where(np.sign(there) == orthant, there, 0.0)
                new_value, new_gradient = yield there
                new_whole, new_slopes = adjusted(there, new_value, new_gradient)
                answer = (new_whole, float(new_slopes @ ahead))
            if not sparse and step * np.linalg.norm(gradient) < 1e-10:
                raise SearchFailed
        except SearchFailed:
            if failed:
                break
            pairs, failed = [], True
            continue
        pairs = [*pairs, (there - x, new_gradient - gradient)][-_MEMORY:]
        x, value, gradient, whole, slopes = there, new_value, new_gradient, new_whole, new_slopes
        number, failed, seen = number + 1, False, [*seen, value][-_WINDOW:]
    return x


# ---- all together ----------------------------------------------------------


def class_moments(packed: Packed) -> dict[tuple[int, int], tuple]:
    """Rows, values, means and squared distances by fold and class; missing values are 0."""
    width = len(packed.features)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int], tuple] = {}
        for _, _, _, y, fold, _, x in chunks(batches, width, 0.0):
            for k in np.unique(fold).tolist():
                for c in (0, 1):
                    rows = np.flatnonzero((fold == k) & (y == c))
                    if len(rows):
                        own = value_moments(x[rows])
                        found[k, c] = joined_moments(found[k, c], own) if (k, c) in found else own
        rows = [(k, c, n, mean.tobytes(), spread.tobytes()) for (k, c), (n, _, mean, spread) in sorted(found.items())]
        columns = list(zip(*rows)) if rows else [()] * 5
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(columns, kinds)], names=["fold", "y", "n", "mean", "spread"])

    found: dict[tuple[int, int], tuple] = {}
    for row in packed.blocks.mapInArrow(task, "fold int, y int, n long, mean binary, spread binary").collect():  # a row per task, fold and class
        own = (row["n"], np.full(width, float(row["n"])), np.frombuffer(row["mean"]), np.frombuffer(row["spread"]))
        key = (row["fold"], row["y"])
        found[key] = joined_moments(found[key], own) if key in found else own
    return found


def _columns(found: Sequence[Fitted]) -> tuple[np.ndarray, np.ndarray]:
    return np.stack([f.weights for f in found], axis=1), np.array([f.offset for f in found])


def fit_linear_together(packed: Packed, fits: Sequence[Logistic]) -> list[Fitted] | None:
    """Each fit's weights; positives weigh neg / pos of its rows. None if some fit's rows have one class only."""
    width, fits, moments = len(packed.features), list(fits), class_moments(packed)
    about = []
    for fit in fits:
        classes = []
        for c in (0, 1):
            found = (0, np.zeros(width), np.zeros(width), np.zeros(width))
            for key in sorted(moments):
                if key[1] == c and key[0] != fit.leaves_out:
                    found = joined_moments(found, moments[key])
            classes.append(found)
        (neg, *_), (pos, *_) = classes
        if not neg or not pos:
            return None
        weight = neg / pos
        total = neg + pos * weight
        (n, present, mean, spread), (m, more, other, further) = classes
        _, _, mean, spread = joined_moments((n, present, mean, spread), (m, more * weight, other, further * weight))
        spread = np.sqrt(np.maximum(spread / (total - (neg + pos * weight * weight) / total), 0.0))
        inverse = np.divide(1.0, spread, out=np.zeros(width), where=spread != 0)
        about.append((weight, total, inverse, inverse * mean * fit.fitIntercept, math.log(pos * weight / neg)))
    heavy = np.array([weight for weight, *_ in about])
    left_out = np.array([-1 if fit.leaves_out is None else fit.leaves_out for fit in fits])

    def raw(m: int, x: np.ndarray) -> Fitted:
        """Weights of the values as they are, from those of standardised values."""
        _, _, inverse, shift, _ = about[m]
        return Fitted(x[:width] * inverse, float(x[width] - x[:width] @ shift) if fits[m].fitIntercept else 0.0)

    def evaluate(asked: dict[int, np.ndarray]) -> dict[int, tuple[float, np.ndarray]]:
        numbers = sorted(asked)
        weights, offsets = _columns([raw(m, asked[m]) for m in numbers])
        own_heavy, own_left_out = heavy[numbers], left_out[numbers]

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            loss, rest, slopes = np.zeros(len(numbers)), np.zeros(len(numbers)), np.zeros((width, len(numbers)))
            for _, _, _, y, fold, _, x in chunks(batches, width, 0.0):
                positive = (y == 1)[:, None]
                w = np.where(positive, own_heavy, (y == 0)[:, None] * 1.0) * (fold[:, None] != own_left_out)
                z = x @ weights + offsets
                small = np.exp(-np.abs(z))
                loss += (w * (np.log1p(small) + np.maximum(z, 0.0) - np.where(positive, z, 0.0))).sum(axis=0)
                away = w * (np.where(z >= 0, 1.0, small) / (1.0 + small) - positive)
                rest += away.sum(axis=0)
                slopes += x.T @ away
            yield pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()) for v in (loss, rest, slopes)], names=["loss", "rest", "slopes"])

        sums = [np.zeros(len(numbers)), np.zeros(len(numbers)), np.zeros((width, len(numbers)))]
        for row in packed.blocks.mapInArrow(task, "loss binary, rest binary, slopes binary").collect():  # a row per task
            for i, c in enumerate(("loss", "rest", "slopes")):
                sums[i] += np.frombuffer(row[c]).reshape(sums[i].shape)
        answers = {}
        for i, m in enumerate(numbers):
            fit, (_, total, inverse, shift, _), x = fits[m], about[m], asked[m]
            l2 = (1 - fit.elasticNetParam) * fit.regParam
            gradient = (sums[2][:, i] * inverse - sums[1][i] * shift) / total + l2 * x[:width]
            if fit.fitIntercept:
                gradient = np.append(gradient, sums[1][i] / total)
            answers[m] = (float(sums[0][i] / total + 0.5 * l2 * (x[:width] @ x[:width])), gradient)
        return answers

    done: dict[int, np.ndarray] = {}
    running, answers = {}, dict.fromkeys(range(len(fits)))
    for m, fit in enumerate(fits):
        l1 = np.append(np.full(width, fit.elasticNetParam * fit.regParam), [0.0] * fit.fitIntercept)
        running[m] = descend(fit, np.append(np.zeros(width), [about[m][4]] * fit.fitIntercept), l1)
    while running:
        asked = {}
        for m, descent in list(running.items()):
            try:
                asked[m] = descent.send(answers[m])
            except StopIteration as end:
                done[m] = end.value
                del running[m]
        answers = evaluate(asked) if asked else {}
    return [raw(m, done[m]) for m in range(len(fits))]


def left_out_scores(packed: Packed, fits: Sequence[Logistic], found: Sequence[Fitted]) -> DataFrame:
    """The tally of each fit's scores of the rows that it leaves out, under its number."""
    width = len(packed.features)
    weights, offsets = _columns(found)
    of = {k: [m for m, fit in enumerate(fits) if fit.leaves_out == k] for k in {fit.leaves_out for fit in fits}}

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, _, y, fold, _, x in chunks(batches, width, 0.0):
            for k in np.unique(fold).tolist():
                numbers, rows = of.get(k, []), np.flatnonzero((fold == k) & (y <= 1))
                if not numbers or not len(rows):
                    continue
                # Equal rows get equal scores wherever they stand: values are added up one by one.
                z = np.repeat(offsets[numbers][:, None], len(rows), axis=1)
                for own, w in zip(x[rows].T, weights[:, numbers]):
                    z += w[:, None] * own
                with np.errstate(over="ignore"):
                    score = 1.0 / (1.0 + np.exp(-z))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(numbers, len(rows)), pa.int32()), pa.array(score.ravel()), pa.array(np.tile(y[rows], len(numbers)), pa.int32())],
                    names=["feature", "x", "y"],
                )

    return count_values(packed.blocks.mapInArrow(task, "feature int, x double, y int"))
