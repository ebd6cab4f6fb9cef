"""Perceptrons fitted side by side on packed rows.

Rows are packed once, a byte per value where values are small whole numbers.
An iteration is one job for all networks: each task adds up the losses and
gradients of its rows, whose number depends on the networks alone, and the
driver takes the steps. Layers, losses, first weights, blocks and descent are
those of Spark ML's classifier; repeated rows are weights and are not stored.
"""

from __future__ import annotations

from collections.abc import Generator, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.classification import MultilayerPerceptronClassificationModel, MultilayerPerceptronClassifier
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortscore.functions.numeric import quoted, to_double
from cohortscore.operators.scale import MeanFill, Scaler
from cohortscore.operators.split import order_hash
from cohortscore.operators.tally import tally
from cohortscore.session import settle

#: Rows stored together; a batch of Arrow has 10,000 such blocks at most.
BLOCK = 128
#: Blocks multiplied in one go.
_CHUNK = 32
_MISSING = 255
#: The label of rows that have none.
_UNKNOWN = 255
_PACKED = (
    "part int, place long, y binary, fold binary, digits binary, codes binary, wide binary, starts binary, "
    "of int, n long, present binary, mean binary, spread binary, total binary"
)


@dataclass(frozen=True)
class Fit:
    """One network: its shape, the fold that it leaves out, how often positives count, and its descent."""

    hidden: int
    depth: int
    scaler: str = "standard"
    pos_weight: float = 1.0
    leaves_out: int | None = None
    blockSize: int = 128
    stepSize: float = 0.03
    solver: str = "l-bfgs"
    maxIter: int = 100
    tol: float = 1e-6

    def layers(self, n_features: int) -> list[int]:
        return [n_features, *[self.hidden] * self.depth, 2]

    def copies(self, y: np.ndarray, fold: np.ndarray, digits: np.ndarray) -> np.ndarray:
        """How often each row counts, as ``repeat_positives`` repeats it."""
        whole = int(self.pos_weight)
        repeated = np.where(y == 1, np.maximum(whole + (digits < self.pos_weight - whole), 1), 1)
        return np.where((y == _UNKNOWN) | (fold == (-1 if self.leaves_out is None else self.leaves_out)), 0, repeated)


@dataclass
class Packed:
    """Stored blocks, and what is known of them: rows of each fit by partition, and the moments of each fold."""

    blocks: DataFrame
    features: list[str]
    totals: dict[int, np.ndarray]
    folds: dict[int, tuple[int, np.ndarray, np.ndarray, np.ndarray]]

    def scaling(self, fit: Fit) -> tuple[MeanFill, Scaler]:
        """Means and scale of the rows that the fit learns from."""
        width = len(self.features)
        found = (0, np.zeros(width), np.zeros(width), np.zeros(width))
        for fold, own in sorted(self.folds.items()):
            if fold != fit.leaves_out:
                found = joined_moments(found, own)
        n, _, mean, spread = found
        fill = MeanFill(self.features, mean.tolist())
        if fit.scaler == "none":
            return fill, Scaler("none", self.features, [0.0] * width, [1.0] * width)
        return fill, Scaler("standard", self.features, mean.tolist(), np.sqrt(spread / max(n, 1)).tolist())


def joined_moments(a, b):
    """Rows, values, means and squared distances from them of two parts together."""
    (n, present, mean, spread), (m, more, other, further) = a, b
    both = present + more
    away, share = other - mean, np.divide(more, both, out=np.zeros_like(both), where=both > 0)
    return n + m, both, mean + away * share, spread + further + away * away * present * share


def value_moments(x: np.ndarray):
    known = ~np.isnan(x)
    present = known.sum(axis=0).astype(float)
    mean = np.divide(np.where(known, x, 0.0).sum(axis=0), present, out=np.zeros(x.shape[1]), where=present > 0)
    return len(x), present, mean, (np.where(known, x - mean, 0.0) ** 2).sum(axis=0)


def _wide_bytes(x: np.ndarray, columns: np.ndarray) -> bytes:
    return np.concatenate([[float(c), *x[:, c]] for c in columns]).tobytes() if len(columns) else b""


def pack(
    df: DataFrame, features: Sequence[str], label: str, id_column: str | None, fits: Sequence[Fit], fold: str | None = None, seed: int = 42
) -> Packed:
    """The rows of ``df`` for ``fits``. Rows without label count for means and scales only.

    Without ``fits``, which alone repeat rows, no id is needed.
    """
    digits = F.conv(F.substring(order_hash(quoted(id_column), seed), 1, 8), 16, 10).cast("double") / float(16**8) if id_column else F.lit(0.0)
    kept = df.where(quoted(fold).isNotNull()) if fold else df
    narrow = kept.select(
        to_double(df, label).alias("y"), (quoted(fold) if fold else F.lit(0)).cast("int").alias("fold"), digits.alias("digits"),
        *[to_double(df, c).alias(f"x{i}") for i, c in enumerate(features)],
    )
    fits = list(fits)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at, folds, place = TaskContext.get().partitionId(), np.zeros(len(fits), dtype=np.int64), {}, 0
        names = [kind.split()[0] for kind in _PACKED.split(", ")]
        types = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
        schema = pa.schema([(n, types[kind.split()[1]]) for n, kind in zip(names, _PACKED.split(", "))])

        def table(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(rows, schema)

        for batch in batches:
            y, of, digits = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            y = np.where(np.isnan(y), _UNKNOWN, y).astype(np.uint8)
            of = of.astype(np.int32)
            x = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[3:]], axis=1).astype(float)
            x[np.isinf(x)] = 0.0
            for k in np.unique(of).tolist():
                found = value_moments(x[of == k])
                folds[k] = joined_moments(folds[k], found) if k in folds else found
            missing = np.isnan(x)
            with np.errstate(invalid="ignore"):
                narrow_value = missing | ((x >= 0) & (x < _MISSING) & (x == np.floor(x)))
            copies = np.stack([fit.copies(y, of, digits) for fit in fits]) if fits else np.zeros((0, len(y)), dtype=np.int64)
            starts = at[:, None] + np.cumsum(copies, axis=1) - copies
            at = at + copies.sum(axis=1)
            rows = []
            for i in range(0, len(y), BLOCK):
                here = slice(i, i + BLOCK)
                wide = np.flatnonzero(~narrow_value[here].all(axis=0))
                codes = np.where(missing[here], _MISSING, x[here])
                codes[:, wide] = 0
                rows.append({
                    "part": part, "place": place + i, "y": y[here].tobytes(), "fold": of[here].tobytes(), "digits": digits[here].tobytes(),
                    "codes": codes.astype(np.uint8).tobytes(), "wide": _wide_bytes(x[here], wide), "starts": starts[:, i].tobytes(),
                })
            place += len(y)
            yield table(rows)
        if folds:
            yield table([
                {"part": part, "of": k, "n": n, "present": present.tobytes(), "mean": mean.tobytes(), "spread": spread.tobytes(), "total": at.tobytes()}
                for k, (n, present, mean, spread) in sorted(folds.items())
            ])

    # Few files of input would keep most cores idle at every pass.
    spread_over = 2 * df.sparkSession.sparkContext.defaultParallelism
    stored = settle(narrow.mapInArrow(task, _PACKED).repartition(spread_over, "part", "place"))
    totals, folds = {}, {}
    about = stored.where(F.col("of").isNotNull()).select("part", "of", "n", "present", "mean", "spread", "total")
    for row in about.orderBy("part", "of").toLocalIterator():  # a row per task and fold
        totals[row["part"]] = np.frombuffer(row["total"], dtype=np.int64)
        own = (row["n"], *(np.frombuffer(row[c]) for c in ("present", "mean", "spread")))
        folds[row["of"]] = joined_moments(folds[row["of"]], own) if row["of"] in folds else own
    blocks = stored.where(F.col("of").isNull()).select("part", "y", "fold", "digits", "codes", "wide", "starts")
    return Packed(blocks, list(features), totals, folds)


def chunks(batches: Iterator[pa.RecordBatch], width: int, missing: float = np.nan) -> Iterator[tuple]:
    """part and starts by block, rows of each block, y, fold, digits and values, ``missing`` where there is none, a few blocks at a time."""
    for batch in batches:
        for i in range(0, batch.num_rows, _CHUNK):
            part = batch.slice(i, _CHUNK)

            def read(name: str, kind) -> np.ndarray:
                return np.frombuffer(b"".join(part.column(name).to_pylist()), dtype=kind)  # noqa: B023

            sizes = np.array([len(v) for v in part.column("y").to_pylist()])
            codes = read("codes", np.uint8).reshape(-1, width)
            x = codes.astype(float)
            if (codes == _MISSING).any():
                x[codes == _MISSING] = missing
            first = np.cumsum(sizes) - sizes
            for at, size, wide in zip(first, sizes, part.column("wide").to_pylist()):
                for column in np.frombuffer(wide).reshape(-1, size + 1) if wide else ():
                    x[at : at + size, int(column[0])] = np.where(np.isnan(column[1:]), missing, column[1:])
            starts = read("starts", np.int64)
            starts = starts.reshape(len(sizes), len(starts) // len(sizes))
            yield part.column("part").to_numpy(), starts, sizes, read("y", np.uint8), read("fold", np.int32), read("digits", float), x


def row_weights(copies: np.ndarray, start: np.ndarray, total: np.ndarray, size: int) -> np.ndarray:
    """What each row counts if ``total`` rows, copies included, are cut into blocks of ``size`` whose means are added up.

    The last block of a partition may be shorter.
    """
    end, full = start + copies, total // size * size
    inside = np.minimum(end, full) - np.minimum(start, full)
    behind = np.maximum(end, full) - np.maximum(start, full)
    return inside / size + behind / np.maximum(total - full, 1)


# ---- one network -----------------------------------------------------------


def affine(weights: np.ndarray, layers: Sequence[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Views of each layer's weights (inputs x outputs) and offsets."""
    out, at = [], 0
    for a, b in zip(layers, layers[1:]):
        out.append((weights[at : at + a * b].reshape(a, b), weights[at + a * b : at + a * b + b]))
        at += a * b + b
    return out


def activations(weights: np.ndarray, layers: Sequence[int], x: np.ndarray) -> list[np.ndarray]:
    """The input and what each layer makes of it: sigmoids, and class probabilities at last."""
    found = [x]
    steps = affine(weights, layers)
    for i, (w, offset) in enumerate(steps):
        z = found[-1] @ w + offset
        if i < len(steps) - 1:
            with np.errstate(over="ignore"):
                z = 1.0 / (1.0 + np.exp(-z))
        else:
            z = np.exp(z - z.max(axis=1, keepdims=True))
            z /= z.sum(axis=1, keepdims=True)
        found.append(z)
    return found


def loss_and_gradient(weights: np.ndarray, layers: Sequence[int], x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[float, np.ndarray]:
    """Weighted cross-entropy of the rows, and its derivatives."""
    found = activations(weights, layers, x)
    rows, right = np.arange(len(y)), y.astype(np.int64)
    loss = -float(w @ np.log(np.maximum(found[-1][rows, right], 1e-300)))
    delta = found[-1].copy()
    delta[rows, right] -= 1.0
    delta *= w[:, None]
    gradient = np.empty_like(weights)
    steps, own = affine(weights, layers), affine(gradient, layers)
    for i in range(len(steps) - 1, -1, -1):
        own[i][0][:], own[i][1][:] = found[i].T @ delta, delta.sum(axis=0)
        if i:
            delta = (delta @ steps[i][0].T) * found[i] * (1.0 - found[i])
    return loss, gradient


Descent = Generator[np.ndarray, tuple[float, np.ndarray], np.ndarray]


def steepest(fit: Fit, weights: np.ndarray) -> Descent:
    """Steps of one length against the gradient, until one is short."""
    for number in range(fit.maxIter):
        _, gradient = yield weights
        before, weights = weights, weights - fit.stepSize * gradient
        if number and np.linalg.norm(weights - before) < fit.tol * max(np.linalg.norm(weights), 1.0):
            break
    return weights


def limited_memory(fit: Fit, weights: np.ndarray, memory: int = 10) -> Descent:
    """Quasi-Newton steps from the last gradients, of a length that meets both conditions of Wolfe."""
    loss, gradient = yield weights
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    losses = [loss]
    for _ in range(fit.maxIter):
        if np.linalg.norm(gradient) <= 1e-8:
            break
        direction, factors = -gradient, []
        for s, d in reversed(pairs):
            factors.append((s @ direction) / (s @ d))
            direction = direction - factors[-1] * d
        if pairs:
            s, d = pairs[-1]
            direction = direction * ((s @ d) / (d @ d))
        for (s, d), a in zip(pairs, reversed(factors)):
            direction = direction + (a - (d @ direction) / (s @ d)) * s
        slope = float(gradient @ direction)
        step, low, high = 1.0 if pairs else 1.0 / np.linalg.norm(gradient), 0.0, None
        for _ in range(30):
            there = weights + step * direction
            new_loss, new_gradient = yield there
            if not new_loss <= loss + 1e-4 * step * slope:
                high = step
            elif new_gradient @ direction < 0.9 * slope:
                low = step
            else:
                break
            step = 2 * low if high is None else (low + high) / 2
        if not new_loss < loss:
            break
        s, d = there - weights, new_gradient - gradient
        if s @ d > 0:
            pairs = [*pairs, (s, d)][-memory:]
        weights, loss, gradient = there, new_loss, new_gradient
        losses.append(loss)
        if len(losses) > memory and losses[-memory - 1] - loss <= memory * fit.tol * abs(losses[0]):
            break
    return weights


# ---- all together ----------------------------------------------------------


def classifier(spark, layers: Sequence[int], seed: int, weights: np.ndarray | None = None) -> MultilayerPerceptronClassificationModel:
    """Spark ML's model of the given weights, or of those that it begins with."""
    blank = spark.createDataFrame([(0.0, DenseVector([0.0] * layers[0]))], ["label", "features"])
    given = {} if weights is None else {"initialWeights": DenseVector(weights)}
    return MultilayerPerceptronClassifier(layers=list(layers), seed=seed, maxIter=0, solver="gd", **given).fit(blank)


def _prepared(x: np.ndarray, fill: np.ndarray, shift: np.ndarray, scale: np.ndarray) -> np.ndarray:
    missing = np.isnan(x)
    return ((np.where(missing, fill, x) if missing.any() else x) - shift) / scale


def _numbers(scaling: tuple[MeanFill, Scaler]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    fill, scaler = scaling
    return np.array(fill.means), np.array(scaler.shift), np.array([s or 1.0 for s in scaler.scale])


def fit_together(packed: Packed, fits: Sequence[Fit], seed: int = 42) -> list[np.ndarray]:
    """The weights of each network."""
    spark, width = packed.blocks.sparkSession, len(packed.features)
    layers = [fit.layers(width) for fit in fits]
    first = {tuple(shape): classifier(spark, shape, seed).weights.toArray() for shape in layers}
    numbers = [_numbers(packed.scaling(fit)) for fit in fits]
    totals, fits = packed.totals, list(fits)
    n_blocks = [sum(-(-int(t[m]) // fit.blockSize) for t in totals.values()) for m, fit in enumerate(fits)]
    # Fits that leave out the same fold and scale alike read the same matrix.
    alike = {m: next(k for k in range(m + 1) if (fits[k].leaves_out, fits[k].scaler) == (fit.leaves_out, fit.scaler)) for m, fit in enumerate(fits)}

    def evaluate(asked: dict[int, np.ndarray]) -> dict[int, tuple[float, np.ndarray]]:
        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[int, list] = {}
            for part, starts, sizes, y, fold, digits, x in chunks(batches, width):
                begin, ready = np.cumsum(sizes) - sizes, {}
                for m, weights in asked.items():
                    fit = fits[m]
                    copies = fit.copies(y, fold, digits)
                    run = np.cumsum(copies) - copies
                    start = run + np.repeat(starts[:, m] - run[begin], sizes)
                    w = row_weights(copies, start, np.repeat([totals[p][m] for p in part.tolist()], sizes), fit.blockSize)
                    rows = np.flatnonzero(copies)
                    if not len(rows):
                        continue
                    if alike[m] not in ready:
                        ready[alike[m]] = _prepared(x[rows], *numbers[m])
                    loss, gradient = loss_and_gradient(weights, layers[m], ready[alike[m]], y[rows], w[rows])
                    if m in sums:
                        sums[m][0] += loss
                        sums[m][1] += gradient
                    else:
                        sums[m] = [loss, gradient]
            columns = [pa.array(sums.keys(), pa.int32()), pa.array([s[0] for s in sums.values()], pa.float64())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([s[1].tobytes() for s in sums.values()], pa.binary())], names=["m", "loss", "gradient"])

        found = {m: (0.0, np.zeros_like(weights)) for m, weights in asked.items()}
        for row in packed.blocks.mapInArrow(task, "m int, loss double, gradient binary").toArrow().to_pylist():  # a row per task and network
            loss, gradient = found[row["m"]]
            found[row["m"]] = (loss + row["loss"], gradient + np.frombuffer(row["gradient"]))
        return {m: (loss / max(n_blocks[m], 1), gradient / max(n_blocks[m], 1)) for m, (loss, gradient) in found.items()}

    done: dict[int, np.ndarray] = {}
    running = {m: (steepest if fit.solver == "gd" else limited_memory)(fit, first[tuple(layers[m])]) for m, fit in enumerate(fits)}
    answers: dict[int, tuple[float, np.ndarray] | None] = dict.fromkeys(running)
    while running:
        asked = {}
        for m, descent in list(running.items()):
            try:
                asked[m] = descent.send(answers[m])
            except StopIteration as end:
                done[m] = end.value
                del running[m]
        answers = evaluate(asked) if asked else {}
    return [done[m] for m in range(len(fits))]


def left_out_tally(packed: Packed, fits: Sequence[Fit], weights: Sequence[np.ndarray]) -> DataFrame:
    """The tally of each network's scores of the rows that it leaves out, under ``p`` and its number."""
    width, fits, weights = len(packed.features), list(fits), list(weights)
    numbers = [_numbers(packed.scaling(fit)) for fit in fits]
    names = [f"p{m}" for m in range(len(fits))]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, _, y, fold, _, x in chunks(batches, width):
            columns = []
            for m, fit in enumerate(fits):
                rows = np.flatnonzero(fold == fit.leaves_out)
                # Equal rows get equal scores wherever they stand: products are of whole tiles.
                padded = np.zeros((-(-len(rows) // 64) * 64, width))
                padded[: len(rows)] = _prepared(x[rows], *numbers[m])
                score = np.full(len(y), np.nan)
                score[rows] = activations(weights[m], fit.layers(width), padded)[-1][: len(rows), 1]
                columns.append(pa.array(score, from_pandas=True))
            yield pa.RecordBatch.from_arrays([pa.array(np.where(y == _UNKNOWN, np.nan, y), from_pandas=True), *columns], names=["y", *names])

    return tally(packed.blocks.mapInArrow(task, "y double, " + ", ".join(f"{n} double" for n in names)), F.col("y"), names)
