"""Importances of random forests whose trees grow each in a task of its own.

As Spark ML's classifier: rows are drawn with replacement (Poisson counts),
every node tries features of its own, splits lower the Gini impurity, and a
feature's importance is the mean over trees of its share in what the splits
take off. All nodes of a level are split at once, on counts per node, tried
feature and bin.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortscore.functions.numeric import finite_or_zero, to_double
from cohortscore.operators import packed
from cohortscore.operators.boosting import binned_rows, fit_cuts
from cohortscore.session import compiled, settle

#: Spark ML's number of bins.
MAX_BINS = 32
#: Rows that every task holds while trees grow in it, a few bytes each for all features and about 60 more while a tree grows.
TASK_ROWS = 20_000_000
#: Rows whose bins are read in one go.
_SLICE = 65_536


def tried_features(draw: np.random.Generator, nodes: int, n: int, k: int) -> np.ndarray:
    """``k`` different ones of ``n`` features for each node."""
    found = np.empty((nodes, k), dtype=np.int64)
    open_ = np.arange(nodes)
    while len(open_):
        found[open_] = draw.integers(0, n, (len(open_), k))
        ordered = np.sort(found[open_], axis=1)
        open_ = open_[(ordered[:, 1:] == ordered[:, :-1]).any(axis=1)]
    return found


def impurity(counts: np.ndarray) -> np.ndarray:
    """Gini impurity of (..., classes) times the rows."""
    n = counts.sum(axis=-1)
    return n - np.divide((counts * counts).sum(axis=-1), n, out=np.zeros_like(n), where=n > 0)


@dataclass
class PackedBins:
    """Bins of many rows, a few features in a byte (``packed``); ``codes`` has the bytes of each row side by side."""

    codes: np.ndarray
    #: The byte of each feature, and its bin in each byte.
    column: np.ndarray
    decoded: np.ndarray

    @staticmethod
    def of(layout: packed.Layout, codes: np.ndarray) -> PackedBins:
        column, stride = (np.array([layout.place[f][i] for f in range(len(layout.cards))], dtype=np.int64) for i in (0, 1))
        return PackedBins(codes, column, (np.arange(256)[None, :] // stride[:, None] % layout.cards[:, None]).astype(np.uint8))


def bin_layout(cards: np.ndarray) -> packed.Layout:
    return packed.Layout(np.concatenate(([0], np.cumsum(cards + 1))), np.zeros(len(cards), dtype=bool))


def row_codes(layout: packed.Layout, bins: np.ndarray) -> np.ndarray:
    """The bytes of each row."""
    return np.ascontiguousarray(layout.pairs(bins.T).T).view(np.uint8)


def seen_bins(bins: np.ndarray | PackedBins, rows: np.ndarray, features: np.ndarray) -> np.ndarray:
    """The bins of (rows, features of each)."""
    if isinstance(bins, np.ndarray):
        return bins.ravel()[(rows * np.int64(bins.shape[1]))[:, None] + features]
    byte = bins.codes.ravel().take((rows * np.int64(bins.codes.shape[1]))[:, None] + bins.column.take(features))
    return bins.decoded.ravel().take(features * 256 + byte)


def tree_gains(bins: np.ndarray | PackedBins, y: np.ndarray, cards: np.ndarray, k: int, max_depth: int, draw: np.random.Generator) -> np.ndarray:
    """What the splits on each feature take off the impurity of one tree, as shares."""
    width, gains = len(cards), np.zeros(len(cards))
    count = draw.poisson(1.0, len(y))
    rows = np.flatnonzero(count).astype(np.int32)
    weight, label, node = count[rows].astype(np.uint8), y[rows].astype(np.uint8), np.zeros(len(rows), dtype=np.int32)
    del count
    for _ in range(max_depth):
        if not len(rows):
            break
        nodes = int(node.max()) + 1
        total = np.bincount(2 * node + label, weight, minlength=2 * nodes).reshape(-1, 2)
        whole, tried = impurity(total), tried_features(draw, nodes, width, k)
        seen = np.empty((k, len(rows)), dtype=np.uint8)
        for at in range(0, len(rows), _SLICE):
            here = slice(at, at + _SLICE)
            seen[:, here] = seen_bins(bins, rows[here], tried[node[here]]).T
        best, feature, cut, side = np.zeros(nodes), np.full(nodes, -1), np.zeros(nodes, dtype=np.int64), np.zeros(nodes, dtype=np.int64)
        for j in range(k):
            sizes = cards[tried[:, j]]
            first = np.cumsum(sizes) - sizes
            counts = np.bincount(2 * (first[node] + seen[j]) + label, weight, minlength=2 * int(sizes.sum())).reshape(-1, 2)
            owner, running = np.repeat(np.arange(nodes), sizes), np.cumsum(counts, axis=0)
            left = running - (running[first] - counts[first])[owner]
            right = total[owner] - left
            gain = whole[owner] - impurity(left) - impurity(right)
            gain[(left.sum(axis=1) <= 0) | (right.sum(axis=1) <= 0)] = 0.0
            top = np.maximum.reduceat(gain, first)
            # The first bin of the largest gain in each node.
            hits = np.flatnonzero(gain == top[owner])
            place = hits[np.unique(owner[hits], return_index=True)[1]]
            better = top > np.maximum(best, 1e-9 * whole)
            best, feature = np.where(better, top, best), np.where(better, tried[:, j], feature)
            cut, side = np.where(better, place - first, cut), np.where(better, j, side)
        split = feature >= 0
        np.add.at(gains, feature[split], best[split])
        number = np.cumsum(split) - split
        kept = np.flatnonzero(split[node])
        own = node[kept]
        below = 2 * number[own] + (seen[side[own], kept] > cut[own])
        rows, weight, label = rows[kept], weight[kept], label[kept]
        # Pure nodes stay leaves; the others are numbered without gaps.
        both = np.bincount(2 * below + label, weight, minlength=4 * int(split.sum())).reshape(-1, 2)
        mixed = (both > 0).all(axis=1)
        on = np.flatnonzero(mixed[below])
        rows, weight, label, node = rows[on], weight[on], label[on], (np.cumsum(mixed) - 1)[below[on]].astype(np.int32)
    return gains / gains.sum() if gains.sum() > 0 else gains


def task_rows(df: DataFrame, features: Sequence[str], label: str) -> tuple[DataFrame, list[list[float]]]:
    """Label and bins of the rows, missing and non-finite values as 0; and the bins' upper bounds."""
    values = [F.coalesce(finite_or_zero(to_double(df, c)), F.lit(0.0)) if c in df.columns else F.lit(0.0) for c in features]
    names = [f"c{i}" for i in range(len(features))]
    y = to_double(df, label)
    known = df.where(y.isNotNull()).select(y.alias("y"), *[v.alias(n) for v, n in zip(values, names)])
    low = known.agg(*[F.struct(F.min(n).alias("low"), F.max(n).alias("high")).alias(n) for n in names]).first()
    cuts = [
        sorted({*found, low[n]["low"]}) if low[n]["low"] is not None and low[n]["low"] < low[n]["high"] else found
        for found, n in zip(fit_cuts(known, names, MAX_BINS), names)
    ]
    with compiled(df.sparkSession):
        return settle(binned_rows(known, names, cuts, {"key": F.xxhash64("y", *names), "y": F.col("y")})), cuts


def held_bins(stored: DataFrame, cards: np.ndarray) -> tuple[PackedBins, np.ndarray]:
    """Packed bins and labels of all rows, in the order of their keys."""
    layout = bin_layout(cards)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                bins = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype=np.uint8).reshape(-1, len(cards))
                y = (batch.column(0).to_numpy() > 0).astype(np.uint8)
                yield pa.RecordBatch.from_arrays([pa.array([y.tobytes()]), pa.array([row_codes(layout, bins).tobytes()])], names=["y", "codes"])

    table = stored.orderBy("key").select("y", "bins").mapInArrow(task, "y binary, codes binary").toArrow()  # a row per batch
    y, codes = (np.frombuffer(b"".join(table.column(n).to_pylist()), dtype=np.uint8) for n in ("y", "codes"))
    return PackedBins.of(layout, codes.reshape(len(y), (len(layout.columns) + 1) // 2 * 2)), y


def importances_in_tasks(df: DataFrame, features: Sequence[str], label: str, trees: int, max_depth: int, seed: int = 42) -> list[float]:
    """The importance of each feature; the rows are few enough for a task, and go to all tasks."""
    spark, width = df.sparkSession, len(features)
    stored, cuts = task_rows(df, features, label)
    cards, k = np.array([len(c) + 1 for c in cuts], dtype=np.int64), math.ceil(math.sqrt(width))
    bins, y = held_bins(stored, cards)
    if not len(y):
        return [0.0] * width
    held = spark.sparkContext.broadcast((bins, y))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number in batch.column(0).to_pylist():
                gains = tree_gains(*held.value, cards, k, max_depth, np.random.default_rng([seed, number]))
                yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([gains.tobytes()], pa.binary())], names=["number", "gains"])

    numbers = spark.range(0, trees, 1, trees)  # a tree per partition
    # Sorted here: to sort them in Spark would grow every tree twice, as ranges are sampled first.
    found = sorted(numbers.mapInArrow(task, "number long, gains binary").toArrow().to_pylist(), key=lambda row: row["number"])
    total = np.sum([np.frombuffer(row["gains"]) for row in found], axis=0)
    return (total / total.sum() if total.sum() > 0 else total).tolist()
