"""Regularised boosted trees on histograms of gradients.

Features are cut into quantile bins once and every row is stored as one byte
per feature. A level of a tree is one job: each partition routes its rows
through the trees so far, adds up first and second derivatives of the logistic
loss per (model, node, feature, bin), and Spark adds the partitions up. Splits
are found on those sums, whose size depends on bins and nodes alone.

Where the rows are few enough for one task, which is counted, each model grows
in a task of its own instead, by the same steps, with its rows packed
(``packed``) unless they are very few. More rows are dealt over tasks that run
side by side and send each other their sums (``dealt``); a job for each level is
left for executors that come and go, and for rows that do not fit into tasks.

Several models grow together, one job a level for all of them: the models of a
cross validation differ in the fold that they leave out and may differ in their
settings. The rows' scores under the trees so far are stored every few rounds,
so that a level routes rows through few trees and a lost executor costs little.

With a patience, the rows a model leaves out are scored under every prefix of
its trees, a block of prefixes in one pass; trees are kept up to the prefix
with the largest precision-recall area, and growing ends when it has not risen
for that many rounds.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortscore.functions.numeric import quoted, to_double
from cohortscore.operators.metrics import ranking_metrics
from cohortscore.operators.tally import ordered_points, tally
from cohortscore.session import compiled, settle

MAX_BINS = 64
#: The bin of missing values.
MISSING = 255
#: Rounds after which the rows' scores are stored anew, and whose prefixes are judged in one pass.
BLOCK_ROUNDS = 16
#: Rows up to which each model grows in one task, about a hundred bytes each.
TASK_ROWS = 1_000_000
#: Rows up to which they are not packed there.
PLAIN_ROWS = 20_000
#: Rows that a task holds where more tasks grow a tree together, about a hundred bytes each and 16 for every model of a stage.
HELD_ROWS = 10_000_000
#: Partitions whose sums the driver adds up itself; more are added up by Spark.
FAN_IN = 64
#: Gains that differ by this share are equal where sums are added up in any order.
TIE = 1e-9
_SLICE = 16_384
_LEAST_GAIN = 1e-6


@dataclass(frozen=True)
class Settings:
    """Settings of a fit; defaults of the feature ranking."""

    # The ranking's trees.
    rounds: int = 400
    eta: float = 0.1
    max_depth: int = 6
    subsample: float = 0.8
    colsample: float = 0.8
    min_child_weight: float = 1.0
    gamma: float = 0.0
    reg_lambda: float = 1.0
    reg_alpha: float = 0.0
    max_delta_step: float = 0.0
    scale_pos_weight: float = 1.0
    #: Rounds without gain after which growing ends; None grows all rounds.
    patience: int | None = None


@dataclass
class Tree:
    """Nodes in order of depth; ``feature`` is -1 at a leaf, ``value`` its score."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    missing_left: list[bool] = field(default_factory=lambda: [True])
    left: list[int] = field(default_factory=lambda: [-1])
    gain: list[float] = field(default_factory=lambda: [0.0])
    value: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, cut: int, missing_left: bool, gain: float) -> tuple[int, int]:
        """Make ``node`` a split; its children stand side by side at the end."""
        self.feature[node], self.cut[node], self.missing_left[node] = feature, cut, missing_left
        self.left[node], self.gain[node] = len(self.feature), gain
        for _ in range(2):
            self.feature.append(-1)
            self.cut.append(0)
            self.missing_left.append(True)
            self.left.append(-1)
            self.gain.append(0.0)
            self.value.append(0.0)
        return self.left[node], self.left[node] + 1

    def nodes(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        feature, cut, left = np.array(self.feature), np.array(self.cut), np.array(self.left)
        missing_left = np.array(self.missing_left)
        at = np.zeros(len(bins), dtype=np.int64)
        inner = np.flatnonzero(feature[at] >= 0)
        while len(inner):
            node = at[inner]
            seen = bins[inner, feature[node]]
            goes_left = np.where(seen == MISSING, missing_left[node], seen <= cut[node])
            at[inner] = left[node] + ~goes_left
            inner = inner[feature[at[inner]] >= 0]
        return at

    def scores(self, bins: np.ndarray) -> np.ndarray:
        return np.array(self.value)[self.nodes(bins)]


# ---- bins ------------------------------------------------------------------


def fit_cuts(df: DataFrame, features: Sequence[str], max_bins: int = MAX_BINS) -> list[list[float]]:
    """Ascending upper bounds of each feature's bins but the last, from one aggregate over all features."""
    return fit_bins(df, features, max_bins)[0]


def fit_bins(df: DataFrame, features: Sequence[str], max_bins: int = MAX_BINS, *more: Column) -> tuple[list[list[float]], tuple]:
    """Upper bounds as of ``fit_cuts``, and values of ``more`` aggregates."""
    if not 2 <= max_bins < MISSING:
        raise ValueError(f"2 to {MISSING - 1} bins")
    shares = [i / max_bins for i in range(1, max_bins)]
    marks = [F.percentile_approx(to_double(df, c), shares, 10 * max_bins).alias(f"q{i}") for i, c in enumerate(features)]
    tops = [F.max(to_double(df, c)).alias(f"m{i}") for i, c in enumerate(features)]
    row = df.agg(*marks, *tops, *more).first()
    return [sorted({q for q in row[f"q{i}"] or [] if q < row[f"m{i}"]}) for i in range(len(features))], row[2 * len(features) :]


def bin_column(values: np.ndarray, cuts: Sequence[float]) -> np.ndarray:
    bins = np.searchsorted(np.asarray(cuts, dtype=float), values, side="left").astype(np.uint8)
    bins[np.isnan(values)] = MISSING
    return bins


def narrow_rows(df: DataFrame, features: Sequence[str], keep: dict[str, Column]) -> DataFrame:
    """``keep`` columns and values. Columns that ``df`` lacks are missing values."""
    values = [to_double(df, c) if c in df.columns else F.lit(None).cast("double") for c in features]
    return df.select(*[c.alias(n) for n, c in keep.items()], *[v.alias(f"__{i}") for i, v in enumerate(values)])


def binned_rows(df: DataFrame, features: Sequence[str], cuts: Sequence[Sequence[float]], keep: dict[str, Column]) -> DataFrame:
    """``keep`` columns and ``bins``: one byte per feature. Columns that ``df`` lacks are missing values."""
    names, narrow = list(keep), narrow_rows(df, features, keep)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = batch.columns[len(names) :]
            bins = [bin_column(c.to_numpy(zero_copy_only=False), k) for c, k in zip(columns, cuts)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(names)], pa.array([row.tobytes() for row in np.stack(bins, axis=1)], pa.binary())],
                names=[*names, "bins"],
            )

    kinds = {f.name: f.dataType.simpleString() for f in narrow.schema.fields}
    return narrow.mapInArrow(task, ", ".join(f"`{n}` {kinds[n]}" for n in names) + ", bins binary")


# ---- one level -------------------------------------------------------------


def level_sums(bins: np.ndarray, slot: np.ndarray, grad: np.ndarray, hess: np.ndarray, width: int, spans: np.ndarray) -> np.ndarray:
    """(width, bins of all features, 2): sums of derivatives; rows of slot -1 count nowhere.

    ``spans`` are the places of the features' first bins; the last bin of a feature is that of missing values.
    """
    total = int(spans[-1])
    out = np.zeros((width * total, 2))
    last = spans[1:] - spans[:-1] - 1
    for at in range(0, len(bins), _SLICE):
        rows = at + np.flatnonzero(slot[at : at + _SLICE] >= 0)
        part = bins[rows].astype(np.int64)
        place = np.where(part == MISSING, last, part) + spans[:-1] + slot[rows][:, None] * total
        for k, weights in enumerate((grad[rows], hess[rows])):
            out[:, k] += np.bincount(place.ravel(), np.repeat(weights, place.shape[1]), minlength=len(out))
    return out.reshape(width, total, 2)


def leaf_value(g: np.ndarray, h: np.ndarray, s: Settings) -> np.ndarray:
    """The best score of a leaf under both penalties and the step limit."""
    shrunk = np.sign(g) * np.maximum(np.abs(g) - s.reg_alpha, 0.0)
    value = -np.divide(shrunk, h + s.reg_lambda, out=np.zeros_like(shrunk), where=h + s.reg_lambda > 0)
    return np.clip(value, -s.max_delta_step, s.max_delta_step) if s.max_delta_step > 0 else value


def leaf_gain(g: np.ndarray, h: np.ndarray, s: Settings) -> np.ndarray:
    """Twice what the leaf's best score takes off the penalised loss."""
    w = leaf_value(g, h, s)
    return -(2 * g * w + (h + s.reg_lambda) * w * w + 2 * s.reg_alpha * np.abs(w))


def best_splits(
    sums: np.ndarray, spans: np.ndarray, allowed: np.ndarray, s: Settings, tie: float = 0.0
) -> list[tuple[float, int, int, bool] | None]:
    """For each node of (nodes, bins, 2): gain, feature, last bin to the left, whether missing values go left.

    None if no split is worth it. Of equal gains the first feature and the
    lowest bin win, missing values going left before right. ``tie`` is the share
    of a gain that the order of sums may change.
    """
    first, last = spans[:-1], spans[1:] - 1
    feature = np.repeat(np.arange(len(first)), np.diff(spans))
    running = np.cumsum(sums, axis=1)
    before = np.where(first[None, :, None] > 0, running[:, first - 1], 0.0)
    missing = sums[:, last]
    whole = (running[:, last] - before)[:, :1]
    below = running - before[:, feature]
    parent = leaf_gain(whole[..., 0], whole[..., 1], s)
    barred = ~allowed[feature]
    barred[last] = True
    best: list[tuple[float, int, int, bool] | None] = [None] * len(sums)
    for missing_left in (True, False):
        left = below + missing[:, feature] if missing_left else below
        right = whole - left
        gain = leaf_gain(left[..., 0], left[..., 1], s) + leaf_gain(right[..., 0], right[..., 1], s) - parent
        light = np.minimum(left[..., 1], right[..., 1]) < max(s.min_child_weight, 1e-12)
        gain[light | barred] = -np.inf
        top = gain.max(axis=1)
        for node, at in enumerate(np.argmax(gain >= (top - tie * np.abs(np.where(top > 0, top, 0.0)))[:, None], axis=1).tolist()):
            own = float(gain[node, at])
            if own > max(_LEAST_GAIN, s.gamma) and (best[node] is None or own > best[node][0] * (1 + 2 * tie) + 1e-12):
                best[node] = (own, int(feature[at]), int(at - first[feature[at]]), missing_left)
    return best


def open_level(tree: Tree, nodes: list[int], sums: np.ndarray, spans: np.ndarray, allowed: np.ndarray, s: Settings, depth: int, tie: float = 0.0) -> list[int]:
    """Values of the open ``nodes`` from their sums, and the nodes that their splits open."""
    whole = sums[:, : spans[1]].sum(axis=1)
    for node, value in zip(nodes, leaf_value(whole[:, 0], whole[:, 1], s).tolist()):
        tree.value[node] = s.eta * value
    opened = []
    if depth < s.max_depth:
        for node, found in zip(nodes, best_splits(sums, spans, allowed, s, tie)):
            if found:
                gain, feature, cut, missing_left = found
                opened += tree.split(node, feature, cut, missing_left, gain)
    return opened


# ---- growing ---------------------------------------------------------------


def uniform(keys: np.ndarray, salt: int) -> np.ndarray:
    """Numbers in [0, 1) that depend on the row's key and the salt alone."""
    x = keys.view(np.uint64) + np.uint64((salt * 0x9E3779B97F4A7C15) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) / 2.0**64


@dataclass
class Model:
    """A model while it grows: settings, the fold it leaves out, and its trees."""

    number: int
    settings: Settings
    leaves_out: int | None
    seed: int
    trees: list[Tree] = field(default_factory=list)
    areas: list[float | None] = field(default_factory=list)

    def salt(self) -> int:
        return (self.seed * 1_000_003 + self.number) * 1_000_003 + len(self.trees)

    def columns(self, n: int) -> np.ndarray:
        """The features that the next tree may use."""
        allowed = np.zeros(n, dtype=bool)
        draw = np.random.default_rng(self.salt())
        allowed[draw.choice(n, max(1, int(self.settings.colsample * n)), replace=False)] = True
        return allowed

    def best_round(self) -> int:
        """The prefix with the largest area before patience ends, the shortest of equals; all trees without areas."""
        best, at, patience = None, len(self.trees), self.settings.patience
        for n, area in enumerate(self.areas, 1):
            if patience is not None and best is not None and n - 1 - at >= patience:
                break
            if area is not None and (best is None or area > best):
                best, at = area, n
        return at

    def finished(self) -> bool:
        s = self.settings
        stale = s.patience is not None and len(self.areas) - self.best_round() >= s.patience
        return stale or len(self.trees) >= s.rounds


def read_rows(batch: pa.RecordBatch, n_features: int, n_models: int) -> tuple[np.ndarray, ...]:
    """key, label, fold, bins, margins of a batch."""
    def joined(column, kind, width):
        return np.frombuffer(b"".join(column.to_pylist()), dtype=kind).reshape(-1, width)

    key, y, fold = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
    bins = joined(batch.column("bins"), np.uint8, n_features)
    margins = joined(batch.column("margins"), np.float64, n_models) if "margins" in batch.schema.names else np.zeros((len(bins), n_models))
    return key, y, fold, bins, margins


def with_margins(rows: DataFrame, models: Sequence[Model], since: list[int], n_features: int) -> DataFrame:
    """``rows`` with their scores under all trees of each model; ``since`` tells which are counted already."""
    new = [m.trees[s:] for m, s in zip(models, since)]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *_, bins, margins = read_rows(batch, n_features, len(new))
            margins = margins.copy()
            for m, trees in enumerate(new):
                for tree in trees:
                    margins[:, m] += tree.scores(bins)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in ("key", "y", "fold", "bins")), pa.array([r.tobytes() for r in margins], pa.binary())],
                names=["key", "y", "fold", "bins", "margins"],
            )

    return rows.mapInArrow(task, "key long, y double, fold int, bins binary, margins binary")


def grow_level(rows: DataFrame, models: Sequence[Model], growing: dict[int, tuple[Tree, list[int]]], since: list[int], spans: np.ndarray, fan_in: int) -> dict[int, np.ndarray]:
    """Sums of each growing model's open nodes: model to (nodes, bins, 2)."""
    n_features, total = len(spans) - 1, int(spans[-1])
    plans = [
        (m, models[m].settings, models[m].leaves_out, models[m].salt(), models[m].trees[since[m] :], tree, nodes)
        for m, (tree, nodes) in growing.items()
    ]
    n_models = len(models)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            key, y, fold, bins, margins = read_rows(batch, n_features, n_models)
            for m, s, out, salt, trees, tree, nodes in plans:
                mine = np.ones(len(y), dtype=bool) if out is None else fold != out
                if s.subsample < 1.0:
                    mine &= uniform(key, salt) < s.subsample
                at = np.flatnonzero(mine)
                own, margin = bins[at], margins[at, m].copy()
                for done in trees:
                    margin += done.scores(own)
                p = 1.0 / (1.0 + np.exp(-margin))
                weight = np.where(y[at] == 1, s.scale_pos_weight, 1.0)
                slot_of = np.full(len(tree.feature), -1)
                slot_of[nodes] = np.arange(len(nodes))
                found = level_sums(own, slot_of[tree.nodes(own)], weight * (p - y[at]), weight * p * (1 - p), len(nodes), spans)
                sums[m] = sums[m] + found if m in sums else found
        found = [(m, place, g, h) for m, a in sums.items() for place, (g, h) in enumerate(a.reshape(-1, 2)) if h or g] if not direct else []
        if direct:
            yield pa.RecordBatch.from_arrays(
                [pa.array(sums.keys(), pa.int32()), pa.array([a.tobytes() for a in sums.values()], pa.binary())], names=["model", "sums"]
            )
        else:
            columns = zip(*found) if found else [()] * 4
            kinds = (pa.int32(), pa.int64(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["model", "place", "g", "h"])

    direct = rows.rdd.getNumPartitions() <= fan_in
    result = {m: np.zeros((len(nodes) * total, 2)) for m, (_, nodes) in growing.items()}
    if direct:
        for row in rows.mapInArrow(task, "model int, sums binary").toArrow().to_pylist():
            result[row["model"]] += np.frombuffer(row["sums"]).reshape(-1, 2)
    else:
        added = rows.mapInArrow(task, "model int, place long, g double, h double").groupBy("model", "place").agg(
            F.sum("g").alias("g"), F.sum("h").alias("h")
        )
        table = added.toArrow()  # as many rows as nodes and bins, however many rows the data has
        for m in result:
            mine = table.filter(pa.compute.equal(table.column("model"), m))
            result[m][mine.column("place").to_numpy()] = np.stack([mine.column("g").to_numpy(), mine.column("h").to_numpy()], axis=1)
    return {m: a.reshape(-1, total, 2) for m, a in result.items()}


def grow_round(rows: DataFrame, models: Sequence[Model], since: list[int], spans: np.ndarray, fan_in: int) -> None:
    """One tree more for every model that is not finished, level by level."""
    growing = {m.number: (Tree(), [0]) for m in models if not m.finished()}
    trees = {m: tree for m, (tree, _) in growing.items()}
    allowed = {m: models[m].columns(len(spans) - 1) for m in growing}
    depth = 0
    while growing:
        sums = grow_level(rows, models, growing, since, spans, fan_in)
        further = {}
        for m, (tree, nodes) in growing.items():
            opened = open_level(tree, nodes, sums[m], spans, allowed[m], models[m].settings, depth, TIE)
            if opened:
                further[m] = (tree, opened)
        growing, depth = further, depth + 1
    for m, tree in trees.items():
        models[m].trees.append(tree)


def judge_prefixes(rows: DataFrame, models: Sequence[Model], since: list[int], n_features: int) -> None:
    """Areas under the precision-recall curve of the prefixes since the last time, on each model's left-out rows."""
    wanted = [m for m in models if m.settings.patience is not None and len(m.areas) < len(m.trees)]
    if not wanted:
        return
    n_models = len(models)
    names = [(m, k, f"m{m.number}_{k}") for m in wanted for k in range(len(m.areas), len(m.trees))]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, y, fold, bins, margins = read_rows(batch, n_features, n_models)
            columns = []
            for m in wanted:
                margin = margins[:, m.number]
                held = fold == m.leaves_out
                for k in range(since[m.number], len(m.trees)):
                    margin = margin + m.trees[k].scores(bins)  # a new array, as the old one is in a column
                    if k >= len(m.areas):
                        columns.append(pa.array(margin, pa.float64(), mask=~held))
            yield pa.RecordBatch.from_arrays([pa.array(y), *columns], names=["y", *[n for _, _, n in names]])

    scored = rows.mapInArrow(task, "y double, " + ", ".join(f"{n} double" for _, _, n in names))
    found = ranking_metrics(ordered_points(tally(scored, F.col("y"), [n for _, _, n in names]))).collect()  # a row per prefix
    areas = {r["feature"]: r["pr_auc"] for r in found}
    for m, _, name in names:
        m.areas.append(areas.get(name))


# ---- in one task -----------------------------------------------------------


def average_precision(y: np.ndarray, score: np.ndarray) -> float | None:
    """Step-wise area of precision over recall, ties as one step; None with one class."""
    positives = y.sum()
    if not len(y) or positives in (0, len(y)):
        return None
    order = np.argsort(-score)  # within ties any order will do
    ends = np.flatnonzero(np.append(np.diff(score[order]) != 0, True))
    hits = np.cumsum(y[order])[ends]
    return float(np.sum(np.diff(hits, prepend=0.0) / positives * hits / (ends + 1)))


def grow_alone(model: Model, key: np.ndarray, y: np.ndarray, fold: np.ndarray, bins: np.ndarray, spans: np.ndarray) -> None:
    """All trees of one model from rows in memory, as ``grow_round`` and ``judge_prefixes`` give them."""
    s = model.settings
    margin = np.zeros(len(y))
    mine = np.ones(len(y), dtype=bool) if model.leaves_out is None else fold != model.leaves_out
    weight = np.where(y == 1, s.scale_pos_weight, 1.0)
    while not model.finished():
        taken = mine & (uniform(key, model.salt()) < s.subsample) if s.subsample < 1.0 else mine
        own = bins[taken]
        p = 1.0 / (1.0 + np.exp(-margin[taken]))
        grad, hess = weight[taken] * (p - y[taken]), weight[taken] * p * (1 - p)
        tree, nodes, depth, allowed = Tree(), [0], 0, model.columns(len(spans) - 1)
        while nodes:
            slot = np.full(len(tree.feature), -1)
            slot[nodes] = np.arange(len(nodes))
            sums = level_sums(own, slot[tree.nodes(own)], grad, hess, len(nodes), spans)
            nodes, depth = open_level(tree, nodes, sums, spans, allowed, s, depth), depth + 1
        model.trees.append(tree)
        margin = margin + tree.scores(bins)
        if s.patience is not None:
            model.areas.append(average_precision(y[~mine], margin[~mine]))


def grow_in_tasks(rows: DataFrame, models: Sequence[Model], spans: np.ndarray, plain_rows: int) -> None:
    """Each model in a task of its own; ``rows`` are few, and go to all tasks. More than ``plain_rows`` are packed."""
    spark, n_features = rows.sparkSession, len(spans) - 1
    table = rows.select("key", "y", "fold", "bins").orderBy("key").toArrow().combine_chunks()
    held = spark.sparkContext.broadcast((read_rows(table.to_batches()[0], n_features, 1)[:4], list(models)))

    plain = table.num_rows <= plain_rows

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from cohortscore.operators import packed  # which builds on this module

        for batch in batches:
            (key, y, fold, bins), all_models = held.value
            for number in batch.column(0).to_pylist():
                model = all_models[number]
                if plain:
                    grow_alone(model, key, y, fold, bins, spans)
                else:
                    packed.grow_alone(model, packed.Held(key, y, fold, bins, spans, packed.empty_bins(bins)))
                text = json.dumps({"trees": [asdict(t) for t in model.trees], "areas": model.areas})
                yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([text])], names=["number", "text"])

    numbers = spark.range(0, len(models), 1, len(models))  # a model per partition
    for row in numbers.mapInArrow(task, "number long, text string").collect():
        found = json.loads(row["text"])
        models[row["number"]].trees = [Tree(**t) for t in found["trees"]]
        models[row["number"]].areas = found["areas"]


@dataclass
class BoostedModel:
    """A fitted model: features, the cuts of their bins, trees up to the best prefix, and how it was judged."""

    features: list[str]
    cuts: list[list[float]]
    trees: list[Tree]
    settings: Settings
    areas: list[float | None] = field(default_factory=list)

    def score(self, df: DataFrame, out: str = "predicted_proba", prefixes: Sequence[int] | None = None) -> DataFrame:
        """``df`` with the probability of the positive class; with ``prefixes``, one column ``out_<n>`` for each."""
        features, cuts, trees = self.features, self.cuts, self.trees
        wanted = {n: f"{out}_{n}" for n in prefixes} if prefixes is not None else {len(trees): out}
        values = [to_double(df, c) if c in df.columns else F.lit(None).cast("double") for c in features]

        @F.arrow_udf("array<double>")
        def margins(*columns: pa.Array) -> pa.Array:
            bins = np.stack([bin_column(c.to_numpy(zero_copy_only=False).astype(float), k) for c, k in zip(columns, cuts)], axis=1)
            running, found = np.zeros(len(bins)), {0: np.zeros(len(bins))}
            for n, tree in enumerate(trees, 1):
                running = running + tree.scores(bins)
                if n in wanted:
                    found[n] = running
            table = 1.0 / (1.0 + np.exp(-np.stack([found[n] for n in wanted], axis=1)))
            ends = np.arange(len(bins) + 1) * len(wanted)
            return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(table.ravel()))

        kept = [quoted(c) for c in df.columns if c not in wanted.values()]
        scored = df.select(*kept, margins(*values).alias("__margins"))
        return scored.select(*kept, *[F.col("__margins")[i].alias(c) for i, c in enumerate(wanted.values())])

    def importances(self) -> dict[str, float]:
        """Mean gain of the splits on each feature; 0 for features without a split."""
        total, n = dict.fromkeys(self.features, 0.0), dict.fromkeys(self.features, 0)
        for tree in self.trees:
            for feature, gain in zip(tree.feature, tree.gain):
                if feature >= 0:
                    total[self.features[feature]] += gain
                    n[self.features[feature]] += 1
        return {f: total[f] / max(n[f], 1) for f in self.features}

    def to_json(self) -> str:
        return json.dumps(
            {
                "features": self.features, "cuts": self.cuts, "settings": asdict(self.settings),
                "trees": [asdict(t) for t in self.trees], "areas": self.areas,
            }
        )

    @staticmethod
    def from_json(text: str) -> BoostedModel:
        read = json.loads(text)
        trees = [Tree(**t) for t in read["trees"]]
        return BoostedModel(read["features"], read["cuts"], trees, Settings(**read["settings"]), read["areas"])


def fit_many(
    df: DataFrame, features: Sequence[str], label: str, id_column: str | None, settings: Sequence[Settings],
    leaves_out: Sequence[int | None], fold: str | None = None, seed: int = 42, max_bins: int = MAX_BINS,
    task_rows: int = TASK_ROWS, block_rounds: int = BLOCK_ROUNDS, fan_in: int = FAN_IN,
    plain_rows: int = PLAIN_ROWS, held_rows: int = HELD_ROWS,
) -> list[BoostedModel]:
    """Models of ``settings`` that grow together, each without the rows of the fold that it leaves out.

    Up to ``task_rows`` rows, which are counted, each model grows in a task of
    its own, so that a search with many models is as parallel as they are many;
    more than ``plain_rows`` are packed there. Still more rows are dealt over as
    many tasks as run at once, which grow the models together; above
    ``held_rows`` a task, rows stay where they are and a level is a job.

    Rows without a label are not used. Missing values go to the side of each
    split that gains more. Rows are sampled by a hash of their id, so a rerun
    gives the same trees up to the order of sums. Bins are fitted on all
    labelled rows, label not seen. Without an id column the whole row is the id. A model with a patience needs a fold to
    leave out. An empty table gives models without trees.
    """
    models = [Model(i, s, out, seed) for i, (s, out) in enumerate(zip(settings, leaves_out))]
    if any(m.settings.patience is not None and m.leaves_out is None for m in models):
        raise ValueError("stopping early needs a fold that is left out")
    y = to_double(df, label)
    known = df.where(y.isNotNull())
    n = known.count()
    # Values that are not missing are counted where rows are packed for all tasks.
    counted = [F.count_if(to_double(known, c).isNotNull() & ~F.isnan(to_double(known, c))) for c in features] if n > task_rows else []
    cuts, present = fit_bins(known, features, max_bins, *counted)
    identity = [id_column] if id_column else df.columns
    keep = {
        "key": F.xxhash64(*[quoted(c).cast("string") for c in identity]), "y": (to_double(known, label) > 0).cast("double"),
        "fold": (quoted(fold) if fold else F.lit(-1)).cast("int"),
    }
    spans = np.concatenate(([0], np.cumsum([len(c) + 2 for c in cuts])))
    built = lambda: [BoostedModel(list(features), cuts, m.trees[: m.best_round()], m.settings, m.areas) for m in models]
    if not n:
        return [BoostedModel(list(features), cuts, [], m.settings) for m in models]
    if n > task_rows:
        from cohortscore.operators import dealt, packed  # which build on this module

        tasks = dealt.side_by_side(df.sparkSession)
        if n <= tasks * held_rows:
            with compiled(df.sparkSession):
                layout = packed.Layout(spans, np.array(present) < n)
                dealt.grow_dealt(narrow_rows(known, features, keep), models, cuts, layout, tasks, block_rounds)
            return built()
    with compiled(df.sparkSession):
        rows = settle(binned_rows(known, features, cuts, keep))
    since = [0] * len(models)
    if n <= task_rows:
        grow_in_tasks(rows, models, spans, plain_rows)
    while not all(m.finished() for m in models):
        for _ in range(block_rounds):
            grow_round(rows, models, since, spans, fan_in)
        judge_prefixes(rows, models, since, len(features))
        if not all(m.finished() for m in models):
            rows = settle(with_margins(rows, models, since, len(features)))
            since = [len(m.trees) for m in models]
    return built()


def fit(
    df: DataFrame, features: Sequence[str], label: str, id_column: str | None = None, settings: Settings = Settings(),
    held: str | None = None, seed: int = 42, **options,
) -> BoostedModel:
    """One model; rows whose boolean ``held`` is true only decide where its trees end."""
    if held:
        df = df.withColumn("__fold", F.coalesce(quoted(held), F.lit(False)).cast("int"))
        return fit_many(df, features, label, id_column, [settings], [1], "__fold", seed, **options)[0]
    return fit_many(df, features, label, id_column, [replace(settings, patience=None)], [None], None, seed, **options)[0]
