"""Boosted trees on rows that are dealt over tasks which run side by side.

The tasks of a barrier stage hold a table's packed rows between them, and a
tree grows in all of them at once by the steps of ``packed``: every task adds
up its own rows, the tasks send each other these sums, whose size depends on
bins and nodes alone, through files in the shared folder, and each finds the
same splits in what they add up to.

A stage grows a block of rounds. Rows are stored with their scores after it, so
a lost executor costs a block. Models grow one after the other within a stage,
a few of them in each, whatever their number. Where prefixes are judged, each
prefix's scores of the left-out rows are ranked in a task of their own.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import asdict
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark import BarrierTaskContext
from pyspark.sql import DataFrame, SparkSession

from cohortscore.operators import boosting as base
from cohortscore.operators import packed
from cohortscore.session import discard, run_folder, shared_folder

#: Tasks that send sums to each other; each reads those of all.
MOST_TASKS = 32
#: Models that grow in a stage.
GROUP = 8
#: Rounds of a stage if no prefix is judged.
SAVED_ROUNDS = 100
#: Rows stored together.
_BLOCK = 16_384
#: Seconds between two looks for a file.
_PAUSE, _LONGEST_PAUSE = 0.0002, 0.005
_KINDS = {"string": pa.string(), "int": pa.int32(), "binary": pa.binary()}
_SCHEMA = "kind string, number int, prefix int, text string, key binary, y binary, fold binary, codes binary, margins binary"


def side_by_side(spark: SparkSession) -> int:
    """Tasks that can run at once, ``MOST_TASKS`` at most; none if executors come and go, or the shared folder is no folder to Python."""
    context = spark.sparkContext
    place = spark._jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    scheme = place.getFileSystem(spark._jsc.hadoopConfiguration()).getUri().getScheme()
    if scheme != "file" or context.getConf().get("spark.dynamicAllocation.enabled", "false").lower() == "true":
        return 0
    sc = context._jsc.sc()
    return min(MOST_TASKS, sc.maxNumConcurrentTasks(sc.resourceProfileManager().defaultResourceProfile()))


def _batch(**row) -> pa.RecordBatch:
    """One row; arrays are stored as bytes."""
    fields = [kind.split() for kind in _SCHEMA.split(", ")]
    given = {n: v.tobytes() if isinstance(v, np.ndarray) else v for n, v in row.items()}
    return pa.RecordBatch.from_arrays([pa.array([given.get(n)], _KINDS[kind]) for n, kind in fields], names=[n for n, _ in fields])


def pack(narrow: DataFrame, cuts: Sequence[Sequence[float]], layout: packed.Layout) -> DataFrame:
    """Blocks of rows from key, label, fold and values."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                key, y, fold, *values = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
                codes = layout.pairs([base.bin_column(v.astype(float), k) for v, k in zip(values, cuts)])
                fold = np.where(np.isnan(fold), -1, fold) if fold.dtype.kind == "f" else fold
                yield _batch(kind="rows", key=key, y=y.astype(np.uint8), fold=fold.astype(np.int32), codes=codes)

    return narrow.mapInArrow(task, _SCHEMA)


def _read(batches: Iterator[pa.RecordBatch], layout: packed.Layout, before: int) -> tuple[packed.Held, np.ndarray]:
    """The rows of a task, and their scores under the models of the stage before."""
    parts: dict[str, list[np.ndarray]] = {n: [] for n in ("key", "y", "fold", "codes", "margins")}
    kinds = {"key": np.int64, "y": np.uint8, "fold": np.int32, "codes": np.uint16, "margins": np.float64}
    wide = {"codes": (len(layout.columns) + 1) // 2, "margins": before}
    for batch in batches:
        for n, found in parts.items():
            for value in batch.column(n).to_pylist() if wide.get(n, 1) else ():
                own = np.frombuffer(value, dtype=kinds[n])
                found.append(own.reshape(wide[n], -1) if n in wide else own)
    empty = {n: np.zeros((wide[n], 0) if n in wide else 0, dtype=kind) for n, kind in kinds.items()}
    key, y, fold, codes, margins = (np.concatenate([empty[n], *parts.pop(n)], axis=-1) if parts[n] else empty[n] for n in list(parts))
    return packed.Held(key, y, fold, None, layout.spans, layout.missing, codes), margins


class Exchange:
    """Sums of all tasks of a stage, through files in a folder that all of them reach.

    Spark's own gathering lets every call wait for a second. A file is gone once
    all tasks must have read it: when they have written the one after the next.
    """

    def __init__(self, folder: str, spans: np.ndarray):
        context = BarrierTaskContext.get()
        self.me, self.n, self.spans, self.step = context.partitionId(), len(context.getTaskInfos()), spans, 0
        self.folder = f"{folder}/{context.allGather(uuid.uuid4().hex)[0]}"  # another one for every attempt
        os.makedirs(self.folder, exist_ok=True)

    def _name(self, step: int, task: int) -> str:
        return f"{self.folder}/{step}-{task}"

    def _gathered(self, own: np.ndarray) -> Iterator[np.ndarray]:
        """The array of each task, in the order of tasks."""
        name = self._name(self.step, self.me)
        with open(f"{name}.new", "wb") as file:
            file.write(own.data)
        os.replace(f"{name}.new", name)
        for task in range(self.n):
            pause = _PAUSE
            while task != self.me and not os.path.exists(self._name(self.step, task)):
                time.sleep(pause)
                pause = min(2 * pause, _LONGEST_PAUSE)
            yield own if task == self.me else np.fromfile(self._name(self.step, task)).reshape(own.shape)
        if self.step > 1:
            os.remove(self._name(self.step - 2, self.me))
        self.step += 1

    def added(self, sums: np.ndarray, allowed: np.ndarray) -> np.ndarray:
        """The sums of all tasks, added up in the same order in each; others than those of ``allowed`` features are 0."""
        used = allowed.copy()
        used[0] = True  # whose bins give the sums of whole nodes
        places = np.flatnonzero(np.repeat(used, np.diff(self.spans)))
        own = np.ascontiguousarray(sums[:, places])
        total = np.zeros_like(own)
        for part in self._gathered(own):
            total += part
        out = np.zeros_like(sums)
        out[:, places] = total
        return out


def grow_stage(rows: DataFrame, models: Sequence[base.Model], before: Sequence[int], rounds: int, keep: bool, layout: packed.Layout, tasks: int, folder: str) -> DataFrame:
    """A block of rounds of all ``models``: their new trees, scores of left-out rows under every new prefix, and, to ``keep``, the rows.

    ``before`` are the numbers of the models whose scores are stored with ``rows``. Sums go through ``folder``.
    """
    own = [base.Model(m.number, m.settings, m.leaves_out, m.seed, [None] * len(m.trees)) for m in models]  # old trees are in the scores
    before = list(before)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, margins = _read(batches, layout, len(before))
        exchange, kept = Exchange(folder, layout.spans), []
        for model in own:
            margin = margins[before.index(model.number)].copy() if model.number in before else np.zeros(len(held.y))
            out, done = np.flatnonzero(held.fold == model.leaves_out), len(model.trees)
            for _ in range(min(rounds, model.settings.rounds - done)):
                tree, leaves = packed.grow_tree(model, held, margin, exchange.added)
                model.trees.append(tree)
                packed.add_scores(margin, tree, leaves)
                if model.settings.patience is not None:
                    yield _batch(kind="scores", number=model.number, prefix=len(model.trees), y=held.y.take(out), margins=margin.take(out))
            if exchange.me == 0:
                yield _batch(kind="trees", number=model.number, text=json.dumps([asdict(t) for t in model.trees[done:]]))
            kept.append(margin)
        for at in range(0, len(held.y) if keep else 0, _BLOCK):
            here = slice(at, at + _BLOCK)
            yield _batch(
                kind="rows", key=held.key[here], y=held.y[here], fold=held.fold[here], codes=held.codes[:, here],
                margins=np.stack([margin[here] for margin in kept]),
            )

    return rows.repartition(tasks).mapInArrow(task, _SCHEMA, barrier=True)


def prefix_areas(scores: DataFrame) -> dict[tuple[int, int], float | None]:
    """Area under the precision-recall curve of each model and prefix."""

    def area(group: pa.Table) -> pa.Table:
        y = np.concatenate([np.frombuffer(v, dtype=np.uint8) for v in group.column("y").to_pylist()]).astype(float)
        score = np.concatenate([np.frombuffer(v) for v in group.column("margins").to_pylist()])
        found = group.select(["number", "prefix"]).slice(0, 1)
        return found.append_column("area", pa.array([base.average_precision(y, score)], pa.float64()))

    judged = scores.select("number", "prefix", "y", "margins").groupBy("number", "prefix").applyInArrow(area, "number int, prefix int, area double")
    return {(r["number"], r["prefix"]): r["area"] for r in judged.collect()}  # a row per prefix


def grow_dealt(narrow: DataFrame, models: Sequence[base.Model], cuts: Sequence[Sequence[float]], layout: packed.Layout, tasks: int, block_rounds: int) -> None:
    """All trees of all models; ``narrow`` has key, label, fold and values."""
    spark = narrow.sparkSession

    def stored(df: DataFrame) -> tuple[str, DataFrame]:
        path = run_folder(spark, "dealt")
        df.write.parquet(path)
        return path, spark.read.schema(df.schema).parquet(path)

    path, table = stored(pack(narrow, cuts, layout))
    waiting, active, before = list(models), [], []
    while True:
        active = [m for m in active if not m.finished()]
        while waiting and len(active) < GROUP:
            active += [m for m in [waiting.pop(0)] if not m.finished()]
        if not active:
            break
        judged = [m for m in active if m.settings.patience is not None]
        rounds = block_rounds if judged else max(block_rounds, SAVED_ROUNDS)
        keep = bool(waiting or judged) or any(m.settings.rounds - len(m.trees) > rounds for m in active)
        old, sums = path, run_folder(spark, "sums")
        path, table = stored(grow_stage(table.where("kind = 'rows'"), active, before, rounds, keep, layout, tasks, urlsplit(sums).path))
        for done in (old, sums):  # what is stored since has all of it
            discard(spark, done)
        for row in table.where("kind = 'trees'").select("number", "text").collect():  # a row per model
            models[row["number"]].trees += [base.Tree(**t) for t in json.loads(row["text"])]
        if judged:
            areas = prefix_areas(table.where("kind = 'scores'"))
            for m in judged:
                m.areas += [areas.get((m.number, n)) for n in range(len(m.areas) + 1, len(m.trees) + 1)]
        before = [m.number for m in active]
    discard(spark, path)
