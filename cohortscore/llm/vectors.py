"""Near duplicates among embeddings by cross-polytope hashing.

A vector is rotated by random signs and fast Hadamard transforms; the axis it
is closest to, with its sign, is a hash. Each table has ``HASHES`` rotations,
whose axes together make a bucket, and a vector also goes to the buckets it
nearly fell into (multiprobe). Buckets that are shared give candidate pairs,
and each is verified by its cosine in double precision.

A vector carries all its buckets with it. A pair is counted only in the least
bucket that both share, so numbers of links add up over tables without a table
of pairs; for the components a bucket returns links that connect what it found,
not all pairs. A crowded bucket is cut into blocks that meet in pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortscore.llm.graph import components
from cohortscore.llm.simhash import Groups
from cohortscore.llm.substrings import mixed
from cohortscore.session import settle

COSINE = 0.9
TABLES, HASHES, PROBES, SEED = 10, 3, 4, 17
#: Rotations are rounds of signs and a Hadamard transform.
ROUNDS = 3
#: Vectors of a block in a crowded bucket, about.
BLOCK = 1_000


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row, whose length is a power of two."""
    n, half = x.shape[1], 1
    while half < n:
        x = x.reshape(len(x), -1, 2, half)
        x = np.stack((x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]), axis=2)
        half *= 2
    return x.reshape(len(x), n)


def rotations(width: int, tables: int, hashes: int, seed: int) -> np.ndarray:
    """Random signs [table, hash, round, coordinate]."""
    return np.random.default_rng(seed).choice((-1.0, 1.0), size=(tables, hashes, ROUNDS, width))


def buckets_of(vectors: np.ndarray, signs: np.ndarray, probes: int) -> np.ndarray:
    """Bucket numbers [row, table x probe] of unit vectors, the row's own bucket first in each table.

    Further probes replace axes by the next best ones, in the order of what is
    lost by that.
    """
    tables, hashes, _, width = signs.shape
    padded = np.zeros((len(vectors), width))
    padded[:, : vectors.shape[1]] = vectors
    out = np.empty((len(vectors), tables, probes), dtype=np.int64)
    rows = np.arange(len(vectors))[:, None]
    near = min(probes, 2 * width)
    # No other choice of ranks can be among the best: all choices below it are better.
    grid = [g for g in product(range(near), repeat=hashes) if np.prod(np.array(g) + 1) <= probes]
    for t in range(tables):
        code = np.full((len(vectors), len(grid)), t, dtype=np.int64)
        loss = np.zeros((len(vectors), len(grid)))
        for k in range(hashes):
            x = padded
            for flip in signs[t, k]:
                x = hadamard(x * flip)
            both = np.concatenate((x, -x), axis=1)
            best = np.argsort(-both, axis=1, kind="stable")[:, :near]
            value = both[rows, best]
            rank = [g[k] for g in grid]
            code = code * (2 * width) + best[:, rank]
            loss += value[:, :1] - value[:, rank]
        out[:, t, :] = code[rows, np.argsort(loss, axis=1, kind="stable")[:, :probes]]
    return out.reshape(len(vectors), -1)


def _hash_task(tables: int, hashes: int, probes: int, seed: int):
    """Task over (vec_id, vec): (vec_id, vec of unit length as doubles in bytes, buckets); vectors that can't link have no bucket."""
    schema = pa.schema([("vec_id", pa.int64()), ("vec", pa.binary()), ("buckets", pa.list_(pa.int64()))])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signs: dict[int, np.ndarray] = {}
        for batch in batches:
            by_length: dict[int, list[tuple[int, np.ndarray]]] = {}
            rows: list[tuple] = []
            for vec_id, vec in zip(*(batch.column(i).to_pylist() for i in range(2))):
                if not vec or None in vec:
                    rows.append((vec_id, None, []))
                    continue
                x = np.array(vec, dtype=np.float64)
                top = np.abs(x).max()
                if not np.isfinite(top) or top == 0:
                    rows.append((vec_id, None, []))
                    continue
                x = x / top  # so that squares neither vanish nor overflow
                by_length.setdefault(len(x), []).append((vec_id, x / np.sqrt(x @ x)))
            for length, found in by_length.items():
                width = max(2, 1 << (length - 1).bit_length())
                if width not in signs:
                    signs[width] = rotations(width, tables, hashes, seed)
                unit = np.array([x for _, x in found])
                # Vectors of other lengths get other buckets.
                codes = mixed(mixed(buckets_of(unit, signs[width], probes).view(np.uint64)) + np.uint64(length)).view(np.int64)
                rows += [(i, x.tobytes(), c) for (i, _), x, c in zip(found, unit, codes.tolist())]
            for at in range(0, len(rows), 2_000):
                columns = zip(*rows[at : at + 2_000])
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return task


def _pairs_task(cosine: float, dots_at_once: int = 2_000_000):
    """Task over (bucket, left, right), lists of (class_id, size, vec, buckets): (class_id, links, linked_to)."""
    schema = pa.schema([("class_id", pa.int64()), ("links", pa.int64()), ("linked_to", pa.int64())])

    def side(members: pa.StructArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        n = len(members)
        ids, sizes = (members.field(k).to_numpy() for k in ("class_id", "size"))
        unit = np.frombuffer(b"".join(members.field("vec").to_pylist())).reshape(n, -1)
        return ids, sizes, unit, members.field("buckets").flatten().to_numpy().reshape(n, -1)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                bucket = batch.column(0)[row].as_py()
                left, right = (batch.column(i)[row].values for i in (1, 2))
                same = not len(right)
                if not len(left) or (same and len(left) < 2):
                    continue
                a = side(left)
                b = a if same else side(right)
                ids = a[0] if same else np.concatenate((a[0], b[0]))
                groups = Groups(len(ids))
                shift = 0 if same else len(a[0])
                counts = np.zeros(len(ids), dtype=np.int64)
                step = max(1, dots_at_once // len(b[0]))
                for at in range(0, len(a[0]), step):
                    close = a[2][at : at + step] @ b[2].T >= cosine
                    if same:
                        close &= np.arange(len(b[0])) > np.arange(at, min(at + step, len(a[0])))[:, None]
                    i, j = np.nonzero(close)
                    for part in range(0, len(i), 20_000):
                        p, q = i[part : part + 20_000] + at, j[part : part + 20_000]
                        # Of the buckets that both share, this must be the least.
                        own = a[3][p]
                        shared = (own[:, :, None] == b[3][q][:, None, :]).any(axis=2)
                        mine = np.where(shared, own, np.iinfo(np.int64).max).min(axis=1) == bucket
                        p, q = p[mine], q[mine]
                        np.add.at(counts, p, b[1][q])
                        np.add.at(counts, q + shift, a[1][p])
                        # Links for the components: each left member's partners hang together.
                        heads, starts = np.unique(p, return_index=True)
                        for head, some in zip(heads, np.split(q, starts[1:])):
                            groups.join(np.append(some + shift, head))
                roots = groups.roots(np.arange(len(ids)))
                hit = np.flatnonzero(counts)
                if len(hit):
                    arrays = (ids[hit], counts[hit], ids[roots[hit]])
                    yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(arrays, schema)], schema=schema)

    return task


def near_vectors(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    cosine: float = COSINE,
    tables: int = TABLES,
    hashes: int = HASHES,
    probes: int = PROBES,
    seed: int = SEED,
    block: int = BLOCK,
) -> DataFrame:
    """One row per input row: vec_id, n_links, component_id, kept.

    Two vectors of equal length link if their cosine in double precision is
    ``cosine`` or more and they share a bucket; equal vectors always do.
    n_links counts other rows linked directly, component_id is the smallest
    vec_id reachable, kept says that it is the row's own.

    Each further hash divides a bucket by twice the width, so ``hashes`` should
    grow with the logarithm of the rows, and ``tables`` or ``probes`` with it to
    keep the recall; ``block`` bounds a task's memory.

    Vectors that are null, empty or zero, or that hold null, NaN or infinity,
    link with nothing. So do rows without vec_id, whose component_id is null and
    which are kept. Rows that repeat vec_id and vector are copies of each other
    and count as links. Other columns are ignored, an empty table gives no rows.
    """
    rows = vectors.select(
        F.col(f"`{id_column}`").cast("long").alias("vec_id"),
        F.col(f"`{vector_column}`").cast("array<double>").alias("vec"),
    )
    hashed = settle(
        rows.where(F.col("vec_id").isNotNull()).mapInArrow(
            _hash_task(tables, hashes, probes, seed), "vec_id long, vec binary, buckets array<long>"
        )
    )
    linkable = hashed.where(F.col("vec").isNotNull())
    # Vectors that are equal after scaling are one class.
    classes = settle(
        linkable.groupBy("vec").agg(
            F.min("vec_id").alias("class_id"), F.count(F.lit(1)).alias("size"), F.first("buckets").alias("buckets")
        )
    )
    placed = classes.select("class_id", F.explode(F.array_distinct("buckets")).alias("bucket"))
    crowded = placed.groupBy("bucket").count().where("count > 1")
    crowded = crowded.select("bucket", F.ceil(F.col("count") / F.lit(block)).cast("int").alias("parts"))
    own = F.pmod(F.xxhash64("class_id"), F.col("parts")).cast("int")
    met = placed.join(crowded, "bucket").select(
        "class_id", "bucket", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    )
    meetings = met.select(
        "class_id", "bucket", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")
    ).join(classes, "class_id")
    member = F.struct("class_id", "size", "vec", "buckets")
    cells = meetings.groupBy("bucket", "i", "j").agg(
        F.collect_list(F.when(F.col("own") == F.col("i"), member)).alias("left"),
        F.collect_list(F.when(F.col("own") != F.col("i"), member)).alias("right"),
    )
    # A cell of two different blocks with one of them empty has nothing to compare.
    cells = cells.where((F.col("i") == F.col("j")) | (F.size("right") > 0))
    found = settle(
        cells.select("bucket", "left", "right").mapInArrow(
            _pairs_task(cosine), "class_id long, links long, linked_to long"
        )
    )
    links = found.groupBy("class_id").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("class_id").alias("a"), F.col("linked_to").alias("b")))
    result = (
        classes.select("class_id", "size", "vec")
        .join(links, "class_id", "left")
        .join(roots.withColumnRenamed("node", "class_id"), "class_id", "left")
        .select(
            "vec",
            (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component", "class_id").alias("component_id"),
        )
    )
    known = hashed.select("vec_id", "vec").join(result, "vec", "left")
    found_rows = known.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id")
    )
    rest = rows.where(F.col("vec_id").isNull()).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return found_rows.unionAll(rest).select(
        "vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept")
    )
