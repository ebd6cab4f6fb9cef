"""Near duplicates by SimHash fingerprints and BK-trees.

Equal fingerprints are one class. Classes within the radius are linked through
shards: the 64 bits are cut into blocks, and fingerprints that differ in at
most ``radius`` bits agree in at least ``blocks - radius`` of them, so both are
in the shard of each such choice of blocks. A shard is searched by a BK-tree,
whose children are keyed by their Hamming distance to the parent; a query
follows only edges within the radius of its own distance.

Trees are built where their shard is: all fingerprints together have no size
bound, so they are shuffled and never broadcast. A shard above ``TREE_SIZE``
members is cut into several trees, each searched by all the shard's members.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortscore.llm.common import packed, unpacked
from cohortscore.llm.graph import components
from cohortscore.operators.keys import lookup_join
from cohortscore.session import settle

SHINGLE_WORDS = 4
RADIUS = 4
BLOCKS = 6
#: Members of one BK-tree, about.
TREE_SIZE = 4096
#: Shingles hashed at a time, which bounds memory for very long texts.
_CHUNK = 65_536


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """64 bits: each is 1 if set in over half of the shingles' XXH64 (seed 42); no word gives 0."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), dtype=np.int64, count=len(found)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    take = min(words, len(found))
    starts, ends = starts[: len(found) - take + 1], ends[take - 1 :]
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(starts), _CHUNK):
        spans = zip(starts[at : at + _CHUNK].tolist(), ends[at : at + _CHUNK].tolist())
        hashes = np.array([digest(joined[a:b], 42) for a, b in spans], dtype=np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * counts > len(starts), bitorder="little").view(np.uint64)[0])


@F.pandas_udf(T.LongType())
def fingerprints(texts: pd.Series) -> pd.Series:
    return pd.Series(np.array([fingerprint(t) for t in texts], dtype=np.uint64).astype(np.int64))


def block_masks(blocks: int = BLOCKS, radius: int = RADIUS) -> list[int]:
    """For each choice of blocks that can agree, the mask of their bits, as signed longs."""
    if not 0 <= radius < blocks <= 64:
        raise ValueError("blocks must be more than the radius and at most 64")
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    one = [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:])]
    masks = [sum(one[i] for i in chosen) for chosen in combinations(range(blocks), blocks - radius)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


class Groups:
    """Union-find over positions, with whole arrays at a time."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self, x: np.ndarray) -> np.ndarray:
        up = self.parent[x]
        while True:
            further = self.parent[up]
            if (further == up).all():
                self.parent[x] = up
                return up
            up = further

    def join(self, x: np.ndarray) -> None:
        roots = np.unique(self.roots(x))
        self.parent[roots] = roots[0]


def tree_links(points: np.ndarray, tree: np.ndarray, queries: np.ndarray, radius: int, groups: Groups) -> None:
    """Join each query with all tree members within the radius.

    The BK-tree is built as it is searched: the first member is the node, the
    others fall to the child of their distance, and of the queries those whose
    own distance is within the radius of that go along.
    """
    todo = [(tree, queries)]
    while todo:
        members, asking = todo.pop()
        node = members[0]
        away = np.bitwise_count(points[asking] ^ points[node])
        near = asking[away <= radius]
        if len(near):
            groups.join(np.append(near, node))
        rest = members[1:]
        if not len(rest):
            continue
        edge = np.bitwise_count(points[rest] ^ points[node])
        for distance in np.flatnonzero(np.bincount(edge)).tolist():
            follow = asking[np.abs(away.astype(np.int16) - distance) <= radius]
            if len(follow):
                todo.append((rest[edge == distance], follow))


def shard_links(tree: np.ndarray, others: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links (member, first member of its group) that connect all members within the radius."""
    if len(tree) + len(others) == 2:
        a, b = [*tree.tolist(), *others.tolist()]
        return [(a, b)] if ((a ^ b) & (2**64 - 1)).bit_count() <= radius else []
    both = np.concatenate([tree, others])
    points = both.view(np.uint64)
    groups = Groups(len(both))
    tree_links(points, np.arange(len(tree)), np.arange(len(both)), radius, groups)
    roots = groups.roots(np.arange(len(both)))
    moved = np.flatnonzero(roots != np.arange(len(both)))
    return list(zip(both[moved].tolist(), both[roots[moved]].tolist()))


def radius_links(
    prints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, tree_size: int = TREE_SIZE
) -> DataFrame:
    """Links (a, b) between the distinct longs ``fingerprint`` of ``prints`` that connect all within the radius.

    Not every pair is returned: in each tree, members that hang together link
    to one of them. Components are those of all pairs, whatever ``blocks`` and
    ``tree_size`` are; with more blocks shards are more and smaller, as wanted
    for more fingerprints.
    """
    fp = F.col("fingerprint")
    shards = F.explode(
        F.array(*[F.struct(F.lit(t).alias("t"), fp.bitwiseAND(F.lit(m)).alias("key")) for t, m in enumerate(block_masks(blocks, radius))])
    )
    placed = prints.select("fingerprint", shards.alias("s")).select("fingerprint", "s.t", "s.key")
    shared = placed.groupBy("t", "key").count().where("count > 1")
    parts = F.ceil(F.col("count") / F.lit(tree_size)).cast("int")
    own = F.pmod(F.xxhash64("fingerprint"), F.col("parts")).cast("int")
    members = placed.join(shared.select("t", "key", parts.alias("parts")), ["t", "key"]).select("*", own.alias("own"))
    meetings = members.select(
        "t", "key", "fingerprint", "own", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    ).select("t", "key", "fingerprint", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    trees = meetings.groupBy("t", "key", "i", "j").agg(
        F.collect_list(F.when(F.col("own") == F.col("i"), fp)).alias("tree"),
        F.collect_list(F.when(F.col("own") != F.col("i"), fp)).alias("others"),
    )

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for tree, others in zip(batch.column(0), batch.column(1)):
                if len(tree.values):
                    sides = [np.asarray(side.values.to_numpy(zero_copy_only=False), dtype=np.int64) for side in (tree, others)]
                    found += shard_links(*sides, radius)
            a, b = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return trees.select("tree", "others").mapInArrow(link, "a long, b long")


def class_groups(prints: DataFrame, links: DataFrame) -> DataFrame:
    """fingerprint, component_id (smallest doc_id reachable) of rows (doc_id, fingerprint) by links of fingerprints."""
    classes = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id"))
    roots = components(links)
    placed = settle(
        classes.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").select(
            "fingerprint", "first_id", F.coalesce("component", "fingerprint").alias("component")
        )
    )
    # One component may hold very many fingerprints.
    least = settle(placed.groupBy("component").agg(F.min("first_id").alias("component_id")))
    return lookup_join(placed, least, ["component"]).select("fingerprint", "component_id")


def _groups(prints: DataFrame, radius: int, blocks: int, tree_size: int) -> DataFrame:
    return class_groups(prints, radius_links(prints.select("fingerprint").distinct(), radius, blocks, tree_size))


def keep_firsts(columns: list[str], rows: DataFrame, prints: DataFrame, groups: DataFrame) -> DataFrame:
    """Of packed ``rows`` one with the smallest doc_id of each group, with the packed columns."""
    firsts = prints.join(groups, "fingerprint").where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    # Rows that share the smallest id may have several fingerprints; the least of them stays.
    least = firsts.groupBy("component_id").agg(F.min("fingerprint").alias("fp"))
    kept = rows.join(
        least, F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("fingerprint") == F.col("fp"))
    )
    order = F.xxhash64(*[F.col("_row").getField(c).cast("string") for c in columns])
    one = W.partitionBy("doc_id", "fingerprint").orderBy(order)
    return unpacked(kept.select("*", F.row_number().over(one).alias("_nth")).where("_nth = 1"))


def near_groups(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    radius: int = RADIUS,
    blocks: int = BLOCKS,
    tree_size: int = TREE_SIZE,
) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id.

    Fingerprints link at ``radius`` or fewer differing bits; component_id is the
    smallest doc_id reachable, itself included. Null, empty and blank texts
    have fingerprint zero, which is linked like any other; texts of fewer than
    four words are one shingle. A null doc_id is never a component_id unless a
    component has no other. Repeated rows and ids are kept, other columns are
    ignored, an empty table gives no rows.
    """
    text = F.col(f"`{text_column}`")
    prints = settle(docs.select(F.col(f"`{id_column}`").alias("doc_id"), fingerprints(text).alias("fingerprint")))
    groups = _groups(prints, radius, blocks, tree_size)
    return prints.join(groups, "fingerprint").select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id"
    )


def drop_near_copies(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    radius: int = RADIUS,
    blocks: int = BLOCKS,
    tree_size: int = TREE_SIZE,
) -> DataFrame:
    """The rows of ``docs`` with the smallest doc_id of their component, one of each, with all columns.

    Cases as in ``near_groups``; where rows repeat that doc_id, one stays.
    """
    rows = settle(
        packed(docs, F.col(f"`{id_column}`").alias("doc_id"), fingerprints(F.col(f"`{text_column}`")).alias("fingerprint"))
    )
    prints = rows.select("doc_id", "fingerprint")
    return keep_firsts(docs.columns, rows, prints, _groups(prints, radius, blocks, tree_size))
