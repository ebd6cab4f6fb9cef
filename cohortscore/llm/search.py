"""Ranked lexical search with MaxScore and bounds of term pairs.

Items (the queries) are taken in blocks with a bounded number of terms. For a
block, one pass over the documents keeps of each the number of its terms and
the occurrences of the block's terms. From that an index in segments of a fixed
number of documents is built and stored: a posting list per term with its
largest impact, and for pairs of terms that follow each other in an item, in
order of weight, the intersection list with the largest impact of both
together.

A segment answers an item from its best terms down. What the terms not yet
looked at can add to any document is bounded by the cheapest cover of them by
single maxima and joint maxima of pairs. Once that is below the item's tenth best
score so far, no new document can enter, so the other lists are only looked up for
the candidates that still can. Each task keeps its tenth best scores from
segment to segment.

Scores are 64-bit integers and each list is exact, so results do not depend on
how documents are cut into segments.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortscore.session import settle

#: Terms are runs of ASCII letters and digits and of all characters beyond ASCII.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TOP = 10
#: Items of a block have this many terms together at most, or are alone in it.
BLOCK_TERMS = 200_000
#: Documents of an index segment.
SEGMENT_DOCS = 8192

_TERM_BYTES = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_FORWARD = "doc_id long, n long, terms array<int>, tf array<int>"
_SEGMENT = (
    "docs array<long>, terms array<int>, ends array<int>, postings array<int>, impacts array<long>, most array<long>, "
    "pair_a array<int>, pair_b array<int>, pair_ends array<int>, pair_postings array<int>, pair_most array<long>"
)


def text_terms(text: str | None) -> list[bytes]:
    """Terms of a text in order, A-Z lower-cased, as UTF-8."""
    return _TERM_BYTES.findall((text or "").encode("utf-8", "surrogatepass").lower())


def item_blocks(items: DataFrame, id_column: str, text_column: str, block_terms: int) -> Iterator[list[tuple]]:
    """The items (id, distinct terms) in blocks of bounded size, read one after another."""
    block, size = [], 0
    for row in items.select(F.col(f"`{id_column}`").alias("i"), F.col(f"`{text_column}`").alias("t")).toLocalIterator():
        terms = sorted(set(text_terms(row.t)))
        if block and size + len(terms) > block_terms:
            yield block
            block, size = [], 0
        block.append((row.i, terms))
        size += len(terms)
    if block:
        yield block


def forward_lists(docs: DataFrame, numbers: Broadcast, id_column: str, text_column: str) -> DataFrame:
    """Of each document its terms' number ``n``, and the numbers and occurrences of the terms in ``numbers``."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = numbers.value
        for batch in batches:
            ns, terms, tfs = [], [], []
            for text in batch.column(1):
                found = text_terms(text.as_py())
                counts = Counter(found)
                hits = sorted((known[t], counts[t]) for t in counts.keys() & known.keys())
                ns.append(len(found))
                terms.append([h[0] for h in hits])
                tfs.append([h[1] for h in hits])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ns, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int32()))],
                names=["doc_id", "n", "terms", "tf"],
            )

    narrow = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{text_column}`").alias("text"))
    return narrow.mapInArrow(task, _FORWARD)


def impacts(tf: np.ndarray, n: np.ndarray, weight: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What an occurrence count adds to a document's score, in 64-bit integers."""
    m = np.array([10 + 90 * int(x) * n_docs // n_terms for x in np.unique(n)], dtype=np.int64)
    m = m[np.searchsorted(np.unique(n), n)]
    return weight * (1_000_000_000 * tf // (1000 * tf + 8 * m))


def item_order(terms: list[int], weights: np.ndarray) -> list[int]:
    """An item's terms by weight, frequent ones first."""
    return sorted(terms, key=lambda t: (weights[t], t))


def build_segments(forward: DataFrame, plan: Broadcast, segment_docs: int) -> DataFrame:
    """One row per segment: documents, posting lists and pair lists, of at most ``segment_docs`` documents."""
    schema = pa.schema(
        [("docs", pa.list_(pa.int64())), ("terms", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32()))]
        + [("postings", pa.list_(pa.int32())), ("impacts", pa.list_(pa.int64())), ("most", pa.list_(pa.int64()))]
        + [("pair_a", pa.list_(pa.int32())), ("pair_b", pa.list_(pa.int32())), ("pair_ends", pa.list_(pa.int32()))]
        + [("pair_postings", pa.list_(pa.int32())), ("pair_most", pa.list_(pa.int64()))]
    )

    def segment(part: pa.Table) -> pa.RecordBatch:
        weights, pairs, n_docs, n_terms = (plan.value[k] for k in ("weights", "pairs", "n_docs", "n_terms"))
        lists = part.column("terms").combine_chunks()
        lengths = np.diff(lists.offsets.to_numpy())
        terms = lists.flatten().to_numpy()
        tf = part.column("tf").combine_chunks().flatten().to_numpy().astype(np.int64)
        at = np.repeat(np.arange(part.num_rows, dtype=np.int32), lengths)
        n = part.column("n").to_numpy()[at]
        order = np.argsort(terms, kind="stable")
        terms, at = terms[order], at[order]
        gain = impacts(tf[order], n[order], weights[terms], n_docs, n_terms)
        present, starts = np.unique(terms, return_index=True)
        ends = np.append(starts[1:], len(terms))
        most = np.maximum.reduceat(gain, starts) if len(starts) else np.zeros(0, np.int64)
        place = {t: (s, e) for t, s, e in zip(present.tolist(), starts.tolist(), ends.tolist())}
        met, pair_ends, pair_most = [], [], []
        both = [(a, b) for a, b in pairs if a in place and b in place]
        for a, b in both:
            (s, e), (u, v) = place[a], place[b]
            _, i, j = np.intersect1d(at[s:e], at[u:v], assume_unique=True, return_indices=True)
            met.append(at[s:e][i])
            pair_ends.append(len(i))
            pair_most.append(int((gain[s:e][i] + gain[u:v][j]).max()) if len(i) else 0)
        values = [
            part.column("doc_id").to_pylist(), present, ends, at, gain, most,
            [a for a, _ in both], [b for _, b in both], np.cumsum(pair_ends, dtype=np.int64),
            np.concatenate(met) if met else [], pair_most,
        ]
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema)], schema=schema)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, rows = [], 0
        for batch in batches:
            while rows + batch.num_rows >= segment_docs:
                take = segment_docs - rows
                yield segment(pa.Table.from_batches([*waiting, batch.slice(0, take)]))
                batch, waiting, rows = batch.slice(take), [], 0
            if batch.num_rows:
                waiting.append(batch)
                rows += batch.num_rows
        if rows:
            yield segment(pa.Table.from_batches(waiting))

    return forward.mapInArrow(task, _SEGMENT)


class Segment:
    """A segment of the index, read from its row."""

    def __init__(self, row: dict[str, np.ndarray]):
        self.docs: pa.Array = row["docs"]
        ends = row["ends"].tolist()
        spans = zip([0, *ends], ends, row["most"].tolist())
        self.lists = {
            t: (row["postings"][s:e], row["impacts"][s:e], most) for t, (s, e, most) in zip(row["terms"].tolist(), spans)
        }
        #: Largest joint impact of pairs; a pair that never meets is bounded by the larger of the two.
        self.pairs = dict(zip(zip(row["pair_a"].tolist(), row["pair_b"].tolist()), row["pair_most"].tolist()))

    def bounds(self, terms: list[int]) -> list[int]:
        """For each k, what the first k terms can add to a document at most: the cheapest cover by terms and pairs."""
        most = [self.lists[t][2] for t in terms]
        best = [0]
        for k, t in enumerate(terms):
            bound = best[k] + most[k]
            joint = self.pairs.get((terms[k - 1], t)) if k else None
            if joint is not None:
                bound = min(bound, best[k - 1] + max(joint, most[k - 1], most[k]))
            best.append(bound)
        return best

    def answer(self, terms: list[int], top: int, floor: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Documents (their places) and scores that may be among the best ``top``, and how many postings were read.

        ``floor`` is a score that ``top`` documents elsewhere reach; lower ones are left out.
        """
        terms = [t for t in terms if t in self.lists]
        bounds, read = self.bounds(terms), 0
        scores = np.zeros(len(self.docs), dtype=np.int64)
        alive = np.zeros(0, dtype=np.int64)
        for k in range(len(terms) - 1, -1, -1):
            places, gain, _ = self.lists[terms[k]]
            if bounds[k + 1] >= floor:
                # A document with none of the terms so far may still enter.
                scores[places] += gain
                read += len(places)
                alive = np.flatnonzero(scores)
            else:
                alive = alive[scores[alive] + bounds[k + 1] >= floor]
                if not len(alive):
                    break
                at = np.minimum(np.searchsorted(places, alive), len(places) - 1)
                hit = places[at] == alive
                scores[alive[hit]] += gain[at[hit]]
                read += len(alive)
            if len(alive) >= top:
                floor = max(floor, int(np.partition(scores[alive], len(alive) - top)[len(alive) - top]))
        alive = alive[scores[alive] >= max(floor, 1)]
        return alive, scores[alive], read


def best_rows(ids: list, scores: np.ndarray, top: int) -> list[int]:
    """Places of the ``top`` best: by score, then by id, null ids last."""
    order = sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i] is None, ids[i] or 0))
    return order[:top]


def search_segments(segments: DataFrame, plan: Broadcast, top: int) -> DataFrame:
    """item, doc_id, score: the best ``top`` documents of each task for each item of the block."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = plan.value["items"]
        best: list[tuple[list, list[int]]] = [([], []) for _ in items]
        for batch in batches:
            for r in range(batch.num_rows):
                row = {
                    name: batch.column(c)[r].values if name == "docs" else batch.column(c)[r].values.to_numpy()
                    for c, name in enumerate(batch.schema.names)
                }
                segment = Segment(row)
                for i, terms in enumerate(items):
                    ids, scores = best[i]
                    places, found, _ = segment.answer(terms, top, scores[-1] if len(scores) == top else 0)
                    if len(places):
                        ids = ids + segment.docs.take(pa.array(places)).to_pylist()
                        scores = scores + found.tolist()
                        order = best_rows(ids, scores, top)
                        best[i] = [ids[o] for o in order], [scores[o] for o in order]
        flat = [(i, d, s) for i, (ids, scores) in enumerate(best) for d, s in zip(ids, scores)]
        columns = list(zip(*flat)) if flat else [(), (), ()]
        kinds = (pa.int32(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["item", "doc_id", "score"])

    return segments.mapInArrow(task, "item int, doc_id long, score long")


def rank_documents(
    docs: DataFrame,
    items: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    top: int = TOP,
    block_terms: int = BLOCK_TERMS,
    segment_docs: int = SEGMENT_DOCS,
) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: each item's ``top`` best documents with a score above 0.

    A term's weight is floor(1000 ln((2N+2)/(2df+1))) for N documents with a
    term, of which df have it. With n terms in a document and L in all, m is
    10 + 90 n N div L; a term that occurs tf times adds
    weight * (10^9 tf div (1000 tf + 8 m)). Equal scores go by ascending
    doc_id, null ids last. Null and empty texts have no terms; items without a
    known term have no rows. Repeated rows are documents, or items, of their
    own. Columns other than ids and texts are ignored. Empty tables give no rows.

    Each block of items reads the documents once. The driver holds the terms
    of one block; what a task holds is bounded by ``segment_docs``.
    """
    spark = docs.sparkSession
    kind = items.schema[item_column].dataType.simpleString()
    answers = []
    for block in item_blocks(items, item_column, item_text_column, block_terms):
        vocabulary = {t: k for k, t in enumerate(sorted({t for _, terms in block for t in terms}))}
        forward = settle(forward_lists(docs, spark.sparkContext.broadcast(vocabulary), id_column, text_column))
        total = forward.agg(F.sum((F.col("n") > 0).cast("long")).alias("n_docs"), F.sum("n").alias("n_terms")).first()
        if not total.n_terms:
            continue
        counted = forward.select(F.explode("terms").alias("t")).groupBy("t").count().toArrow()
        df = np.zeros(len(vocabulary), dtype=np.int64)
        df[counted.column("t").to_numpy()] = counted.column("count").to_numpy()
        weights = np.floor(1000 * np.log((2.0 * total.n_docs + 2) / (2.0 * df + 1))).astype(np.int64)
        ordered = [item_order([vocabulary[t] for t in terms], weights) for _, terms in block]
        pairs = sorted({pair for terms in ordered for pair in zip(terms, terms[1:])})
        plan = spark.sparkContext.broadcast(
            {"weights": weights, "items": ordered, "pairs": pairs, "n_docs": total.n_docs, "n_terms": total.n_terms}
        )
        found = search_segments(settle(build_segments(forward, plan, segment_docs)), plan, top)
        names = spark.createDataFrame([(k, item) for k, (item, _) in enumerate(block)], f"item int, item_id {kind}")
        one = W.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = found.select("*", F.row_number().over(one).alias("rank")).where(F.col("rank") <= top)
        answers.append(ranked.join(names, "item").select("item_id", "rank", "doc_id", "score"))
    if not answers:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    return settle(reduce(DataFrame.unionAll, answers)) if len(answers) > 1 else answers[0]
