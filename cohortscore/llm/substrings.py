"""Removal of repeated passages by Rabin-Karp hashes of every word window.

Each window of a fixed number of words has a polynomial hash of its words. Per
hash, the smallest document it starts in is found; every other document loses
the words of that window. Overlapping windows merge into maximal intervals.

Windows are many times the documents, so they travel in packed form. A task
sorts the window hashes of some thousand documents, keeps of each hash one
entry with its smallest document there, and sends the entries of a hash range
as one compressed row to the bucket of that range. What the other documents
lose to that one is known at once and passes through. A hash of any frequency
is thus one entry per task. The bucket puts the entries together and answers
with the entries that lose, in one row per group of documents. Only these go
back to the documents, which are grouped by their id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW_WORDS = 13
#: Windows that a task sorts together, about; it bounds the task's memory.
CHUNK_WINDOWS = 2_000_000
#: Bytes of text to a bucket of hashes, about.
BUCKET_BYTES = 16 << 20
#: Words whose hash a task keeps.
CACHED_WORDS = 500_000

#: An odd base for the polynomial, and its inverse, modulo 2 to the 64th.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


class WordHashes(dict):
    """64-bit hash of a word, computed once while it is kept."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def words_of(text: str | None) -> list[bytes]:
    """Words between space and the ASCII controls 9 to 13, in UTF-8."""
    return (text or "").encode().split()


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly; the map can be undone."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of the base and of its inverse, as far as they were asked for."""

    def __init__(self):
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            steps = [np.full(n, b, dtype=np.uint64) for b in (BASE, INVERSE)]
            for s in steps:
                s[0] = 1
            self.up, self.down = (np.cumprod(s, dtype=np.uint64) for s in steps)
        return self.up, self.down


def window_hashes(words: list[bytes], known: WordHashes, powers: Powers, window: int = WINDOW_WORDS) -> np.ndarray:
    """The Rabin-Karp hash of each window, by differences of one running sum."""
    n = len(words)
    if n < window:
        return np.empty(0, dtype=np.uint64)
    up, down = powers.upto(n + 1)
    x = np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=n)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(x * down[:n], out=sums[1:])
    return mixed((sums[window:] - sums[:-window]) * up[window - 1 : n])


def _planes(values: np.ndarray) -> bytes:
    """Bytes of equal weight side by side, which compress better."""
    return values.view(np.uint8).reshape(-1, 8).T.tobytes()


def _values(data: bytes) -> np.ndarray:
    return np.frombuffer(data, dtype=np.uint8).reshape(8, -1).T.copy().view(np.uint64).ravel()


def pack_entries(hashes: np.ndarray, docs: np.ndarray, packer: zstandard.ZstdCompressor) -> bytes:
    """Sorted hashes as differences, then their documents."""
    steps = np.diff(hashes, prepend=np.uint64(0))
    return packer.compress(_planes(steps) + _planes(docs.astype(np.int64).view(np.uint64)))


def unpack_entries(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = zstandard.decompress(data)
    half = len(raw) // 2
    return np.cumsum(_values(raw[:half]), dtype=np.uint64), _values(raw[half:]).view(np.int64)


def first_documents(hashes: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of entries (hash, doc): each hash with its smallest document, and the entries of larger ones."""
    order = np.argsort(hashes)
    hashes, docs = hashes[order], docs[order]
    head = np.ones(len(hashes), dtype=bool)
    head[1:] = hashes[1:] != hashes[:-1]
    least = np.minimum.reduceat(docs, np.flatnonzero(head)) if len(hashes) else docs
    lost = docs > least[np.cumsum(head) - 1]
    return hashes[head], least, hashes[lost], docs[lost]


def lost_rows(hashes: np.ndarray, docs: np.ndarray, groups: int) -> Iterator[tuple[int, bytes]]:
    """Entries sorted by hash as one packed row per group of documents."""
    if len(docs):
        group = docs % groups
        order = np.argsort(group, kind="stable")
        cuts = np.flatnonzero(np.diff(group[order])) + 1
        packer = zstandard.ZstdCompressor(level=1)
        for some in np.split(order, cuts):
            yield int(group[some[0]]), pack_entries(hashes[some], docs[some], packer)


def by_document(packed_rows: list[bytes]) -> dict[int, np.ndarray]:
    """The hashes that each document loses."""
    if not packed_rows:
        return {}
    both = [unpack_entries(row) for row in packed_rows]
    hashes, docs = (np.concatenate(side) for side in zip(*both))
    order = np.argsort(docs, kind="stable")
    hashes, docs = hashes[order], docs[order]
    starts = np.concatenate(([0], np.flatnonzero(np.diff(docs)) + 1))
    return dict(zip(docs[starts].tolist(), np.split(hashes, starts[1:])))


_SENT = pa.schema([("bucket", pa.int32()), ("docs", pa.int32()), ("data", pa.binary())])
_LOST = pa.schema([("docs", pa.int32()), ("data", pa.binary())])


def _batches(rows: list[tuple], schema: pa.Schema, at_once: int = 2_000) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(rows), at_once):
        columns = zip(*rows[at : at + at_once])
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _send(buckets: int, groups: int, window: int, chunk_windows: int):
    """Task over (doc_id, text): rows (bucket, null, entries) and (any bucket, group of documents, entries that lose)."""

    def chunk(hashes: list[np.ndarray], docs: list[int]) -> Iterator[pa.RecordBatch]:
        h = np.concatenate(hashes)
        d = np.repeat(np.array(docs, dtype=np.int64), [len(x) for x in hashes])
        h, d, lost_h, lost_d = first_documents(h, d)
        packer = zstandard.ZstdCompressor(level=1)
        # A bucket is a range of hashes: the high half of the product with their number.
        bucket = ((h >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
        cuts = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))
        sent = [
            (b, None, pack_entries(h[i:j], d[i:j], packer))
            for b, (i, j) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist()))
            if j > i
        ]
        sent += [(group % buckets, group, data) for group, data in lost_rows(lost_h, lost_d, groups)]
        yield from _batches(sent, _SENT)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, powers = WordHashes(), Powers()
        hashes: list[np.ndarray] = []
        docs: list[int] = []
        held = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                if len(known) > CACHED_WORDS:
                    known.clear()
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    found = np.unique(window_hashes(words_of(text), known, powers, window))
                    if len(found):
                        hashes.append(found)
                        docs.append(doc)
                        held += len(found)
                if held >= chunk_windows:
                    yield from chunk(hashes, docs)
                    hashes, docs, held = [], [], 0
        if held:
            yield from chunk(hashes, docs)

    return send


def _answer(groups: int):
    """Task over buckets' rows, sorted by bucket: (group of documents, entries that lose)."""

    def settle_bucket(entries: list[bytes]) -> Iterator[pa.RecordBatch]:
        if entries:
            hashes, docs = (np.concatenate(side) for side in zip(*map(unpack_entries, entries)))
            _, _, hashes, docs = first_documents(hashes, docs)
            yield from _batches(list(lost_rows(hashes, docs, groups)), _LOST)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries: list[bytes] = []
        current = None
        for batch in batches:
            passed = []
            for bucket, group, data in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if bucket != current:
                    yield from settle_bucket(entries)
                    entries, current = [], bucket
                if group is None:
                    entries.append(data)
                else:
                    passed.append((group, data))
            yield from _batches(passed, _LOST)
        yield from settle_bucket(entries)

    return answer


def next_prime(n: int) -> int:
    """The least prime of ``n`` or more; ids of any stride spread over so many groups."""
    n = max(2, n)
    while any(n % k == 0 for k in range(2, int(n**0.5) + 1)):
        n += 1
    return n


def removal_intervals(starts: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Maximal word intervals [from, to) that windows at the sorted ``starts`` cover."""
    if not len(starts):
        return []
    gap = np.flatnonzero(np.diff(starts) > window) + 1
    firsts, lasts = starts[np.append(0, gap)], starts[np.append(gap, len(starts)) - 1]
    return list(zip(firsts.tolist(), (lasts + window).tolist()))


def _remove(window: int):
    """Task over (group, text or entries that lose), sorted so that a group's entries come before its documents."""
    out = pa.schema(
        [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string()), ("removed", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))]
    )

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, powers = WordHashes(), Powers()
        lost: dict[int, np.ndarray] = {}
        entries: list[bytes] = []
        current = None
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                if len(known) > CACHED_WORDS:
                    known.clear()
                rows = []
                for group, data, doc, text in zip(*(part.column(i).to_pylist() for i in range(4))):
                    if group != current:
                        current, entries, lost = group, [], {}
                    if data is not None:
                        entries.append(data)
                        continue
                    if entries:
                        lost, entries = by_document(entries), []
                    words = words_of(text)
                    spans = []
                    if doc in lost:
                        hashes = window_hashes(words, known, powers, window)
                        spans = removal_intervals(np.flatnonzero(np.isin(hashes, lost[doc])), window)
                    kept, end = [], 0
                    for start, stop in spans:
                        kept += words[end:start]
                        end = stop
                    kept += words[end:]
                    rows.append(
                        (doc, len(words), len(words) - len(kept), b" ".join(kept).decode(), [{"start": a, "stop": b} for a, b in spans])
                    )
                yield from _batches(rows, out)

    return remove


def remove_repeats(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    window: int = WINDOW_WORDS,
    chunk_windows: int = CHUNK_WINDOWS,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept (text), removed (word intervals [start, stop)).

    A word goes if a window of ``window`` words over it also starts in a
    document with a smaller doc_id; windows are judged on the input. ``kept``
    has the other words joined by one space. Null texts are empty; texts
    shorter than a window stay whole. Rows that repeat a doc_id are judged
    alike and not against each other. A row without doc_id neither loses words
    nor takes them from others. Other columns are ignored, an empty table
    gives no rows.

    ``bucket_bytes`` of text, whose hashes a task holds at once, and
    ``chunk_windows`` should grow together with the executors' memory: with
    more of both, a task sends fewer and longer rows.
    """
    rows = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{text_column}`").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = size // bucket_bytes + 1
    groups = next_prime(max(buckets, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    sent = rows.where(F.col("doc_id").isNotNull()).mapInArrow(
        _send(buckets, groups, window, chunk_windows), "bucket int, docs int, data binary"
    )
    lost = (
        sent.repartitionById(buckets, F.col("bucket"))
        .sortWithinPartitions("bucket")
        .mapInArrow(_answer(groups), "docs int, data binary")
    )
    none = F.lit(None)
    both = lost.select("docs", "data", none.cast("long").alias("doc_id"), none.cast("string").alias("text")).unionAll(
        rows.select(
            F.coalesce(F.pmod("doc_id", F.lit(groups)), F.lit(0)).cast("int"), none.cast("binary"), "doc_id", "text"
        )
    )
    return (
        both.repartitionById(groups, F.col("docs"))
        .sortWithinPartitions("docs", F.col("data").isNull())
        .mapInArrow(
            _remove(window),
            "doc_id long, n_words long, n_removed long, kept string, removed array<struct<start:long,stop:long>>",
        )
    )
