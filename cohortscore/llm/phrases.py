"""Phrase collocations by Rabin-Karp fingerprints.

A pass over the texts hashes every n-gram of a chunk with prefix polynomials
over its words, whose own hashes come from prefix polynomials over their bytes.
Equal fingerprints of a chunk become one entry, with a count and a pointer to
one occurrence. Spark adds the entries up, and fingerprints that are frequent
enough stay. There is a pass for words, one for pairs, and one for all longer
phrases. Longer ones are only entered where all their shorter ones may be
frequent, which a bitmap of bounded size tells; its errors cost entries, never
results.

Frequent phrases alone are materialised, each from its pointer. A last pass
holds every occurrence of their fingerprints against that text: what only
shares the fingerprint is taken off and counted as the phrase it is. So counts
are exact whatever the hashes do.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortscore.session import settle

MIN_COUNT = 30
LONGEST = 4
#: A phrase goes if a longer one has this share of its count, in percent.
COVERED_PERCENT = 80
TOP = 2000
#: UTF-8 bytes of the texts that a task holds at a time, about; one longer text is a chunk of its own.
CHUNK_BYTES = 6_000_000
#: Bytes that are hashed at a time.
_SPAN_BYTES = 1_000_000
#: Bits of the bitmap of frequent shorter phrases: 16 for each, within these powers of two.
LEAST_BITS, MOST_BITS = 12, 26
#: Frequent phrases that a verifying pass holds, about; more take more passes.
VERIFY_PHRASES = 1_000_000

#: Leading bits of a fingerprint that count; fewer make more collisions, never other results.
PRINT_BITS = 64

_LETTER, _SPACE, _BREAK = 0, 1, 2
_KINDS = np.zeros(256, dtype=np.uint8)
_KINDS[[0x20, 0x09]] = _SPACE
_KINDS[list(b".,;:!?\n\x0b\x0c\r")] = _BREAK

# Odd 64-bit bases, so that their powers have inverses.
_BYTE_BASE, _WORD_BASE = 0x9E3779B97F4A7C15 | 1, 0xD1342543DE82EF95 | 1
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64 (at least), kept by the worker."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(1 << max(10, (n - 1).bit_length()), base, dtype=np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        _powers[base] = have
    return have[:n]


def mixed_bits(x: np.ndarray) -> np.ndarray:
    """A one-to-one mixing of 64-bit values, as polynomials modulo 2^64 have weak low bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def polynomial_windows(values: np.ndarray, base: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Rabin-Karp hash of values[start:end] for all spans, by one prefix polynomial."""
    prefix = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * powers(base, len(values)), out=prefix[1:])
    return (prefix[ends] - prefix[starts]) * powers(pow(base, -1, 1 << 64), len(values) + 1)[starts]


#: Of eight bytes, the first 1 to 8.
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(1, 9)], dtype=np.uint64)


def eight_bytes(data: bytes) -> np.ndarray:
    """The eight bytes from every place on, as one number each."""
    return np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))


class Chunk:
    """Words of some texts: where they are, which are equal, and their piece, document and language."""

    def __init__(self, texts: list[str | None], langs: list[str | None], print_bits: int = PRINT_BITS):
        self.unused = np.uint64(64 - print_bits)
        # A line break ends a piece, so none reaches into the next text.
        raw = [(t or "").encode("utf-8", "surrogatepass").lower() for t in texts]  # bytes: A-Z only
        self.buffer = b"\n".join(raw) + b"\n" + bytes(8)
        data = np.frombuffer(self.buffer, dtype=np.uint8)
        kinds = _KINDS[data[:-8]]
        inside = np.zeros(len(kinds) + 1, dtype=np.int8)
        inside[1:] = kinds == _LETTER
        edges = np.flatnonzero(np.diff(inside, append=np.int8(0)))
        self.starts, self.ends = edges[::2], edges[1::2]
        self.piece = np.cumsum(kinds == _BREAK, dtype=np.int32)[self.starts]
        doc_starts = np.cumsum([0] + [len(r) + 1 for r in raw[:-1]])
        self.doc = np.searchsorted(doc_starts, self.starts, side="right") - 1
        self.first_word = np.searchsorted(self.starts, doc_starts)
        self.langs = sorted({lang if lang is not None else "und" for lang in langs})
        number = {lang: k for k, lang in enumerate(self.langs)}
        by_doc = np.array([number[lang if lang is not None else "und"] for lang in langs], dtype=np.int32)
        self.lang = by_doc[self.doc]
        seeds = [xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass")) for lang in self.langs]
        self.seeds = np.array(seeds, dtype=np.uint64)
        self.hashes = self._hash_words(data)
        self._word: np.ndarray | None = None
        self._prefix: np.ndarray | None = None

    def _hash_words(self, data: np.ndarray) -> np.ndarray:
        found = np.empty(len(self.starts), dtype=np.uint64)
        at = 0
        while at < len(found):
            low = int(self.starts[at])
            to = max(at + 1, int(np.searchsorted(self.ends, low + _SPAN_BYTES, side="right")))
            values = data[low : int(self.ends[to - 1])].astype(np.uint64) + np.uint64(1)
            found[at:to] = polynomial_windows(values, _BYTE_BASE, self.starts[at:to] - low, self.ends[at:to] - low)
            at = to
        return mixed_bits(found + (self.ends - self.starts).astype(np.uint64))

    @property
    def word(self) -> np.ndarray:
        """A number for each word; equal numbers mean equal bytes, which are compared."""
        if self._word is None:
            order = np.argsort(self.hashes)
            hashes, starts, lengths = self.hashes[order], self.starts[order], (self.ends - self.starts)[order]
            same = (hashes[1:] == hashes[:-1]) & (lengths[1:] == lengths[:-1])
            eight = eight_bytes(self.buffer)
            left, offset = np.flatnonzero(same), 0
            while len(left):
                mask = _MASKS[np.minimum(lengths[left] - offset, 8) - 1]
                equal = (eight[starts[left] + offset] ^ eight[starts[left + 1] + offset]) & mask == 0
                same[left[~equal]] = False
                offset += 8
                left = left[equal]
                left = left[lengths[left] > offset]
            self._word = np.empty(len(order), dtype=np.int32)
            if len(order):
                self._word[order] = np.concatenate(([0], np.cumsum(~same)))
        return self._word

    def fingerprints(self, n: int) -> np.ndarray:
        """Of the n-gram at every word that has n - 1 after it in the chunk; language and length are part of it."""
        count = len(self.starts) - n + 1
        if count <= 0:
            return np.zeros(0, dtype=np.uint64)
        if self._prefix is None:
            self._prefix = np.zeros(len(self.starts) + 1, dtype=np.uint64)
            np.cumsum(self.hashes * powers(_WORD_BASE, len(self.hashes)), out=self._prefix[1:])
        inverse = powers(pow(_WORD_BASE, -1, 1 << 64), count)
        windows = (self._prefix[n : n + count] - self._prefix[:count]) * inverse
        return mixed_bits(windows + self.seeds[self.lang[:count]] + np.uint64(n)) >> self.unused << self.unused

    def whole(self, n: int) -> np.ndarray:
        """Words at which an n-gram of one piece begins."""
        return np.flatnonzero(self.piece[: len(self.piece) - n + 1] == self.piece[n - 1 :]) if len(self.piece) >= n else np.zeros(0, np.int64)

    def groups(self, keys: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """n-grams of the same key: key, first word of the first one, count; in order of the keys."""
        if not len(at):
            return keys, at, at
        order = np.argsort(keys)
        keys, at = keys[order], at[order]
        begins = np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1))
        return keys[begins], np.minimum.reduceat(at, begins), np.diff(begins, append=len(keys))

    def known_groups(self, known: np.ndarray, keys: np.ndarray, at: np.ndarray, n: int) -> tuple[np.ndarray, ...]:
        """Equal n-grams of a language, their words compared, whose key is in the sorted ``known``: its place, first word of one, count."""
        order = np.argsort(keys)
        keys, at = keys[order], at[order]
        # Keys in order are found fast, one of each is looked up.
        new = np.ones(len(at), dtype=bool)
        new[1:] = keys[1:] != keys[:-1]
        begins = np.flatnonzero(new)
        place = np.minimum(np.searchsorted(known, keys[begins]), len(known) - 1)
        hit, counts = known[place] == keys[begins], np.diff(begins, append=len(keys))
        at, place = at[np.repeat(hit, counts)], np.repeat(place[hit], counts[hit])
        new = np.ones(len(at), dtype=bool)
        new[1:] = place[1:] != place[:-1]
        for own in (self.lang[at], *(self.word[at + j] for j in range(n))):
            new[1:] |= own[1:] != own[:-1]
        begins = np.flatnonzero(new)
        return place[begins], at[begins], np.diff(begins, append=len(at))

    def spans_equal(self, at: np.ndarray, n: int, text: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Whether the text from the n-gram's first word to its last is text[start:end], eight bytes at a time.

        ``text`` has eight bytes more at its end. An n-gram with other space between its words is not equal.
        """
        begin, length = self.starts[at], ends - starts
        equal = self.ends[at + n - 1] - begin == length
        left, offset = np.flatnonzero(equal), 0
        while len(left):
            mask = _MASKS[np.minimum(length[left] - offset, 8) - 1]
            same = (eight_bytes(self.buffer)[begin[left] + offset] ^ eight_bytes(text)[starts[left] + offset]) & mask == 0
            equal[left[~same]] = False
            offset += 8
            left = left[same]
            left = left[length[left] > offset]
        return equal

    def phrase(self, at: int, n: int) -> bytes:
        return b" ".join([self.buffer[s:e] for s, e in zip(self.starts[at : at + n].tolist(), self.ends[at : at + n].tolist())])


def chunks(batches: Iterator[pa.RecordBatch], chunk_bytes: int, print_bits: int) -> Iterator[tuple[pa.Array, Chunk]]:
    """Chunks of rows (doc_id, lang, text), with their ids."""

    def made(rows: pa.RecordBatch):
        return rows.column(0), Chunk(rows.column(2).to_pylist(), rows.column(1).to_pylist(), print_bits)

    waiting: list[pa.RecordBatch] = []
    held = 0
    for batch in batches:
        sizes = np.cumsum(pc.binary_length(batch.column(2)).fill_null(0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            before = int(sizes[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(sizes, before + chunk_bytes - held, side="right")))
            waiting.append(batch.slice(at, to - at))
            held += int(sizes[to - 1]) - before
            at = to
            if at < batch.num_rows or held >= chunk_bytes:
                yield made(pa.Table.from_batches(waiting).combine_chunks().to_batches()[0])
                waiting, held = [], 0
    if waiting:
        yield made(pa.Table.from_batches(waiting).combine_chunks().to_batches()[0])


def in_bitmap(bits: np.ndarray, prints: np.ndarray) -> np.ndarray:
    place = prints >> np.uint64(64 - (len(bits) * 64).bit_length() + 1)
    return (bits[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)


def bitmap_power(n: int) -> int:
    return min(MOST_BITS, max(LEAST_BITS, (16 * n).bit_length()))


def frequent_bitmap(frequent: DataFrame, n: int) -> np.ndarray:
    """Bits of the fingerprints in ``frequent``, at their leading digits; ``n`` of them set its size within bounds."""
    power = bitmap_power(n)
    place = F.shiftrightunsigned("fp", 64 - power)
    bit = F.expr(f"shiftleft(1L, cast(shiftrightunsigned(fp, {64 - power}) & 63 as int))")
    words = frequent.groupBy(F.shiftright(place, 6).alias("w")).agg(F.bit_or(bit).alias("b")).toArrow()
    bits = np.zeros(1 << (power - 6), dtype=np.uint64)
    bits[words.column("w").to_numpy()] = words.column("b").to_numpy().view(np.uint64)
    return bits


def counted_entries(rows: DataFrame, lengths: Sequence[int], bitmap: Broadcast | None, shorter: int, chunk_bytes: int, print_bits: int) -> DataFrame:
    """Entries n, fp, count, doc_id, pos (of the word in its text) of the n-grams of each chunk.

    With a bitmap, those all of whose phrases of ``shorter`` words are in it.
    """
    kind = rows.schema["doc_id"].dataType.simpleString()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, chunk in chunks(batches, chunk_bytes, print_bits):
            known = in_bitmap(bitmap.value, chunk.fingerprints(shorter)) if bitmap is not None else None
            for n in lengths:
                at = chunk.whole(n)
                for j in range(n - shorter + 1 if known is not None else 0):
                    at = at[known[at + j]]
                keys, first, counts = chunk.groups(chunk.fingerprints(n)[at], at)
                doc = chunk.doc[first]
                columns = [
                    pa.array(np.full(len(first), n, dtype=np.int32)), pa.array(keys.view(np.int64)), pa.array(counts, pa.int64()),
                    ids.take(pa.array(doc)), pa.array(first - chunk.first_word[doc], pa.int64()),
                ]
                for start in range(0, len(first), 100_000):
                    yield pa.RecordBatch.from_arrays(
                        [c.slice(start, 100_000) for c in columns], names=["n", "fp", "count", "doc_id", "pos"]
                    )

    return rows.mapInArrow(task, f"n int, fp long, count long, doc_id {kind}, pos long")


def frequent_prints(
    rows: DataFrame, lengths: Sequence[int], bitmap: Broadcast | None, shorter: int, min_count: int, chunk_bytes: int, print_bits: int
) -> DataFrame:
    """n, fp, f, doc_id, pos of the fingerprints with a count of ``min_count`` or more, with one pointer each."""
    # Any occurrence does as a pointer; those without doc_id only where there is no other.
    pos = F.coalesce(F.min_by("pos", "doc_id"), F.min("pos"))
    entries = counted_entries(rows, lengths, bitmap, shorter, chunk_bytes, print_bits)
    sums = entries.groupBy("n", "fp").agg(F.sum("count").alias("f"), F.min("doc_id").alias("doc_id"), pos.alias("pos"))
    return sums.where(F.col("f") >= min_count)


def materialised(rows: DataFrame, frequent: DataFrame, print_bits: int) -> DataFrame:
    """lang, n, fp, f, phrase: the text at each pointer.

    Where several rows share a doc_id, one whose text has that fingerprint there counts.
    """
    wanted = frequent.groupBy(F.col("doc_id").alias("id")).agg(F.collect_list(F.struct("fp", "n", "pos")).alias("p"))
    joined = rows.join(wanted, F.col("doc_id").eqNullSafe(F.col("id"))).select("lang", "text", "p")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, text, points in zip(*(batch.column(c) for c in range(3))):
                chunk = Chunk([text.as_py()], [lang.as_py()], print_bits)
                asked = list(zip(*(points.values.field(c).to_pylist() for c in range(3))))
                prints = {n: chunk.fingerprints(n).view(np.int64) for n in {n for _, n, _ in asked}}
                found = [(n, fp, chunk.phrase(at, n)) for fp, n, at in asked if at < len(prints[n]) and prints[n][at] == fp]
                columns = list(zip(*found)) if found else [(), (), ()]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(chunk.langs * len(found), pa.string()), pa.array(columns[0], pa.int32()),
                        pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.binary()).cast(pa.string()),
                    ],
                    names=["lang", "n", "fp", "phrase"],
                )

    texts = joined.mapInArrow(task, "lang string, n int, fp long, phrase string")
    one = texts.groupBy("n", "fp").agg(F.min(F.struct("lang", "phrase")).alias("t"))
    return frequent.join(one, ["n", "fp"]).select("t.lang", "n", "fp", "f", "t.phrase")


def strangers(rows: DataFrame, phrases: Broadcast, longest: int, chunk_bytes: int, print_bits: int) -> DataFrame:
    """Occurrences that share a fingerprint with a phrase but are not that phrase: lang, n, fp, phrase, count.

    Also a row without fingerprint per chunk and language, with the count of its words.
    """
    kinds = (pa.string(), pa.int32(), pa.int64(), pa.binary(), pa.int64())

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = phrases.value
        number = {lang: k for k, lang in enumerate(held.langs)}
        for _, chunk in chunks(batches, chunk_bytes, print_bits):
            own_lang = np.array([number.get(lang, -1) for lang in chunk.langs], dtype=np.int32)
            totals = np.bincount(chunk.lang, minlength=len(chunk.langs)).tolist()
            found = [(lang, None, None, None, total) for lang, total in zip(chunk.langs, totals)]
            for n in range(1, longest + 1):
                at, prints = chunk.whole(n), chunk.fingerprints(n)
                at = at[in_bitmap(held.bits, prints[at])]
                place, first, counts = chunk.known_groups(held.prints, prints[at], at, n)
                same = chunk.spans_equal(first, n, held.text, held.ends[place], held.ends[place + 1])
                same &= held.lang[place] == own_lang[chunk.lang[first]]
                for i in np.flatnonzero(~same).tolist():
                    k, lang, phrase = int(place[i]), chunk.langs[chunk.lang[first[i]]], chunk.phrase(int(first[i]), n)
                    if phrase != held.text[held.ends[k] : held.ends[k + 1]] or lang != held.langs[held.lang[k]]:
                        found.append((lang, n, int(held.prints[k : k + 1].view(np.int64)[0]), phrase, int(counts[i])))
            arrays = [pa.array(c, k) for c, k in zip(zip(*found), kinds)]
            arrays[3] = arrays[3].cast(pa.string())
            yield pa.RecordBatch.from_arrays(arrays, names=["lang", "n", "fp", "phrase", "count"])

    return rows.mapInArrow(task, "lang string, n int, fp long, phrase string, count long")


@dataclass
class PhraseTable:
    """Some frequent phrases as a task holds them: fingerprints in order, and a language and a span of the text for each."""

    prints: np.ndarray
    langs: list[str]
    lang: np.ndarray
    ends: np.ndarray
    text: bytes
    bits: np.ndarray


def phrase_table(phrases: DataFrame) -> PhraseTable:
    got = phrases.select("fp", "lang", F.col("phrase").cast("binary").alias("b")).toArrow()
    prints = got.column("fp").to_numpy().view(np.uint64)
    order = np.argsort(prints)
    parts = got.column("b").take(pa.array(order)).to_pylist()
    lang = got.column("lang").combine_chunks().dictionary_encode() if len(order) else pa.array([], pa.string()).dictionary_encode()
    ends = np.cumsum([0] + [len(p) for p in parts])
    power = bitmap_power(len(order))
    place = prints >> np.uint64(64 - power)
    bits = np.zeros(1 << (power - 6), dtype=np.uint64)
    np.bitwise_or.at(bits, place >> np.uint64(6), np.uint64(1) << (place & np.uint64(63)))
    return PhraseTable(
        prints[order], lang.dictionary.to_pylist(), lang.indices.to_numpy()[order], ends, b"".join(parts) + bytes(8), bits
    )


def phrase_counts(
    rows: DataFrame,
    min_count: int = MIN_COUNT,
    longest: int = LONGEST,
    chunk_bytes: int = CHUNK_BYTES,
    verify_phrases: int = VERIFY_PHRASES,
    print_bits: int = PRINT_BITS,
) -> tuple[DataFrame, DataFrame]:
    """lang, n, phrase, f of the phrases of 1 to ``longest`` words with f of ``min_count`` or more; and lang, total.

    ``rows`` are doc_id, lang, text.
    """
    spark = rows.sparkSession
    passes, bitmap, shorter, kept = [], None, 0, 0
    # Words, pairs, and longer phrases all of whose pairs are frequent.
    for lengths in ([1], [2], list(range(3, longest + 1))):
        frequent = settle(frequent_prints(rows, lengths, bitmap, shorter, min_count, chunk_bytes, print_bits))
        passes.append(frequent)
        prints, shorter = frequent.count(), lengths[0]
        kept += prints
        if not prints or shorter >= longest:
            break
        bitmap = spark.sparkContext.broadcast(frequent_bitmap(frequent, prints))
    found = settle(materialised(rows, reduce(DataFrame.unionAll, passes), print_bits))
    blocks = max(1, -(-kept // verify_phrases))
    seen = []
    for block in range(blocks if kept else 0):
        held = phrase_table(found.where(F.pmod("fp", F.lit(blocks)) == block))
        if len(held.prints):
            others = strangers(rows, spark.sparkContext.broadcast(held), longest, chunk_bytes, print_bits)
            seen.append(settle(others.groupBy("lang", "n", "fp", "phrase").agg(F.sum("count").alias("f"))))
    if not seen:
        return found.select("lang", "n", "phrase", "f"), found.select("lang", F.col("f").alias("total"))
    totals = seen[0].where("fp IS NULL").select("lang", F.col("f").alias("total"))
    strange = reduce(DataFrame.unionAll, seen).where("fp IS NOT NULL")
    less = strange.groupBy("n", "fp").agg(F.sum("f").alias("less"))
    own = found.join(less, ["n", "fp"], "left").select("lang", "n", "phrase", (F.col("f") - F.coalesce("less", F.lit(0))).alias("f"))
    counts = own.unionAll(strange.select("lang", "n", "phrase", "f")).groupBy("lang", "n", "phrase").agg(F.sum("f").alias("f"))
    return counts.where(F.col("f") >= min_count), totals


def part(words: Column, start: Column | int, length: Column | int) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def collocations(counts: DataFrame, totals: DataFrame, covered_percent: int = COVERED_PERCENT, top: int = TOP) -> DataFrame:
    """The ranked phrases of ``phrase_counts``; see ``mine_phrases``."""
    exact = "decimal(38,0)"
    words = F.split("phrase", " ")
    known = counts.select("lang", "phrase", "f")
    cuts = (
        counts.where("n >= 2")
        .select("lang", "phrase", F.col("f").alias("a"), "n", F.explode(F.sequence(F.lit(1), F.col("n") - 1)).alias("k"))
        .withColumn("first", part(words, 1, F.col("k")))
        .withColumn("rest", part(words, F.col("k") + 1, F.col("n") - F.col("k")))
    )
    sides = cuts.join(known.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"]).join(
        known.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"]
    )
    score = F.expr(f"(CAST(2000000 AS {exact}) * a) DIV (CAST(l AS {exact}) + r)")
    scored = sides.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("b"))
    inside = F.expr(
        "flatten(transform(sequence(2, n - 1), m -> transform(sequence(1, n - m + 1), s -> array_join(slice(split(phrase, ' '), s, m), ' '))))"
    )
    longer = counts.where("n >= 3").select("lang", "f", F.explode(inside).alias("phrase"))
    covers = longer.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    stays = F.expr(f"longer IS NULL OR CAST(100 AS {exact}) * longer < CAST({covered_percent} AS {exact}) * a")
    kept = scored.join(covers, ["lang", "phrase"], "left").where(stays)
    order = W.partitionBy("lang").orderBy(F.desc("b.score"), F.desc("a"), "phrase")
    ranked = kept.select("*", F.row_number().over(order).cast("long").alias("rank")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", "rank", "phrase", "a", F.col("b.l").alias("l"), F.col("b.r").alias("r"), F.col("total").alias("n"), F.col("b.score").alias("score")
    )


def mine_phrases(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
    min_count: int = MIN_COUNT,
    longest: int = LONGEST,
    covered_percent: int = COVERED_PERCENT,
    top: int = TOP,
    chunk_bytes: int = CHUNK_BYTES,
    verify_phrases: int = VERIFY_PHRASES,
    print_bits: int = PRINT_BITS,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``top`` phrases of 2 to ``longest`` words.

    A-Z are lower-cased; texts fall at ``.,;:!?`` and line ends into pieces,
    these at space and tab into words. Phrases occur a >= ``min_count`` times
    within pieces, overlaps included. Of the cuts in a first and a last part
    with l and r occurrences, the one with the lowest floor(2000000 a / (l+r))
    gives the score, the smallest first part of equals. Phrases inside a longer
    one with ``covered_percent`` of their count are dropped. Order: score, a,
    then phrase by bytes; n counts the language's words.

    Null and empty texts have no words, a null language is ``und``. Repeated
    rows and ids count each; a null doc_id is borne; other columns are ignored;
    an empty table gives no rows.
    """
    rows = docs.select(
        F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{lang_column}`").alias("lang"), F.col(f"`{text_column}`").alias("text")
    )
    counts, totals = phrase_counts(rows, min_count, longest, chunk_bytes, verify_phrases, print_bits)
    return collocations(settle(counts), totals, covered_percent, top)
