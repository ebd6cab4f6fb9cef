"""Packing of documents into fixed token windows, best fit decreasing.

Documents are tokenised and cut: every full window of an overlong document is a
sequence of its own, what is left is one short piece. Short pieces are dealt to
blocks in turn. In a block they go, longest first, to the tightest window with
room; a segment tree over remaining capacities finds it. A block has so many
pieces that only its last windows are not full.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortscore.session import settle

WINDOW = 1024
#: Short pieces of a block, on average.
BLOCK_PIECES = 4096
#: Encoded words that a worker keeps.
CACHED_WORDS = 600_000
#: UTF-8 bytes of the texts that are encoded at a time, about; one longer text goes alone.
BATCH_BYTES = 2_000_000

_PIECES = "doc_id long, start long, length long, ids binary, ids_crc32 long, doc_tokens long"



def default_tokenizer() -> str:
    from public_tokenizers import path

    return path("byte_bpe_50k.json")


#: Cuts a text into words; texts that have it go whole.
_CUT = "\x1f"
#: The splitting pattern always cuts between a letter and a mark or digit; those of ASCII and Latin are enough here.
_WORD_END = r"([A-Za-zÀ-ÖØ-öø-ɏ])([!-@\[-`{-~])"
#: White space other than single spaces and line breaks between other characters.
_ODD = r"  |\n\n| \n|\n |^[ \n]|[ \n]$"


class WordEncoder:
    """Token ids of many texts at a time, word by word.

    A byte-level BPE with the usual splitting pattern never merges over a space
    that stands between two other characters, nor over a single line break
    there, nor between letters and the marks behind them. So texts fall into
    words, with the space before them, marks and line breaks; each distinct one
    of a batch is looked up once, and encoded once while it is kept. Texts with other white space, or with one of the
    tokenizer's added tokens, are encoded whole.
    """

    def __init__(self, path: str, cached: int = CACHED_WORDS):
        # Spark runs as many tasks as there are cores; threads of their own would only add memory.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.cached = cached
        (self.line_break,) = self.tokenizer.encode("\n", add_special_tokens=False).ids
        #: Strings that are one token wherever they stand.
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        #: Codes of words asked for lately, and of those before them.
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _encode_words(self, known: dict[str, bytes], words: list[str]) -> None:
        # Many words a call, a line break between them, as calls cost more than words.
        groups = [words[at : at + 256] for at in range(0, len(words), 256)]
        for group, code in zip(groups, self.tokenizer.encode_batch_fast(["\n".join(g) for g in groups], add_special_tokens=False)):
            ids = np.array(code.ids, dtype="<u4")
            ends = [*np.flatnonzero(ids == self.line_break).tolist(), len(ids)]
            start, data = 0, ids.tobytes()
            for word, end in zip(group, ends):
                known[word] = data[4 * start : 4 * end]
                start = end + 1

    def codes(self, words: list[str]) -> list[bytes]:
        """Codes of distinct words."""
        found = list(map(self.new.get, words))
        lost = [w for w, code in zip(words, found) if code is None]
        if not lost:
            return found
        if len(self.new) + len(lost) > self.cached // 2:
            # What was not asked for since the last turn is forgotten.
            self.old, self.new = self.new, {}
        again = list(map(self.old.get, lost))
        fresh = dict(zip(lost, again))
        special = {"": b"", "\n": int(self.line_break).to_bytes(4, "little")}
        fresh |= {w: c for w, c in special.items() if w in fresh}
        self._encode_words(fresh, [w for w, code in zip(lost, again) if code is None and w not in special])
        self.new |= fresh
        return [fresh[w] if code is None else code for w, code in zip(words, found)]

    def encode_many(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text's begin and the last one's end; a null text is empty."""
        texts = pc.fill_null(texts, "")
        printable = pc.utf8_is_printable(pc.replace_substring(texts, "\n", ""))
        odd = pc.or_(pc.match_substring_regex(texts, _ODD), pc.invert(printable))
        for token in self.added:
            odd = pc.or_(odd, pc.match_substring(texts, token))
        alone = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        whole = self.tokenizer.encode_batch_fast([texts[i].as_py() for i in alone.tolist()], add_special_tokens=False)
        marked = pc.replace_substring_regex(pc.if_else(odd, "", texts), _WORD_END, rf"\1{_CUT}\2")
        marked = pc.replace_substring(pc.replace_substring(marked, " ", _CUT + " "), "\n", f"{_CUT}\n{_CUT}")
        split = pc.split_pattern(marked, _CUT)
        words = split.flatten().dictionary_encode()
        distinct = words.dictionary.to_pylist()
        known = self.codes(distinct) + [np.array(c.ids, dtype="<u4").tobytes() for c in whole]
        pool = np.frombuffer(b"".join(known), dtype="<u4")
        # A batch, or one text, has far fewer ids than 32 bits count.
        lengths = np.fromiter(map(len, known), dtype=np.int32, count=len(known)) // 4
        starts = np.cumsum(lengths, dtype=np.int32) - lengths
        # The texts that were encoded whole come as one word each, in their places.
        which = words.indices.to_numpy().copy()
        offsets = split.offsets.to_numpy()
        which[offsets[alone]] = np.arange(len(distinct), len(known))
        taken = lengths[which]
        ends = np.cumsum(taken, dtype=np.int32)
        at = np.repeat(starts[which] - (ends - taken), taken)
        at += np.arange(len(at), dtype=np.int32)
        return pool[at], np.concatenate(([0], ends)).astype(np.int64)[offsets]

    def encode(self, texts: list[str]) -> list[bytes]:
        ids, ends = self.encode_many(pa.array(texts, pa.string()))
        return [ids[a:b].tobytes() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]


@lru_cache(maxsize=1)
def word_encoder(path: str) -> WordEncoder:
    """The encoder of this Python worker, which serves one task after another."""
    return WordEncoder(path)


def cut_pieces(
    docs: DataFrame,
    tokenizer: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    window: int = WINDOW,
    end_id: int = 0,
    with_ids: bool = True,
) -> DataFrame:
    """The pieces of each document: doc_id, start, length, ids, ids_crc32, doc_tokens.

    A document is the ids of its text followed by ``end_id``; a null or empty
    text has that id alone. It is cut every ``window`` ids. ``ids`` are
    little-endian unsigned 32-bit, null unless ``with_ids``; ``ids_crc32`` is
    their checksum.
    """
    schema = pa.schema(
        [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64())]
    )

    def pieces(encoder: WordEncoder, part: pa.RecordBatch) -> pa.RecordBatch:
        ids, ends = encoder.encode_many(part.column(1))
        counts = np.diff(ends) + 1  # with the end id
        data = np.empty(len(ids) + len(counts), dtype="<u4")
        last = np.cumsum(counts) - 1
        data[last] = end_id
        data[np.arange(len(ids)) + np.repeat(np.arange(len(counts)), counts - 1)] = ids
        # Pieces lie one after the other in the data: their column shares its bytes.
        n = -(-counts // window)
        doc = np.repeat(np.arange(len(counts)), n)
        start = (np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)) * window
        length = np.minimum(counts[doc] - start, window)
        bounds = np.concatenate(([0], np.cumsum(length))).astype(np.int32) * 4
        view = memoryview(data).cast("B")
        crc = [zlib.crc32(view[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
        binary = pa.BinaryArray.from_buffers(pa.binary(), len(doc), [None, pa.py_buffer(bounds), pa.py_buffer(data)])
        columns = [
            part.column(0).take(pa.array(doc)), pa.array(start), pa.array(length), binary if with_ids else pa.nulls(len(doc), pa.binary()),
            pa.array(crc, pa.int64()), pa.array(counts[doc]),
        ]
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer)
        for batch in batches:
            sizes = np.cumsum(pc.binary_length(batch.column(1)).fill_null(0).to_numpy(zero_copy_only=False))
            at = 0
            while at < batch.num_rows:
                before = int(sizes[at - 1]) if at else 0
                to = max(at + 1, int(np.searchsorted(sizes, before + BATCH_BYTES, side="right")))
                yield pieces(encoder, batch.slice(at, to - at))
                at = to

    narrow = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{text_column}`").alias("text"))
    return narrow.mapInArrow(cut, _PIECES)


class OpenWindows:
    """Windows by remaining capacity, under a segment tree that knows which capacities occur."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.some = [False] * (2 * self.leaves)
        self.at: list[list[int]] = [[] for _ in range(self.leaves)]

    def add(self, capacity: int, which: int) -> None:
        self.at[capacity].append(which)
        node = capacity + self.leaves
        while node and not self.some[node]:
            self.some[node] = True
            node >>= 1

    def tightest(self, length: int) -> tuple[int, int] | None:
        """Take out the window with the least capacity of ``length`` or more."""
        some, node = self.some, length + self.leaves
        if not some[node]:
            # Up to the first right neighbour with a window, then down its left side.
            while node > 1 and (node & 1 or not some[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if some[2 * node] else 2 * node + 1
        capacity = node - self.leaves
        which = self.at[capacity].pop()
        if not self.at[capacity]:
            some[node] = False
            node >>= 1
            while node and not (some[2 * node] or some[2 * node + 1]):
                some[node] = False
                node >>= 1
        return capacity, which


def best_fit(lengths: list[int], window: int) -> tuple[list[int], list[int], list[int]]:
    """For lengths in decreasing order: each one's window, its offset there, and every window's fill."""
    open_windows, which, offsets, fill = OpenWindows(window), [], [], []
    for length in lengths:
        found = open_windows.tightest(length)
        if found is None:
            capacity, w = window, len(fill)
            fill.append(0)
        else:
            capacity, w = found
        which.append(w)
        offsets.append(window - capacity)
        fill[w] += length
        if capacity > length:
            open_windows.add(capacity - length, w)
    return which, offsets, fill


def padded_length(fill: int, window: int) -> int:
    """Sequences are padded to the window, except those that end at a power of two."""
    return fill if fill & (fill - 1) == 0 else window


def put_together(ids: list[bytes], which: list[int], offsets: list[int], fill: list[int]) -> list[bytearray]:
    """The sequences, each with its pieces' ids at their offsets."""
    sequences = [bytearray(4 * n) for n in fill]
    for piece, w, offset in zip(ids, which, offsets):
        sequences[w][4 * offset : 4 * offset + len(piece)] = piece
    return sequences


def place_pieces(pieces: DataFrame, window: int = WINDOW, block_pieces: int = BLOCK_PIECES) -> DataFrame:
    """``pieces`` (doc_id, start, length and more) with sequence_id, offset and sequence_length.

    Full pieces are sequences of their own. The rest is dealt in turn to blocks,
    whose number follows from the count of pieces, and packed there. ``pieces``
    must be stored, so that a task that runs again deals the same. In a block
    ties go by doc_id, start and checksum. Repeated rows are packed each on its
    own. Where there are ``ids``, those returned and their ``ids_crc32`` are read
    back from the sequence put together.
    """
    extra = [c for c in pieces.columns if c not in ("sequence_id", "offset", "sequence_length")]
    short = pieces.where(F.col("length") < window)
    full = pieces.where(F.col("length") == window)
    blocks = max(1, -(-short.count() // block_pieces))

    def pack(block: pd.DataFrame) -> pd.DataFrame:
        order = [c for c in ("length", "doc_id", "start", "ids_crc32") if c in block.columns]
        block = block.sort_values(order, ascending=[c != "length" for c in order], kind="stable", na_position="first")
        which, offsets, fill = best_fit(block["length"].tolist(), window)
        number = block["_block"].iloc[0]
        out = block.drop(columns="_block")
        # Blocks take every other number, full pieces the odd ones.
        out["sequence_id"] = [2 * (w * blocks + number) for w in which]
        out["offset"] = offsets
        out["sequence_length"] = [padded_length(fill[w], window) for w in which]
        if "ids" in out.columns and out["ids"].notna().all():
            sequences = put_together(out["ids"].tolist(), which, offsets, fill)
            # From here on a piece is what its sequence has at its place.
            out["ids"] = [bytes(sequences[w][4 * o : 4 * (o + n)]) for w, o, n in zip(which, offsets, out["length"])]
            out["ids_crc32"] = [zlib.crc32(ids) for ids in out["ids"]]
        return out

    types = {f.name: f.dataType.simpleString() for f in pieces.schema.fields}
    schema = ", ".join(f"`{c}` {types[c]}" for c in extra) + ", sequence_id long, offset long, sequence_length long"
    dealt = short.withColumn("_block", F.pmod(F.monotonically_increasing_id(), F.lit(blocks)))
    packed_rows = dealt.groupBy("_block").applyInPandas(pack, schema)
    crc = {"ids_crc32": F.coalesce(F.crc32("ids"), "ids_crc32")} if {"ids", "ids_crc32"} <= set(extra) else {}
    alone = full.select(
        *[crc.get(c, F.col(c)).alias(c) for c in extra],
        (2 * F.monotonically_increasing_id() + 1).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
        F.lit(window).cast("long").alias("sequence_length"),
    )
    return packed_rows.unionByName(alone)


def pack_documents(
    docs: DataFrame,
    tokenizer: str | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    window: int = WINDOW,
    end_id: int = 0,
    block_pieces: int = BLOCK_PIECES,
    with_ids: bool = True,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids, ids_crc32, doc_tokens, sequence_id, offset, sequence_length.

    ``start`` counts the document's ids before the piece, ``offset`` those
    before it in the sequence, without gaps. ``sequence_length`` is what the
    sequence is padded to. Null and empty texts are one id; a null doc_id is
    kept; rows that repeat a doc_id are documents of their own; columns other
    than id and text are ignored; an empty table gives no rows.

    Pieces are stored once in the shared folder: texts are tokenised once, and
    numbers given to full windows don't change when a task is run again.
    """
    pieces = settle(cut_pieces(docs, tokenizer or default_tokenizer(), id_column, text_column, window, end_id, with_ids))
    return place_pieces(pieces, window, block_pieces)
