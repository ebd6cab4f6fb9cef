"""SentencePiece encoding and decoding by a prefix table of last tokens.

A byte-pair encoding is settled pair by pair: a row of tokens is the encoding of
its text if and only if each two neighbours are the encoding of theirs. So every
prefix of a text has one last token, the one that ends there and goes with the
last token of what is before it. An automaton finds the tokens that end at each
place, the pair test picks the one that fits, and the table of last tokens gives
the ids from the end backwards. Work is linear in the text.

Text is cut where no token can reach across: before a run of word marks that
follows another character, and around characters that are in no token. Such
segments are encoded once while a worker keeps them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Segments that a worker keeps at least; it holds up to twice as many.
KEPT_SEGMENTS = 120_000
#: Longer segments are encoded each time.
KEPT_LENGTH = 48
#: Pair tests that a worker keeps.
KEPT_PAIRS = 200_000
#: UTF-8 bytes of the texts of one output batch, about; one longer text is a batch of its own.
BATCH_BYTES = 4_000_000

#: Segments of one table, and characters that it covers beside the mark: ASCII and Latin letters.
_TABLE_SEGMENTS, _COMMON = 20_000, 0x100
#: Pair tests that the table looks up, as a power of two.
_PAIR_SLOTS = 20

_MARK = "▁"
#: Cuts a text where no token reaches across; texts that have it, or marks, or runs of spaces, go one by one.
_CUT = "\x1f"
_ODD = f"  |^ |{_CUT}|{_MARK}"
_NEVER = 1 << 60

# Fixed values of the model format: piece kinds and the number of the byte-pair model type.
_NORMAL, _UNKNOWN, _CONTROL, _USER_DEFINED, _UNUSED, _BYTE = 1, 2, 3, 4, 5, 6
_BPE = 2


def default_model() -> str:
    from public_tokenizers import path

    return path("piece_bpe_32k.model")


def merged(text: str, ranks: dict[str, int]) -> tuple[list[str], list[tuple[str, str]]]:
    """The byte-pair encoding of a short text by its definition, and the merges in their order.

    Of neighbours that together are a piece, those of the best rank merge first, the leftmost of equals.
    """
    parts, merges = list(text), []
    while len(parts) > 1:
        best = min(((ranks.get(a + b, _NEVER), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))))
        if best[0] == _NEVER:
            break
        i = best[1]
        merges.append((parts[i], parts[i + 1]))
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return parts, merges


class PieceModel:
    """Tokens of a byte-pair SentencePiece model, their ranks, and which may stand side by side."""

    def __init__(self, path: str):
        import ahocorasick
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            proto.ParseFromString(file.read())
        if proto.trainer_spec.model_type != _BPE or any(p.type in (_USER_DEFINED, _UNUSED) for p in proto.pieces):
            raise ValueError("only byte-pair models without user-defined or unused pieces are encoded here")
        self.processor = SentencePieceProcessor(model_file=path)
        spec = proto.normalizer_spec
        #: The usual normaliser only marks the spaces and the beginning; any other is the library's.
        self.marks_only = (
            spec.add_dummy_prefix
            and spec.escape_whitespaces
            and not (spec.precompiled_charsmap or spec.remove_extra_whitespaces or proto.trainer_spec.treat_whitespace_as_suffix)
        )
        #: Ids of the 256 bytes; without byte fallback a character in no piece is the unknown id.
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == _BYTE}
        self.fallback = bool(proto.trainer_spec.byte_fallback)
        self.unknown = next(i for i, p in enumerate(proto.pieces) if p.type == _UNKNOWN)
        normal = [(i, p.piece, p.score) for i, p in enumerate(proto.pieces) if p.type == _NORMAL]
        places = {score: n for n, score in enumerate(sorted({s for _, _, s in normal}, reverse=True))}
        self.ranks = {piece: places[score] for _, piece, score in normal}
        ids = {piece: i for i, piece, _ in normal}
        self.alphabet = {c for piece in self.ranks for c in piece}

        # Tokens are the pieces that are their own encoding, and every character of the alphabet.
        self.tokens: list[str] = []
        self.ids: list[bytes] = []  # as little-endian 32-bit
        # What ends, and what begins, a token as it grows; known of tokens that were tested.
        self.lasts: dict[int, list[tuple[str, int]]] = {}
        self.firsts: dict[int, list[tuple[str, int]]] = {}
        self.steady: list[bool] = []  # whether its merges go from better to worse ranks
        automaton = ahocorasick.Automaton()
        for piece in sorted(self.alphabet | self.ranks.keys()):
            parts, merges = merged(piece, self.ranks)
            if len(parts) > 1:
                continue
            made = [self.ranks[a + b] for a, b in merges]
            self.steady.append(all(a <= b for a, b in zip(made, made[1:])))
            automaton.add_word(piece, len(self.tokens))
            self.ids.append(np.array([ids[piece]], dtype="<i4").tobytes() if piece in ids else self.foreign(piece))
            self.tokens.append(piece)
        automaton.make_automaton()
        self.automaton = automaton
        self.lengths = [len(t) for t in self.tokens]
        # Cuts before marks hold only if no piece has a mark after another character.
        self.cut_at_marks = not any(_MARK in piece.lstrip(_MARK) for piece in self.ranks)
        self.pairs: dict[int, bool] = {}

    def growth(self, token: int, side: int, known: dict[int, list[tuple[str, int]]]) -> list[tuple[str, int]]:
        """The part at one end of a token (0 or -1) after each merge that touches it, with the rank that ends it."""
        if token in known:
            return known[token]
        piece = self.tokens[token]
        now, steps, parts = piece[side], [], list(piece)
        for a, b in merged(piece, self.ranks)[1]:
            at = next(i for i, pair in enumerate(zip(parts, parts[1:])) if pair == (a, b))
            rank = self.ranks[a + b]
            if at == (len(parts) - 2 if side else 0):
                steps.append((now, rank))
                now = a + b
            parts[at : at + 2] = [a + b]
        known[token] = [*steps, (now, _NEVER)]
        return known[token]

    def foreign(self, character: str) -> bytes:
        """Ids of a character that is no piece: its bytes, or the unknown id."""
        found = [self.bytes[b] for b in character.encode("utf-8", "surrogatepass")] if self.fallback else [self.unknown]
        return np.array(found, dtype="<i4").tobytes()

    def side_by_side(self, a: int, b: int) -> bool:
        """Whether the encoding of both tokens' text is these two tokens: no merge reaches across before they are whole."""
        if not (self.steady[a] and self.steady[b]):
            return merged(self.tokens[a] + self.tokens[b], self.ranks)[0] == [self.tokens[a], self.tokens[b]]
        ends, starts, ranks = self.growth(a, -1, self.lasts), self.growth(b, 0, self.firsts), self.ranks
        i = j = 0
        while True:
            (left, left_end), (right, right_end) = ends[i], starts[j]
            across = ranks.get(left + right)
            # Of equal ranks the merge further left goes first: in a, across, in b.
            if across is not None and across < left_end and across <= right_end:
                return False
            if left_end <= right_end:
                if left_end == _NEVER:
                    return True
                i += 1
            else:
                j += 1

    def normal(self, text: str) -> str:
        """The text as it is encoded, with marks for spaces."""
        return _MARK + text.replace(" ", _MARK) if self.marks_only else self.processor.normalize(text)

    def goes_with(self, a: int, b: int) -> bool:
        key = a << 32 | b
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= KEPT_PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self.side_by_side(a, b)
        return known

    def encode_segment(self, text: str) -> bytes:
        """Ids of a text as little-endian 32-bit, by the table of each prefix's last token."""
        last = [-1] * (len(text) + 1)
        lengths, known, test = self.lengths, self.pairs, self.goes_with
        for end, token in self.automaton.iter(text):
            end += 1
            if last[end] >= 0:
                continue
            start = end - lengths[token]
            if start:
                before = last[start]
                # A character in no token, marked -1, never merges.
                if before >= 0:
                    fits = known.get(before << 32 | token)
                    if not (test(before, token) if fits is None else fits):
                        continue
            last[end] = token
        found, at = [], len(text)
        while at:
            token = last[at]
            if token < 0:
                found.append(self.foreign(text[at - 1]))
                at -= 1
            else:
                found.append(self.ids[token])
                at -= lengths[token]
        found.reverse()
        return b"".join(found)


class SegmentTable:
    """The same table of last tokens for many short segments at a time, a column for each.

    It covers tokens of the characters below ``_COMMON`` and the mark, whose
    automaton is small enough to hold every step of every state.
    """

    def __init__(self, model: PieceModel):
        self.model = model
        single = {t for t, ids in zip(model.tokens, model.ids) if len(t) == 1 and len(ids) == 4}
        common = sorted(c for c in single if ord(c) < _COMMON or c == _MARK)
        self.kinds = np.full(ord(_MARK) + 1, -1, dtype=np.int32)
        self.kinds[[ord(c) for c in common]] = np.arange(len(common))
        number = {c: k for k, c in enumerate(common)}
        # States in order of depth, each with its parent, its last character and the token that it is.
        states: list[dict[int, int]] = [{}]
        token_at = [-1]
        for token, text in enumerate(model.tokens):
            if number.keys() >= set(text):
                at = 0
                for c in text:
                    step = states[at].get(number[c])
                    if step is None:
                        step = states[at][number[c]] = len(states)
                        states.append({})
                        token_at.append(-1)
                    at = step
                token_at[at] = token
        self.steps = np.zeros((len(states), len(common)), dtype=np.min_scalar_type(len(states)))
        self.longest = np.array(token_at, dtype=np.int32)
        self.shorter = np.full(len(model.tokens), -1, dtype=np.int32)
        fail, level = np.zeros(len(states), dtype=np.int32), [0]
        while level:
            below = []
            for at in level:
                up = fail[at]
                if at:
                    self.steps[at] = self.steps[up]
                    if self.longest[at] >= 0:
                        self.shorter[self.longest[at]] = self.longest[up]
                    else:
                        self.longest[at] = self.longest[up]
                for kind, step in states[at].items():
                    fail[step] = self.steps[at, kind] if at else 0
                    self.steps[at, kind] = step
                    below.append(step)
            level = below
        self.lengths = np.array(model.lengths, dtype=np.int64)
        self.ids = np.array([int.from_bytes(ids[:4], "little") for ids in model.ids], dtype="<i4")
        self.keys = np.full(1 << _PAIR_SLOTS, -1, dtype=np.int64)
        self.fits = np.zeros(1 << _PAIR_SLOTS, dtype=bool)

    def fit(self, before: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        """Pair tests, looked up in a table by a hash of the pair; a pair that is not there is tested."""
        keys = before.astype(np.int64) << 32 | tokens
        slots = ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _PAIR_SLOTS)).view(np.int64)
        new = self.keys[slots] != keys
        if new.any():
            for key in np.unique(keys[new]).tolist():
                slot = (key * 0x9E3779B97F4A7C15 & (1 << 64) - 1) >> 64 - _PAIR_SLOTS
                self.keys[slot], self.fits[slot] = key, self.model.goes_with(key >> 32, key & 0xFFFFFFFF)
            good = self.fits[slots]
            for i in np.flatnonzero(self.keys[slots] != keys).tolist():  # two pairs of one slot
                good[i] = self.model.goes_with(int(before[i]), int(tokens[i]))
            return good
        return self.fits[slots]

    def encode(self, segments: list[str]) -> list[bytes | None]:
        """Ids of each segment; None where it has a character beyond the table."""
        sizes = np.fromiter(map(len, segments), dtype=np.int64, count=len(segments))
        points = np.frombuffer("".join(segments).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        kinds = self.kinds[np.minimum(points, len(self.kinds) - 1)]
        kinds[points >= len(self.kinds)] = -1
        begins = np.cumsum(sizes) - sizes
        foreign = np.concatenate(([0], np.cumsum(kinds < 0)))
        fine = np.flatnonzero((foreign[begins + sizes] == foreign[begins]) & (sizes > 0))
        found: list[bytes | None] = [None] * len(segments)
        if not len(fine):
            return found
        order = fine[np.argsort(-sizes[fine], kind="stable")]
        sizes, begins = sizes[order], begins[order]
        last = np.full((int(sizes[0]) + 1, len(order)), -1, dtype=np.int32)
        state = np.zeros(len(order), dtype=np.int32)
        reach = np.searchsorted(-sizes, -np.arange(len(last)), side="right")  # segments of that length or more
        for end in range(1, len(last)):
            todo = np.arange(reach[end])
            state = self.steps[state[: len(todo)], kinds[begins[: len(todo)] + end - 1]]
            token = self.longest[state]
            while len(todo):
                start = end - self.lengths[token]
                before = last[start, todo]
                good = start == 0
                inner = np.flatnonzero(~good)
                good[inner] = self.fit(before[inner], token[inner])
                last[end, todo[good]] = token[good]
                todo, token = todo[~good], self.shorter[token[~good]]
        steps, at, who = [], sizes.copy(), np.arange(len(order))
        counts = np.zeros(len(order), dtype=np.int64)
        while len(who):
            token = last[at[who], who]
            steps.append((who, token))
            counts[who] += 1
            at[who] -= self.lengths[token]
            who = who[at[who] > 0]
        ends = np.cumsum(counts)
        ids = np.empty(int(ends[-1]), dtype="<i4")
        for k, (who, token) in enumerate(steps):
            ids[ends[who] - 1 - k] = self.ids[token]
        data, start = ids.tobytes(), 0
        for i, end in zip(order.tolist(), (4 * ends).tolist()):
            found[i] = data[start:end]
            start = end
        return found


class PieceEncoder:
    """Ids of whole texts, with segments kept from text to text."""

    def __init__(self, path: str, kept: int = KEPT_SEGMENTS):
        self.model = PieceModel(path)
        alphabet = self.model.alphabet
        letters = "".join(re.escape(c) for c in sorted(alphabet - {_MARK}))
        word = f"[{letters}]+" if letters else "(?!)"
        self.segments = re.compile(f"{_MARK}*{word}|{_MARK}+|[^{_MARK}{letters}]+") if self.model.cut_at_marks else None
        # Texts whose spaces stand alone can be cut by replacing characters, many texts at a time.
        self.plain = self.model.cut_at_marks and self.model.marks_only and "\n" not in alphabet and self.model.fallback
        self.table = SegmentTable(self.model)
        self.kept = kept
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def code(self, segment: str) -> bytes:
        """Ids of a segment, kept for the next time."""
        code = self.new.get(segment)
        if code is None:
            code = self.old.get(segment)
            if code is None:
                code = self.model.encode_segment(segment)
            self._keep(segment, code)
        return code

    def _keep(self, segment: str, code: bytes) -> None:
        if len(segment) <= KEPT_LENGTH:
            if len(self.new) >= self.kept:
                # What was not asked for since the last turn is forgotten.
                self.old, self.new = self.new, {}
            self.new[segment] = code

    def codes(self, segments: list[str]) -> list[bytes]:
        """Ids of distinct segments; those not kept are encoded together."""
        found = list(map(self.new.get, segments))
        lost = [i for i, code in enumerate(found) if code is None]
        for i in lost:
            found[i] = self.old.get(segments[i])
        new = [i for i in lost if found[i] is None and len(segments[i]) <= KEPT_LENGTH]
        for at in range(0, len(new), _TABLE_SEGMENTS):
            some = new[at : at + _TABLE_SEGMENTS]
            for i, code in zip(some, self.table.encode([segments[i] for i in some])):
                found[i] = code
        for i in lost:
            if found[i] is None:
                found[i] = self.model.encode_segment(segments[i])
            self._keep(segments[i], found[i])
        return found

    def encode(self, text: str | None) -> bytes:
        """Ids of one text as little-endian 32-bit integers; null and empty texts have none."""
        if not text:
            return b""
        normal = self.model.normal(text)
        if self.segments is None:
            code = self.model.encode_segment(normal)
        else:
            code = b"".join(map(self.code, self.segments.findall(normal)))
        if not self.model.fallback:
            ids = np.frombuffer(code, dtype="<i4")
            again = (ids[1:] == self.model.unknown) & (ids[:-1] == self.model.unknown)
            code = ids[np.concatenate(([True], ~again))].tobytes() if len(ids) else code
        return code

    def encode_many(self, texts: pa.Array) -> pa.ListArray:
        """Ids of many texts; each distinct segment of them is looked up once."""
        texts = pc.fill_null(texts, "")
        odd = pc.match_substring_regex(texts, _ODD) if self.plain else pc.equal(texts, texts)
        alone = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        codes = [self.encode(texts[i].as_py()) for i in alone.tolist()]
        marked = pc.replace_substring(pc.if_else(odd, "", texts), " ", _CUT + _MARK)
        marked = pc.replace_substring(marked, "\n", f"{_CUT}\n{_CUT}")
        some = pc.greater(pc.binary_length(marked), 0)
        split = pc.split_pattern(pc.if_else(some, pc.binary_join_element_wise(_MARK, marked, ""), ""), _CUT)
        encoded = split.flatten().dictionary_encode()
        known = self.codes(encoded.dictionary.to_pylist()) + codes
        pool = np.frombuffer(b"".join(known), dtype="<i4")
        lengths = np.fromiter(map(len, known), dtype=np.int64, count=len(known)) // 4
        starts = np.cumsum(lengths) - lengths
        # The texts that were encoded alone come as one segment each, in their places.
        words = encoded.indices.to_numpy().astype(np.int64)
        offsets = split.offsets.to_numpy().astype(np.int64)
        words[offsets[alone]] = np.arange(len(known) - len(codes), len(known))
        taken = lengths[words]
        ends = np.cumsum(taken)
        ids = pool[np.repeat(starts[words] - (ends - taken), taken) + np.arange(int(ends[-1]) if len(ends) else 0)]
        return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends))[offsets], pa.int32()), pa.array(ids, pa.int32()))


@lru_cache(maxsize=1)
def piece_encoder(path: str) -> PieceEncoder:
    """The encoder of this Python worker, which serves one task after another."""
    return PieceEncoder(path)


@lru_cache(maxsize=1)
def piece_decoder(path: str):
    """The library's processor of this Python worker."""
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=path)


def decoded_texts(ids: pa.ListArray, processor) -> pa.Array:
    return pa.array([processor.decode(row.values.to_pylist()) if row.is_valid else "" for row in ids], pa.string())


def encode_texts(
    docs: DataFrame, model: str | None = None, id_column: str = "doc_id", text_column: str = "text", decoded: bool = False
) -> DataFrame:
    """One row per input row: doc_id, ids (array of int), as the library's encoder gives them.

    With ``decoded`` also the text that the library's ``decode`` makes of the
    ids, in the same pass. No begin or end ids. Null and empty texts have no ids. Repeated rows and ids
    are encoded each; a null doc_id is kept; columns other than id and text are
    ignored; an empty table gives no rows. Nothing is shuffled: a row's result
    depends on its text alone.
    """
    path = model or default_model()
    kind = docs.schema[id_column].dataType.simpleString()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = piece_encoder(path)
        for batch in batches:
            sizes = np.cumsum(pc.binary_length(batch.column(1)).fill_null(0).to_numpy(zero_copy_only=False))
            at = 0
            while at < batch.num_rows:
                before = int(sizes[at - 1]) if at else 0
                to = max(at + 1, int(np.searchsorted(sizes, before + BATCH_BYTES, side="right")))
                part = batch.slice(at, to - at)
                columns = [part.column(0), encoder.encode_many(part.column(1))]
                if decoded:
                    columns.append(decoded_texts(columns[1], encoder.model.processor))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "decoded"][: len(columns)])
                at = to

    narrow = docs.select(F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{text_column}`").alias("text"))
    return narrow.mapInArrow(task, f"doc_id {kind}, ids array<int>" + (", decoded string" if decoded else ""))


def decode_ids(ids: Column, model: str | None = None) -> Column:
    """The text of an array of ids, by the library's own ``decode``; null ids give the empty text."""
    path = model or default_model()

    @F.arrow_udf("string")
    def decoded(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            yield decoded_texts(part, piece_decoder(path))

    return decoded(ids)
