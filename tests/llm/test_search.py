"""Tokens, ranked search and phrases against the library and brute force."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from cases import documents
from pyspark.sql import functions as F

from cohortscore.llm import phrases, pieces, search

# Tokens ----------------------------------------------------------------------


@pytest.fixture(scope="module")
def encoder():
    return pieces.piece_encoder(pieces.default_model())


def odd_texts(tokens, n, seed=1):
    dice = random.Random(seed)
    kinds = [
        lambda: "".join(dice.choice(tokens) for _ in range(dice.randrange(1, 6))),
        lambda: "".join(dice.choice("ab \n▁\x1f") for _ in range(dice.randrange(30))),
        lambda: "".join(chr(dice.choice([dice.randrange(1, 768), dice.randrange(0x3000, 0xD7FF), dice.randrange(0x10000, 0x20000)])) for _ in range(9)),
        lambda: " " * dice.randrange(40) + dice.choice(tokens) + " " * dice.randrange(40),
        lambda: "".join(dice.choice(["=", "==", "-", "/", "*", " ", "\t", "\n", "\r\n", "0", "00", "1", "..."]) for _ in range(20)),
        lambda: "".join(dice.choice("etaoinshr ") for _ in range(dice.randrange(60))),
    ]
    return [dice.choice(kinds)() for _ in range(n)]


def test_tokens_equal_the_library(encoder):
    texts = [*odd_texts(encoder.model.tokens, 5000), "", "\0a\0", "a" * 20_000, "=" * 5001, "<0x41><s></s><unk>", "no_space" * 2000]
    want = encoder.model.processor.encode(texts)
    assert encoder.encode_many(pa.array(texts)).to_pylist() == want
    assert [np.frombuffer(encoder.encode(t), "<i4").tolist() for t in texts] == want


def test_each_part_of_the_encoder_alone(encoder):
    """The table of many segments, the table of one text, and merging by its definition."""
    texts = [t for t in odd_texts(encoder.model.tokens, 800, 2) if t]
    model = encoder.model
    number = {t: k for k, t in enumerate(model.tokens)}
    for text, many in zip(texts, encoder.table.encode(texts)):
        one = model.encode_segment(text)
        plain = b"".join(model.ids[number[p]] if p in model.ranks else model.foreign(p) for p in pieces.merged(text, model.ranks)[0])
        assert one == plain and many in (None, one)


def test_pairs_stand_side_by_side_only_if_nothing_merges_across(encoder):
    model, dice = encoder.model, random.Random(3)
    for _ in range(5000):
        a, b = dice.randrange(len(model.tokens)), dice.randrange(len(model.tokens))
        both = [model.tokens[a], model.tokens[b]]
        assert model.side_by_side(a, b) == (pieces.merged("".join(both), model.ranks)[0] == both)


def test_a_small_memory_changes_nothing(encoder):
    texts = odd_texts(encoder.model.tokens, 300, 4)
    small = pieces.PieceEncoder(pieces.default_model(), kept=3)
    assert small.encode_many(pa.array(texts)).equals(encoder.encode_many(pa.array(texts)))


def test_tokens_of_awkward_rows(awkward, empty, encoder):
    want = Counter()
    for r in awkward.collect():
        ids = tuple(encoder.model.processor.encode(r.text or ""))
        want[r.doc_id, ids, encoder.model.processor.decode(list(ids))] += 1
    done = pieces.encode_texts(awkward, decoded=True)
    assert Counter((r.doc_id, tuple(r.ids), r.decoded) for r in done.collect()) == want
    again = pieces.encode_texts(awkward).select("ids", pieces.decode_ids(F.col("ids")).alias("text"))
    assert Counter((tuple(r.ids), r.text) for r in again.collect()) == Counter((ids, text) for (_, ids, text), n in want.items() for _ in range(n))
    assert pieces.encode_texts(empty).count() == 0


def test_registered_tokens_equal_the_library(spark, small, encoder):
    from cohortscore.llm.queries import QUERIES

    sp = encoder.model.processor
    want = set()
    for r in spark.read.parquet(f"{small}/documents.parquet").collect():
        ids = sp.encode(r.text or "")
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        want.add((r.doc_id, len(ids), digest, hashlib.sha256(sp.decode(ids).encode()).hexdigest()))
    assert {tuple(r) for r in QUERIES["op11_sentencepiece"](spark, small).collect()} == want


# Search ----------------------------------------------------------------------


def plain_ranking(docs, items, top=10):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    bags = [(i, Counter(pattern.findall((t or "").translate(lower)))) for i, t in docs]
    n_docs, total = sum(bool(b) for _, b in bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    rows = []
    for item, text in items:
        found = []
        for doc, bag in bags:
            m = 10 + (90 * sum(bag.values()) * n_docs) // total if total else 0
            score = 0
            for t in set(pattern.findall((text or "").translate(lower))):
                if bag[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((10**9 * bag[t]) // (1000 * bag[t] + 8 * m))
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc))
        rows += [(item, k, f[3], -f[0]) for k, f in enumerate(sorted(found)[:top], 1)]
    return rows


ITEMS = [(1, "alpha Beta gamma déjà x12"), (2, None), (3, ""), (4, "THE the the"), (5, "never12345seen"), (6, "alpha1 alpha2 beta3 x4 the5 gamma")]


@pytest.mark.parametrize("segment, block", [(8192, 200_000), (7, 9)])
def test_ranking_of_awkward_rows(spark, awkward, segment, block):
    items = spark.createDataFrame([(*r, "clash") for r in ITEMS], "item_id long, text string, score string")
    got = search.rank_documents(awkward, items, segment_docs=segment, block_terms=block)
    want = plain_ranking([(r.doc_id, r.text) for r in awkward.collect()], ITEMS)
    assert sorted(map(tuple, got.collect())) == sorted(want)


@pytest.mark.parametrize("top, segment", [(1, 50), (3, 11), (10, 200)])
def test_skipping_loses_nothing(spark, top, segment):
    dice = random.Random(top)
    words = [f"w{i}" for i in range(60)]

    def text(n):
        return " ".join(dice.choice(words[: dice.choice([3, 10, 60])]) for _ in range(n))

    rows = [(i, text(dice.randrange(1, 40)), "en", "a") for i in range(400)]
    items = [(i, text(12)) for i in range(20)]
    got = search.rank_documents(documents(spark, rows).repartition(3), spark.createDataFrame(items, "item_id long, text string"), top=top, segment_docs=segment)
    assert sorted(map(tuple, got.collect())) == sorted(plain_ranking([r[:2] for r in rows], items, top))


def test_pairs_tighten_the_bound_and_save_reading():
    """Two common terms that never meet: their joint maximum ends the search for new documents sooner."""
    docs = 2000
    even, odd = np.arange(0, docs, 2, dtype=np.int32), np.arange(1, docs, 2, dtype=np.int32)
    row = {
        "docs": pa.array(range(docs)), "terms": np.array([0, 1, 2]), "ends": np.array([1000, 2000, 2012]),
        "postings": np.concatenate((even, odd, np.arange(12, dtype=np.int32))),
        "impacts": np.concatenate((np.full(2000, 600), np.full(12, 1000))), "most": np.array([600, 600, 1000]),
        "pair_a": np.array([0]), "pair_b": np.array([1]), "pair_most": np.array([0]),
    }
    with_pairs, without = search.Segment(row), search.Segment({**row, "pair_a": np.array([]), "pair_b": np.array([])})
    assert with_pairs.bounds([0, 1, 2]) == [0, 600, 600, 1600] and without.bounds([0, 1, 2]) == [0, 600, 1200, 2200]
    one, two = with_pairs.answer([0, 1, 2], 10, 0), without.answer([0, 1, 2], 10, 0)
    assert one[0].tolist() == two[0].tolist() and one[1].tolist() == two[1].tolist()
    assert one[2] < two[2]


def test_ranking_of_empty_tables(spark, empty, awkward):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert search.rank_documents(empty, items).count() == 0
    assert search.rank_documents(awkward, items.limit(0)).count() == 0


# Phrases ---------------------------------------------------------------------


def plain_phrases(rows, least, top=2000):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    found = {}
    for (lang, words), a in f.items():
        if len(words) >= 2 and a >= least:
            cuts = [(2_000_000 * a // (f[lang, words[:k]] + f[lang, words[k:]]), k) for k in range(1, len(words))]
            score, k = min(cuts)
            found[lang, words] = (score, a, f[lang, words[:k]], f[lang, words[k:]])
    gone = set()
    for lang, words in found:
        for m in range(2, len(words)):
            for i in range(len(words) - m + 1):
                if 100 * f[lang, words] >= 80 * f[lang, words[i : i + m]]:
                    gone.add((lang, words[i : i + m]))
    out = []
    for lang in n:
        kept = [(-s, -a, " ".join(w).encode(), l, r) for (g, w), (s, a, l, r) in found.items() if g == lang and (g, w) not in gone]
        for rank, (s, a, w, l, r) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, w.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


@pytest.mark.parametrize("least, chunk, block", [(3, 6_000_000, 2_000_000), (3, 5000, 1500)])
def test_phrases_of_awkward_rows(awkward, least, chunk, block):
    got = phrases.mine_phrases(awkward, min_count=least, chunk_bytes=chunk, verify_phrases=block)
    want = plain_phrases([(r.lang, r.text) for r in awkward.collect()], least)
    assert want and sorted(map(tuple, got.collect())) == want


def phrase_rows(spark, n=300):
    dice = random.Random(n)
    words = ["New", "york", "the", "of", "a", "é", "longerthaneight", "longerthanéight", "x y", "A\x1cb"]
    texts = []
    for i in range(n):
        text = "".join(dice.choice(words) + dice.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b"]) for _ in range(dice.randrange(40)))
        texts.append((dice.choice([i, 7, None]), text if i % 9 else None, dice.choice(["en", "fr", None]), "a"))
    return texts, documents(spark, texts)


@pytest.mark.parametrize("bits", [64, 6])
def test_phrases_where_fingerprints_collide(spark, bits):
    """Of a few bits, fingerprints are shared by many phrases, which are told apart by their texts."""
    rows, df = phrase_rows(spark)
    want = plain_phrases([(r[2], r[1]) for r in rows], 4)
    got = phrases.mine_phrases(df.repartition(3), min_count=4, chunk_bytes=2000, print_bits=bits)
    assert sorted(map(tuple, got.collect())) == want


def test_equal_words_are_compared_by_bytes(spark, monkeypatch):
    rows, _ = phrase_rows(spark, 60)
    chunk = phrases.Chunk([r[1] for r in rows], [r[2] for r in rows])
    chunk.hashes[:] = np.uint64(1)  # all words collide
    words = [chunk.phrase(i, 1) for i in range(len(chunk.starts))]
    for number in set(chunk.word.tolist()):
        assert len({words[i] for i in np.flatnonzero(chunk.word == number)}) == 1


def test_rolling_windows_are_the_polynomial():
    values = np.arange(1, 200, dtype=np.uint64)
    starts = np.arange(150)
    got = phrases.polynomial_windows(values, 1_000_003, starts, starts + 40)
    for s in (0, 77, 149):
        want = sum(int(values[s + j]) * 1_000_003**j for j in range(40)) % 2**64
        assert int(got[s]) == want


def test_the_bitmap_never_loses_a_fingerprint(spark):
    dice = np.random.default_rng(1)
    prints = dice.integers(-(2**63), 2**63, 5000)
    frame = spark.createDataFrame([(int(p),) for p in prints], "fp long")
    for n in (1, 5000, 10**9):
        bits = phrases.frequent_bitmap(frame, n)
        assert phrases.in_bitmap(bits, prints.view(np.uint64)).all()
    others = dice.integers(-(2**63), 2**63, 5000).view(np.uint64)
    assert phrases.in_bitmap(phrases.frequent_bitmap(frame, 5000), others).mean() < 0.1


def test_phrases_of_an_empty_table(empty):
    assert phrases.mine_phrases(empty).count() == 0
