"""Operators on documents against brute force, on the awkward rows and on benchmark tables."""

import hashlib
import random
import re
import textwrap
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
import xxhash
import corpus_pipeline
from cases import awkward_rows, documents

from cohortscore.llm import exact, language, licenses, mixing, packing, queries, simhash, substrings

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


# Exact duplicates ------------------------------------------------------------


@pytest.mark.parametrize("keep", ["smallest", "largest"])
@pytest.mark.parametrize("salts", [1, 3, 64])
def test_copy_groups(awkward, keep, salts):
    groups = defaultdict(list)
    for doc, text, *_ in awkward_rows():
        groups[lowered(text)].append(doc)
    got = exact.copy_groups(awkward, keep=keep, salts=salts).collect()
    assert Counter(r.doc_id for r in got) == Counter(d for g in groups.values() for d in g)
    by_text = {hashlib.sha256(t.encode()).hexdigest(): g for t, g in groups.items()}
    kept = Counter()
    for r in got:
        group = by_text[r.text_sha256]
        known = [d for d in group if d is not None]
        want = (min(known) if keep == "smallest" else max(known)) if known else None
        assert (r.keep_id, r.group_size) == (want, len(group))
        if r.kept:
            assert r.doc_id == want
            kept[r.text_sha256] += 1
    assert kept == {t: 1 for t in by_text}


def test_drop_copies_keeps_all_columns(awkward):
    got = exact.drop_copies(awkward, keep="largest")
    assert got.columns == awkward.columns
    texts = [lowered(r.text) for r in got.collect()]
    assert Counter(texts) == Counter({lowered(t) for _, t, *_ in awkward_rows()})
    ids = {r.doc_id for r in got.collect()}
    assert 5 in ids and 4 not in ids


def test_copies_of_an_empty_table(empty):
    assert exact.copy_groups(empty).count() == exact.drop_copies(empty).count() == 0


# Mixing ----------------------------------------------------------------------


def mix_by_hand(rows, weights=(1, 2, 3), epochs=3):
    sized = [(d, s, len(WORDS.findall(t or ""))) for d, t, _, s in rows]
    total = Counter()
    for _, s, n in sized:
        total[s] += n
    order = sorted(total, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target = dict.fromkeys(order, 0.0)
    free, left = set(order), float(sum(total.values()))
    while free:
        level = left / sum(w[s] for s in free)
        over = {s for s in free if level * w[s] > epochs * total[s]}
        if not over:
            for s in free:
                target[s] = level * w[s]
            break
        for s in over:
            target[s] = epochs * total[s]
            left -= target[s]
        free -= over
    return sized, total, target


def test_mix_targets_and_budgets(awkward):
    sized, total, target = mix_by_hand(awkward_rows())
    got = mixing.mix(awkward).collect()
    assert Counter((r.doc_id, r.source, r["size"]) for r in got) == Counter(sized)
    taken = Counter()
    for r in got:
        assert r.source_size == total[r.source] and r.target == pytest.approx(target[r.source])
        assert 0 <= r.taken <= 3 * r["size"]
        taken[r.source] += r.taken
    repeated = 2  # rows that share an id round down once each
    for s in total:
        assert target[s] - 1 - repeated < taken[s] <= target[s]


def test_mix_does_not_depend_on_partitions(awkward):
    def rows(df):
        return sorted((str(r.doc_id), r["size"], r.taken) for r in mixing.mix(df).collect())

    assert rows(awkward) == rows(awkward.repartition(7)) == rows(awkward.coalesce(1))


def test_mixed_rows_hold_the_words_taken(awkward):
    taken = Counter()
    for r in mixing.mix(awkward).collect():
        taken[r.doc_id] += r.taken
    got = mixing.mixed_rows(awkward)
    assert got.columns == awkward.columns
    texts = {d: t for d, t, *_ in awkward_rows() if d is not None}
    words = Counter()
    for r in got.collect():
        words[r.doc_id] += len(WORDS.findall(r.text))
        assert r.doc_id is None or texts[r.doc_id].startswith(r.text)
    assert +words == +taken


def test_many_sources_are_salted(awkward, monkeypatch):
    want = sorted(map(str, mixing.mix(awkward).collect()))
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    assert sorted(map(str, mixing.mix(awkward).collect())) == want


def test_mix_of_an_empty_table(empty):
    assert mixing.mix(empty).count() == mixing.mixed_rows(empty).count() == 0


# Packing ---------------------------------------------------------------------


def packed_ids(rows):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    return [(d, tokenizer.encode(t or "", add_special_tokens=False).ids + [0]) for d, t, *_ in rows]


@pytest.mark.parametrize("window,block", [(1024, 4096), (64, 8)])
def test_pieces_hold_each_id_once(awkward, window, block):
    pieces = packing.pack_documents(awkward, window=window, block_pieces=block).collect()
    want = Counter()
    for doc, ids in packed_ids(awkward_rows()):
        for start in range(0, len(ids), window):
            want[doc, start, tuple(ids[start : start + window]), len(ids)] += 1
    got = Counter((p.doc_id, p.start, tuple(np.frombuffer(p.ids, "<u4").tolist()), p.doc_tokens) for p in pieces)
    assert got == want
    assert all(p.ids_crc32 == zlib.crc32(p.ids) and p.length == len(p.ids) // 4 for p in pieces)
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append((p.offset, p.length, p.sequence_length))
    padding = 0
    for parts in sequences.values():
        parts.sort()
        assert [o for o, _, _ in parts] == [sum(n for _, n, _ in parts[:i]) for i in range(len(parts))]
        fill = sum(n for _, n, _ in parts)
        assert fill <= window and {s for _, _, s in parts} == {packing.padded_length(fill, window)}
        padding += packing.padded_length(fill, window) - fill
    assert padding < 3 * window * (1 + len(pieces) // block)


def test_packing_can_be_repeated(awkward):
    def rows():
        return sorted(map(str, packing.pack_documents(awkward, with_ids=False).collect()))

    assert rows() == rows()


def test_registered_packing_keeps_and_checks_the_ids(spark, tmp_path):
    docs = documents(spark, [(k, f"text {k} " * (k * 40 + 1), "en", "a") for k in range(20)])
    want = Counter()
    for doc, ids in packed_ids([tuple(r)[:2] for r in docs.collect()]):
        for start in range(0, len(ids), packing.WINDOW):
            want[doc, start, zlib.crc32(np.array(ids[start : start + packing.WINDOW], "<u4").tobytes())] += 1
    pieces = corpus_pipeline.packed(spark, docs, "").collect()
    assert Counter((p.doc_id, p.start, zlib.crc32(p.ids)) for p in pieces) == want
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.QUERIES["op1_packing"](spark, str(tmp_path)).collect()
    assert Counter((p.doc_id, p.start, p.ids_crc32) for p in got) == want
    # A sequence that is put together wrongly shows in the checksum.
    pieces = spark.createDataFrame([(1, 0, 2, b"abcdefgh", 0, 2), (2, 0, 4, b"a" * 16, 0, 4)], packing._PIECES)
    placed = packing.place_pieces(pieces, window=4).collect()
    assert all(p.ids_crc32 == zlib.crc32(p.ids) for p in placed)


def test_best_fit_equals_a_plain_search():
    dice = random.Random(3)
    for window in (1, 2, 7, 64, 1000, 1024):
        lengths = sorted((dice.randint(1, window) for _ in range(300)), reverse=True)
        fill = []
        for n in lengths:
            room = [(window - f, i) for i, f in enumerate(fill) if window - f >= n]
            if room:
                fill[min(room)[1]] += n
            else:
                fill.append(n)
        which, offsets, got = packing.best_fit(lengths, window)
        assert sorted(got) == sorted(fill)
        spans = sorted(zip(which, offsets, lengths))
        for (w, o, n), (v, p, _) in zip(spans, spans[1:]):
            assert w != v or o + n == p


def test_word_encoder_equals_the_tokenizer(spark, small):
    texts = [r.text for r in spark.read.parquet(f"{small}/documents.parquet").select("text").collect()]
    texts += ["", " ", "\n", " a", "a ", "a\n", "a\n\nb", "a  b", "a\tb", "a b", "　x", "<|endoftext|> a", "a\r\nb", "don't 's", "12ab 3.4"]
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    encoder = packing.WordEncoder(packing.default_tokenizer(), cached=500)
    for at in range(0, len(texts), 40):
        some = texts[at : at + 40]
        want = [c.ids for c in tokenizer.encode_batch(some, add_special_tokens=False)]
        assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(some)] == want


def test_packing_an_empty_table(empty):
    assert packing.pack_documents(empty).count() == 0


# Language --------------------------------------------------------------------


def test_language_on_held_out_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    labels = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    got = language.identify(docs).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    held = [r.lang_pred == labels[r.doc_id] for r in got if r.held_out]
    assert len(held) > 20 and sum(held) / len(held) > 0.9
    assert {r.lang_pred for r in got} <= {*labels.values(), "und"}


def test_language_never_reads_held_out_rows(spark, small):
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{small}/documents.parquet")
    changed = docs.withColumn("text", F.when(language.held_out(F.col("doc_id")), F.lit("zzz")).otherwise(F.col("text")))
    assert language.learn(docs) == language.learn(changed)
    assert language.learn(docs) == language.learn(docs.withColumn("source", F.lit("x")).repartition(5))


def test_language_of_awkward_rows(awkward):
    got = language.identify(awkward)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score", "rejected"]
    rows = got.collect()
    assert len(rows) == len(awkward_rows())
    for r in rows:
        if r.doc_id in (1, 2, 3, 9):
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
    kept = language.keep_identified(awkward)
    assert kept.columns == awkward.columns
    assert kept.count() == sum(not r.rejected for r in rows)


def test_language_without_anything_to_learn(spark, empty):
    assert language.identify(empty).count() == 0
    rows = language.identify(documents(spark, [(1, "some text", None, "a")])).collect()
    assert [(r.lang_pred, r.score) for r in rows] == [("und", 0.0)]


# Repeated windows ------------------------------------------------------------


def removed_by_hand(rows, window):
    words = [(d, WORDS.findall(t or "")) for d, t, *_ in rows]
    first = {}
    for d, w in words:
        for i in range(len(w) - window + 1) if d is not None else ():
            key = tuple(w[i : i + window])
            first[key] = min(d, first.get(key, d))
    out = []
    for d, w in words:
        gone = set()
        for i in range(len(w) - window + 1) if d is not None else ():
            if first[tuple(w[i : i + window])] < d:
                gone.update(range(i, i + window))
        out.append((str(d), len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return Counter(out)


@pytest.mark.parametrize("window,chunk,bucket", [(13, 2_000_000, 1 << 24), (3, 50, 2_000), (1, 1, 500)])
def test_removed_windows(awkward, window, chunk, bucket):
    got = substrings.remove_repeats(awkward, window=window, chunk_windows=chunk, bucket_bytes=bucket).collect()
    assert Counter((str(r.doc_id), r.n_words, r.n_removed, r.kept) for r in got) == removed_by_hand(awkward_rows(), window)
    for r in got:
        spans = [(s.start, s.stop) for s in r.removed]
        assert sum(b - a for a, b in spans) == r.n_removed
        assert all(b < c for (_, b), (c, _) in zip(spans, spans[1:]))


def test_windows_of_an_empty_table(empty):
    assert substrings.remove_repeats(empty).count() == 0


def test_window_hashes_roll():
    known, powers = substrings.WordHashes(), substrings.Powers()
    words = [str(i % 7).encode() for i in range(100)]
    hashes = substrings.window_hashes(words, known, powers, 13)
    assert len(hashes) == 88 and len(set(hashes.tolist())) == 7
    assert (hashes[:-7] == hashes[7:]).all()
    data = np.sort(hashes)
    back, docs = substrings.unpack_entries(substrings.pack_entries(data, np.arange(-44, 44), substrings.zstandard.ZstdCompressor()))
    assert (back == data).all() and (docs == np.arange(-44, 44)).all()


# SimHash ---------------------------------------------------------------------


def fingerprint_by_hand(text, n=4):
    words = WORDS.findall(lowered(text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def reach(values, ids, linked):
    """The smallest id that each position reaches."""
    group = list(range(len(values)))
    for i in range(len(values)):
        for j in range(i):
            if linked(values[i], values[j]) and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = {}
    for g, d in zip(group, ids):
        if d is not None:
            least[g] = min(d, least.get(g, d))
    return [least.get(g) for g in group]


def test_near_groups_of_awkward_rows(awkward):
    rows = awkward_rows()
    prints = [fingerprint_by_hand(t) for _, t, *_ in rows]
    want = reach(prints, [d for d, *_ in rows], lambda a, b: (a ^ b).bit_count() <= 4)
    got = simhash.near_groups(awkward).collect()
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in got) == Counter(
        (d, f"{p:016x}", c) for (d, *_), p, c in zip(rows, prints, want)
    )
    kept = simhash.drop_near_copies(awkward)
    assert kept.columns == awkward.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, set(want)))


@pytest.mark.parametrize("blocks,tree_size", [(5, 4096), (6, 7), (8, 64)])
def test_radius_links_connect_all_within_the_radius(spark, blocks, tree_size):
    dice = random.Random(blocks)
    prints = {dice.getrandbits(64) for _ in range(40)}
    for p in list(prints):
        for _ in range(6):
            for b in dice.sample(range(64), dice.randint(1, 6)):
                p ^= 1 << b
            prints.add(p)
    signed = [p - (1 << 64) if p >> 63 else p for p in sorted(prints)]
    links = simhash.radius_links(spark.createDataFrame([(s,) for s in signed], "fingerprint long"), 4, blocks, tree_size)
    rows = [(r.a, r.b) for r in links.collect()]
    mask = (1 << 64) - 1
    want = reach(signed, signed, lambda a, b: ((a ^ b) & mask).bit_count() <= 4)
    pairs = {frozenset(r) for r in rows}
    assert reach(signed, signed, lambda a, b: frozenset((a, b)) in pairs) == want


def test_simhash_of_an_empty_table(empty):
    assert simhash.near_groups(empty).count() == simhash.drop_near_copies(empty).count() == 0


# The pipeline ----------------------------------------------------------------


def pipeline_by_hand(rows, classifier):
    """The pieces (doc_id, start, ids) that the five stages leave of (doc_id, text, lang, source) rows."""
    rows = [r for r in rows if classifier.predict(r[1])[1] >= language.MARGIN]
    last = {}
    for r in rows:
        if lowered(r[1]) not in last or last[lowered(r[1])][0] < r[0]:
            last[lowered(r[1])] = r
    rows = list(last.values())
    prints = [fingerprint_by_hand(r[1]) for r in rows]
    firsts = reach(prints, [r[0] for r in rows], lambda a, b: (a ^ b).bit_count() <= 4)
    rows = [r for r, first in zip(rows, firsts) if r[0] == first]
    _, total, target = mix_by_hand(rows)
    texts = []
    for source, size in total.items():
        left, epochs = int(target[source]) % size if size else 0, int(target[source]) // size if size else 0
        own = sorted((r for r in rows if r[3] == source), key=lambda r: hashlib.md5(f"mix:{r[0]}".encode()).hexdigest())
        for doc, text, *_ in own:
            words = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+", text)
            part = min(len(words), left)
            left -= part
            texts += [(doc, text)] * epochs if words else []
            texts += [(doc, text if part == len(words) else "".join(words[:part]))] if part else []
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    found = Counter()
    for doc, text in texts:
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 0]
        for at in range(0, len(ids), 1024):
            found[doc, at, np.array(ids[at : at + 1024], dtype="<u4").tobytes()] += 1
    return found


def test_pipeline_equals_its_stages_by_hand(spark, small):
    given = spark.read.parquet(f"{small}/documents.parquet")
    classifier = language.Classifier(language.learn(given))
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in given.collect()]
    got = corpus_pipeline.run(spark, small).collect()
    assert Counter((r.doc_id, r.start, bytes(r.ids)) for r in got) == pipeline_by_hand(rows, classifier)
    places = defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length))
    for pieces in places.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 1024


def test_pipeline_stage_drops_what_links_within_four_bits(spark):
    words = [f"w{k}" for k in range(400)]
    near = " ".join([*words[:200], "other", *words[201:]])
    far = " ".join(f"v{k}" for k in range(400))
    prints = [fingerprint_by_hand(t) for t in (" ".join(words), near, far)]
    assert (prints[0] ^ prints[1]).bit_count() <= 4 < (prints[0] ^ prints[2]).bit_count()
    docs = documents(spark, [(1, " ".join(words), "en", "a"), (2, near, "en", "a"), (3, far, "en", "a")])
    assert sorted(r.doc_id for r in corpus_pipeline.without_near_copies(spark, docs, "").collect()) == [1, 3]


# Licenses --------------------------------------------------------------------


def test_licenses_of_known_wordings():
    scanner = licenses.Scanner()
    for name, texts in licenses.TEMPLATES.items():
        for text in texts:
            assert scanner.identify(text)[0] == name, text
            assert scanner.identify(text.upper().replace(" ", "  "))[0] == name
    for text in ("Licensed under the Apache License, Version 1.1.", "No licence is given here.", "Copyright 2020 A. Person."):
        assert scanner.identify(text)[0] is None
    assert scanner.identify("Licensed under CC BY-NC 4.0.")[3:] == ([], [])
    assert scanner.identify("Licensed under Apache License, Version 2.0.")[3] == ["the"]


@pytest.mark.parametrize("width", [60, 72, 78, 80, 100])
@pytest.mark.parametrize("sign", ["", " * ", "# ", "// "])
def test_wrapped_notices(width, sign):
    grant, header = licenses.TEMPLATES["MIT"][-1], licenses.TEMPLATES["Apache-2.0"][-1]
    for notice, name in ((grant, "MIT"), (header, "Apache-2.0"), (licenses.TEMPLATES["GPL-3.0"][-1], "GPL-3.0")):
        text = "Some prose before it.\n\n" + textwrap.fill(notice, width, initial_indent=sign, subsequent_indent=sign) + "\n\nSome prose after."
        found = [licenses.Scanner().identify(text[a:b])[0] for a, b in licenses.candidate_blocks(text)]
        assert name in found and set(found) <= {name, None}, text


def test_notices_with_copyright_lines_and_more_words():
    scanner = licenses.Scanner()
    for text, name in {
        "Copyright 2020 Acme. Licensed under the MIT License.": "MIT",
        "Copyright (c) 2011-2024 The Authors.\nReleased under the ISC License.": "ISC",
        "This project is licensed under the MIT License - see the LICENSE file for details.": "MIT",
        "Licensed under the BSD 2-Clause License.": "BSD-2-Clause",
        "Licensed under the BSD 3-Clause License.": "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:": None,
        "Licensed under the MIT License or the Apache License.": None,
        "word " * 20_000 + "licensed under the MIT License": "MIT",
    }.items():
        found = {scanner.identify(text[a:b])[0] for a, b in licenses.candidate_blocks(text)} - {None}
        assert found == ({name} if name else set()), text[:80]


def test_ranking_and_confirmation_by_plain_search():
    """The confirmed template is the first by reduction that passes, whatever the order they are tried in."""
    scanner, dice = licenses.Scanner(), random.Random(9)
    every = [(name, t) for name, texts in licenses.TEMPLATES.items() for t in texts]
    for _ in range(120):
        own = dice.choice(every)[1].split()
        for _ in range(dice.randrange(4)):
            own[dice.randrange(len(own))] = dice.choice(["the", "software", "2.0", "mit", "other"])
        block = " ".join(own)
        passing = []
        for reduction, name, template in scanner.ranked(block):
            missing, added, around = licenses.aligned(licenses.words(block), template)
            told = [w for w in missing + added if w in licenses.TELLING or re.search(r"\d", w)] + [w for w in around if w in licenses.TELLING]
            if reduction >= licenses.MIN_REDUCTION and not told and len(missing + added) <= licenses.MAX_DIFFERENCE * len(template):
                passing.append((-reduction, name))
        assert scanner.identify(block)[0] == (min(passing)[1] if passing else None)


def test_license_blocks_in_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    lines = {
        "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
        "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
        "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
        "Released under the MIT License.": "MIT",
    }
    want = Counter()
    for r in docs.select("doc_id", "text").collect():
        for line, name in lines.items():
            for m in re.finditer(re.escape(line), r.text):
                want[r.doc_id, m.start(), m.end() - m.start(), line, name] += 1
    got = Counter((r.doc_id, r.block_start, r.block_length, r.block, r.license) for r in licenses.scan_licenses(docs).collect())
    assert got == want and want


def test_licenses_in_awkward_rows(spark, awkward, empty):
    assert licenses.scan_licenses(empty).count() == 0
    assert licenses.scan_licenses(awkward).count() == 0
    text = "Intro. Released under the MIT License. End.\nLicensed under CC BY 4.0.\n\n" + "word " * 50_000 + "license"
    rows = licenses.scan_licenses(documents(spark, [(1, text, None, None), (None, text, None, None)])).collect()
    assert Counter(r.doc_id for r in rows) == {1: 3, None: 3}
    for r in rows:
        assert text[r.block_start : r.block_start + r.block_length] == r.block
    assert [r.license for r in sorted(rows, key=lambda r: (r.doc_id is None, r.block_start))][:3] == ["MIT", "CC-BY-4.0", None]
