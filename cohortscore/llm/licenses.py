"""License scans by conditional compression.

Sentences around licensing words are candidate blocks; a sentence may be
wrapped over lines, but ends with its paragraph. A block is compressed alone and
with each template as a zstandard dictionary of raw content; templates are
ranked by how much smaller that makes it. The winner is the best ranked one
whose wording, aligned with the part of the block that is most like it, differs
little word by word, and in none of the words that tell licenses apart. What
stands before and after that part, such as copyright lines with their years, is
set aside, unless it names a license too.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from difflib import SequenceMatcher
from itertools import accumulate

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Common wordings of license notices.
TEMPLATES = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This work is licensed under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions "
        "of the Software.",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Released under the Apache License 2.0.",
        "This work is licensed under the Apache License, Version 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "SPDX-License-Identifier: GPL-2.0-only",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "Released under the GNU GPL v3.",
        "SPDX-License-Identifier: GPL-3.0-only",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    "LGPL-3.0": (
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "SPDX-License-Identifier: LGPL-3.0-only",
    ),
    "AGPL-3.0": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ),
    # The first sentences of both are the same and confirm neither.
    "BSD-2-Clause": (
        "Released under the BSD 2-Clause License.",
        "Licensed under the BSD 2-Clause License.",
        "SPDX-License-Identifier: BSD-2-Clause",
    ),
    "BSD-3-Clause": (
        "Released under the BSD 3-Clause License.",
        "Licensed under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission.",
    ),
    "ISC": (
        "Released under the ISC License.",
        "Licensed under the ISC License.",
        "SPDX-License-Identifier: ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "Unlicense": (
        "SPDX-License-Identifier: Unlicense",
        "This is free and unencumbered software released into the public domain.",
    ),
    "Zlib": (
        "SPDX-License-Identifier: Zlib",
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to "
        "alter it and redistribute it freely, subject to the following restrictions:",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, Version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "CC0-1.0": (
        "Released under CC0 1.0.",
        "This work is dedicated to the public domain under the Creative Commons CC0 1.0 Universal license.",
    ),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC-BY-NC-ND-4.0": (
        "Licensed under CC BY-NC-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
    ),
}
#: Words that tell licenses apart, besides all words with a digit: none may be missing or added.
TELLING = frozenset(
    "mit apache gnu gpl lgpl agpl lesser affero bsd mozilla mpl cc by nc nd sa zero attribution noncommercial "
    "noderivatives sharealike commons clause isc unlicense zlib".split()
)
#: Where a candidate block may be; the same pattern runs in Spark and here.
ANCHOR = r"(?i)licen[cs]|spdx|copyright|creative commons|public domain|permission is hereby|redistribut|free software"
#: Sentences without an anchor that may stand between two with one.
GAP_SENTENCES = 2
#: Least reduction of a template that is looked at, and the largest share of differing words.
MIN_REDUCTION, MAX_DIFFERENCE = 0.1, 0.25
LEVEL = 19

_ANCHOR = re.compile(ANCHOR)
#: A sentence ends at a mark before white space, or with its paragraph; comment signs begin a wrapped line.
_SENTENCE = re.compile(r"\S(?:[^\n]|\n(?![^\S\n]*(?:\n|\Z)))*?(?:[.!?:](?=\s|\Z)|(?=\n[^\S\n]*(?:\n|\Z))|\Z)")
#: Lines of a sentence that is wrapped; longer ones are no notice, and fall into their lines.
_WRAPPED_LINES = 40
_WORD = re.compile(r"\w+(?:\.\w+)*")


def words(text: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(text)]


def sentences(text: str) -> Iterator[tuple[int, int]]:
    """Spans of the sentences with an anchor, and of the others as they come."""
    for found in _SENTENCE.finditer(text):
        if found[0].count("\n") <= _WRAPPED_LINES:
            yield found.span()
            continue
        at = found.start()
        for line in found[0].split("\n"):
            if line.strip():
                yield at + len(line) - len(line.lstrip()), at + len(line)
            at += len(line) + 1


def candidate_blocks(text: str) -> list[tuple[int, int]]:
    """Spans of code points: runs of sentences from an anchor to the last one near it, up to a line that a sentence ended."""
    spans: list[list[int]] = []
    last = -GAP_SENTENCES - 2
    for number, (start, end) in enumerate(sentences(text)):
        if not _ANCHOR.search(text, start, end):
            continue
        line_between = spans and "\n" in text[spans[-1][1] : start]
        if spans and number - last <= GAP_SENTENCES + 1 and not line_between:
            spans[-1][1] = end
        else:
            spans.append([start, end])
        last = number
    return [(a, b) for a, b in spans]


def nearest_part(block: list[str], template: list[str]) -> tuple[int, int]:
    """The span of the block that holds most of the template's words, of twice its length; blocks may be very long."""
    width = 2 * len(template) + 20
    if len(block) <= width:
        return 0, len(block)
    known = set(template)
    held = [0, *accumulate(w in known for w in block)]
    at = max(range(len(block) - width + 1), key=lambda i: held[i + width] - held[i])
    return at, at + width


def aligned(block: list[str], template: list[str]) -> tuple[list[str], list[str], list[str]]:
    """Words of the template that are missing, words added inside the aligned part, and words around it, in order."""
    start, end = nearest_part(block, template)
    part = block[start:end]
    codes = SequenceMatcher(None, template, part, autojunk=False).get_opcodes()
    same = [c for c in codes if c[0] == "equal"]
    if not same:
        return list(template), [], list(block)
    first, last = same[0][3], same[-1][4]
    missing, added = [], []
    for kind, i, j, k, m in codes:
        if kind != "equal":
            missing += template[i:j]
            added += part[max(k, first) : min(m, last)]
    return missing, added, block[: start + first] + block[start + last :]


def telling(word: str) -> bool:
    return word in TELLING or any(map(str.isdigit, word))


class Scanner:
    def __init__(self, templates: dict[str, tuple[str, ...]] = TEMPLATES):
        options = dict(write_content_size=False, write_checksum=False, write_dict_id=False)
        self.alone = zstandard.ZstdCompressor(level=LEVEL, **options)
        self.variants = [
            (
                name,
                words(text),
                zstandard.ZstdCompressor(
                    level=LEVEL,
                    dict_data=zstandard.ZstdCompressionDict(
                        self.plain(text).ljust(8), dict_type=zstandard.DICT_TYPE_RAWCONTENT
                    ),
                    **options,
                ),
            )
            for name, texts in sorted(templates.items())
            for text in texts
        ]

    @staticmethod
    def plain(text: str) -> bytes:
        return " ".join(text.lower().split()).encode()

    def ranked(self, block: str) -> list[tuple[float, str, list[str]]]:
        """(reduction, license, template words), the largest reduction first, equals by name and order."""
        data = self.plain(block)
        size = len(self.alone.compress(data))
        found = [(1 - len(c.compress(data)) / size, name, text) for name, text, c in self.variants]
        return sorted(found, key=lambda f: (-f[0], f[1]))

    def identify(self, block: str) -> tuple[str | None, str, float, list[str], list[str]]:
        """Confirmed license or none, the best ranked one, its reduction, and the wording differences."""
        ranked, own = self.ranked(block), words(block)
        for reduction, name, text in ranked:
            if reduction < MIN_REDUCTION:
                break
            missing, added, around = aligned(own, text)
            changed = any(map(telling, missing)) or any(map(telling, added)) or not TELLING.isdisjoint(around)
            if not changed and len(missing) + len(added) <= MAX_DIFFERENCE * len(text):
                return name, name, reduction, missing, added
        reduction, name, text = ranked[0]
        return (None, name, reduction, *aligned(own, text)[:2])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [("doc_id", pa.int64()), ("block_start", pa.int64()), ("block_length", pa.int64()), ("block", pa.string()), ("license", pa.string()), ("best_template", pa.string()), ("reduction", pa.float64()), ("missing_words", pa.list_(pa.string())), ("added_words", pa.list_(pa.string()))]
    )
    scanner = Scanner()
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            rows = []
            for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                for start, stop in candidate_blocks(text):
                    block = text[start:stop]
                    rows.append((doc, start, stop - start, block, *scanner.identify(block)))
            columns = zip(*rows) if rows else [()] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def scan_licenses(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per candidate block: doc_id, block_start, block_length, block, license, best_template, reduction,
    missing_words, added_words.

    Offsets are code points from 0. ``license`` is null where no template is
    confirmed; then the differences are those to ``best_template``. Whole texts
    are searched; null, empty and other texts without a licensing word give no
    row. Repeated rows are scanned each; a null doc_id is kept; other columns
    are ignored; an empty table gives no rows.
    """
    text = F.col(f"`{text_column}`")
    rows = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), text.alias("text")).where(text.rlike(ANCHOR))
    return rows.mapInArrow(
        _scan,
        "doc_id long, block_start long, block_length long, block string, license string, best_template string, "
        "reduction double, missing_words array<string>, added_words array<string>",
    )
