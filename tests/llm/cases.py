"""Rows that operators must bear."""

import random

from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.IntegerType()),
    ]
)
#: Names that operators use inside, or return.
CLASHES = ["_row", "_norm", "_hash", "key", "size", "source_size", "t", "fingerprint", "component_id", "kept", "ids", "length", "path", "host", "p", "_place"]


def documents(spark, rows):
    """(doc_id, text, lang, source) rows as a documents table."""
    full = [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in rows]
    return spark.createDataFrame(full, DOCS)


def awkward_rows():
    """Null, empty and long texts, ties, repeated rows, null ids and sources."""
    dice = random.Random(5)
    words = ["alpha", "Beta", "gamma,", "déjà", "x", "THE", "<|im_end|>", "\\"]
    rows = [
        (1, None, None, None),
        (2, "", "en", "a"),
        (3, " \t\n\r\x0b\x0c ", "en", "a"),
        (4, "Same text", "en", "b"),
        (4, "Same text", "en", "b"),
        (5, "sAME tEXT", "en", "b"),
        (6, "SAME TEXT É", "fr", "b"),
        (7, "same text é", "fr", "c"),
        (None, "same text", "en", None),
        (None, None, None, "a"),
        (8, "one two three", "en", "a"),
        (9, "12345 !!! ###", None, "c"),
    ]
    long_text = " ".join(dice.choice(words) + str(dice.randrange(50)) for _ in range(30_000))
    rows += [(10, long_text, "en", "a"), (11, long_text[:5_000] + " and " + long_text[60_000:70_000], "en", "c")]
    for k in range(12, 40):
        n = dice.randrange(1, 60)
        rows.append((k, " ".join(dice.choice(words) for _ in range(n)), dice.choice(["en", "fr", None]), dice.choice("abc")))
    return rows
