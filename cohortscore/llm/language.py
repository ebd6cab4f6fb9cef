"""Language identification by compression.

Each language has a zstandard dictionary of raw content: the normalised
beginnings of some of its labelled texts. A text is cut into short blocks and
every block is compressed with each dictionary; the language with the smallest
sum is predicted, and rejected if the next one is nearly as small.
"""

from __future__ import annotations

from collections import Counter

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Labelled texts per language that are learned from, and characters of each; they bound the sample.
SAMPLE_TEXTS, SAMPLE_CHARS = 400, 1_000
#: Bytes of a dictionary, bytes of a block and the compression level.
DICTIONARY_BYTES, BLOCK_BYTES, LEVEL = 128 << 10, 1_500, 6
#: Least relative difference between the two smallest sums.
MARGIN = 0.001
UNKNOWN = "und"
#: Places that hashes are spread over.
_PLACES = 1 << 52

#: ASCII characters other than letters become spaces, bytes of other characters stay.
_LETTERS = bytes(c if c > 127 or chr(c).isalpha() else 32 for c in range(256))


def normal(text: str) -> bytes:
    return b" ".join(text.lower().encode().translate(_LETTERS).split())


def held_out(row_id: Column) -> Column:
    """Rows that are never learned from."""
    return F.crc32(F.coalesce(row_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def learn(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
    sample_texts: int = SAMPLE_TEXTS,
    sample_chars: int = SAMPLE_CHARS,
    dictionary_bytes: int = DICTIONARY_BYTES,
) -> dict[str, bytes]:
    """A dictionary per label from a sample of labelled rows that are not held out.

    Of each label the ``sample_texts`` rows with the smallest hash of their id
    are taken, ``sample_chars`` characters each: so much at most comes to the
    driver for a label. Rows are counted first, so that a task drops those whose
    hash is too large to be among them. Rows with null text or label are not
    learned from.
    """
    row_id = F.col(f"`{id_column}`")
    labelled = docs.where(
        F.col(f"`{lang_column}`").isNotNull() & F.col(f"`{text_column}`").isNotNull() & ~held_out(row_id)
    ).select(
        F.col(f"`{lang_column}`").alias("lang"),
        F.substring(F.col(f"`{text_column}`"), 1, sample_chars).alias("text"),
        (F.xxhash64(row_id).bitwiseAND(F.lit(_PLACES - 1)) / F.lit(float(_PLACES))).alias("at"),
    )
    # Four times the sample is expected below this bound, and never much less.
    bounds = labelled.groupBy("lang").agg((F.lit(4.0 * sample_texts) / F.count(F.lit(1))).alias("bound"))
    # One row per label, of which the driver holds a whole dictionary below.
    bounds = F.broadcast(bounds.withColumnRenamed("lang", "label"))
    near = labelled.join(bounds, F.col("lang") == F.col("label")).where("at < bound")
    first = F.row_number().over(W.partitionBy("lang").orderBy("at", "text"))
    sample = near.withColumn("n", first).where(F.col("n") <= sample_texts)
    found: dict[str, list[bytes]] = {}
    for row in sample.orderBy("lang", "n").select("lang", "text").collect():
        found.setdefault(row["lang"], []).append(normal(row["text"]))
    joined = {lang: b" ".join(x for x in texts if x)[:dictionary_bytes] for lang, texts in found.items()}
    return {lang: data for lang, data in joined.items() if data}


def blocks(data: bytes, size: int) -> list[bytes]:
    """Pieces of at most ``size`` bytes, cut at spaces where there are any."""
    out, at = [], 0
    while at < len(data):
        end = at + size
        if end < len(data):
            space = data.rfind(b" ", at + 1, end)
            end = space if space > 0 else end
        out.append(data[at:end])
        at = end
    return out


class Classifier:
    def __init__(self, dictionaries: dict[str, bytes], block_bytes: int = BLOCK_BYTES, level: int = LEVEL):
        self.block_bytes = block_bytes
        self.languages = sorted(dictionaries)
        self.words = self._shares({lang: Counter(data.split()) for lang, data in dictionaries.items()})
        self.encoders = {
            lang: zstandard.ZstdCompressor(
                level=level,
                dict_data=zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT),
                write_content_size=False,
                write_checksum=False,
                write_dict_id=False,
            )
            for lang, data in dictionaries.items()
        }

    @staticmethod
    def _shares(counts: dict[str, Counter]) -> dict[str, dict[bytes, float]]:
        """Of each word's frequencies in the languages, the share of each language."""
        rates = {lang: {w: n / c.total() for w, n in c.items()} for lang, c in counts.items()}
        whole: Counter = Counter()
        for r in rates.values():
            whole.update(r)
        return {lang: {w: x / whole[w] for w, x in r.items()} for lang, r in rates.items()}

    def sizes(self, text: str) -> dict[str, float]:
        """Compressed bytes by language, less its mean share in the text's words.

        That share, below one byte, decides between languages of equal size,
        which short texts often have.
        """
        data = normal(text)
        words, parts = data.split(), blocks(data, self.block_bytes)
        return {
            lang: sum(len(encoder.compress(p)) for p in parts)
            - sum(self.words[lang].get(w, 0.0) for w in words) / (len(words) + 1)
            for lang, encoder in self.encoders.items()
        }

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language and by how much its size is below the next one's, from 0 to 1."""
        if not self.encoders or not text or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        sizes = self.sizes(text)
        best, *others = sorted(self.languages, key=lambda lang: (sizes[lang], lang))
        if not others:
            return best, 1.0
        following = sizes[others[0]]
        return best, min(1.0, max(0.0, 1 - sizes[best] / following)) if following > 0 else 0.0


def predictor(dictionaries: dict[str, bytes], block_bytes: int = BLOCK_BYTES, level: int = LEVEL):
    """A function of a text column to struct (lang, score)."""
    kind = T.StructType([T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType())])

    @F.pandas_udf(kind)
    def predict(texts: pd.Series) -> pd.DataFrame:
        classifier = Classifier(dictionaries, block_bytes, level)
        return pd.DataFrame([classifier.predict(t) for t in texts], columns=["lang", "score"])

    return predict


def identify(
    docs: DataFrame,
    dictionaries: dict[str, bytes] | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
    margin: float = MARGIN,
) -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred, score, rejected.

    The whole text is compressed. Null texts and texts without a letter are
    ``und`` with score 0 and rejected, as is all if nothing could be learned.
    Equal sizes go to the first language by name. ``rejected`` says that the
    score is below ``margin``. Dictionaries are learned from ``docs`` unless
    given. Repeated rows are kept, other columns ignored, an empty table gives
    no rows.
    """
    if dictionaries is None:
        dictionaries = learn(docs, id_column, text_column, lang_column)
    row_id = F.col(f"`{id_column}`")
    found = docs.select(
        row_id.alias("doc_id"), held_out(row_id).alias("held_out"), predictor(dictionaries)(F.col(f"`{text_column}`")).alias("p")
    )
    return found.select(
        "doc_id", "held_out", F.col("p.lang").alias("lang_pred"), "p.score", (F.col("p.score") < margin).alias("rejected")
    )


def keep_identified(
    docs: DataFrame,
    dictionaries: dict[str, bytes] | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
    margin: float = MARGIN,
) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with all columns; cases as in ``identify``."""
    if dictionaries is None:
        dictionaries = learn(docs, id_column, text_column, lang_column)
    return docs.where(predictor(dictionaries)(F.col(f"`{text_column}`"))["score"] >= margin)
