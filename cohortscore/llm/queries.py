"""The operators of this subpackage over whole benchmark tables, with SQL checks where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortscore.llm import (
    chat,
    exact,
    language,
    licenses,
    mixing,
    packing,
    pages,
    phrases,
    pieces,
    search,
    simhash,
    substrings,
    vectors,
)

QUERIES: dict = {}
CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None):
    def add(function):
        QUERIES[name] = function
        if check:
            CHECKS[name] = check
        return function

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op1_packing")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents")).drop("ids")


@query("op2_language_id")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(table(spark, folder, "documents"))


_SUBSTRING_SQL = r"""
WITH split AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), words AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos, len(w) AS n FROM split
), windows AS (
  SELECT doc_id, pos, word, CASE WHEN pos <= n - 12 THEN string_agg(word, ' ') OVER next END AS seq
  FROM words WINDOW next AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING)
), firsts AS (
  SELECT seq, min(doc_id) AS first_id FROM windows WHERE seq IS NOT NULL GROUP BY seq
), lost AS (
  SELECT w.doc_id, w.pos, w.word, coalesce(f.first_id < w.doc_id, false) AS lost
  FROM windows w LEFT JOIN firsts f ON w.seq = f.seq
), covered AS (
  SELECT doc_id, pos, word, max(CASE WHEN lost THEN 1 ELSE 0 END) OVER prev AS gone
  FROM lost WINDOW prev AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 12 PRECEDING AND CURRENT ROW)
), done AS (
  SELECT doc_id, count(*) AS n_words, sum(gone) AS n_removed,
         string_agg(word, ' ' ORDER BY pos) FILTER (gone = 0) AS kept
  FROM covered GROUP BY doc_id
)
SELECT d.doc_id, CAST(coalesce(n_words, 0) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN done USING (doc_id)
"""


@query("op3_substring_dedup", _SUBSTRING_SQL)
def op3(spark: SparkSession, folder: str) -> DataFrame:
    done = substrings.remove_repeats(table(spark, folder, "documents"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


_MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, md5(concat('mix:', doc_id)) AS key,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents
), by_source AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT *, CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS w, 3 * source_size AS cap
  FROM by_source
), levels AS (
  SELECT *, cap / w AS ratio,
         (sum(source_size) OVER () - coalesce(sum(cap) OVER prev, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER prev, 0)) AS level
  FROM weighed WINDOW prev AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
  SELECT source, source_size,
         least(CAST(cap AS DOUBLE), (SELECT level FROM levels WHERE level <= ratio ORDER BY ratio, source LIMIT 1) * w) AS target
  FROM levels
), rest AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target) AS BIGINT) // source_size ELSE 0 END AS epochs,
         CASE WHEN source_size > 0 THEN CAST(floor(target) AS BIGINT) % source_size ELSE 0 END AS rest
  FROM targets
), placed AS (
  SELECT s.doc_id, s.size, r.source_size, r.target, r.epochs, r.rest,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key) - s.size AS start
  FROM sized s JOIN rest r ON s.source IS NOT DISTINCT FROM r.source
)
SELECT doc_id, size, source_size, target,
       CAST(epochs * size + least(size, greatest(rest - start, 0)) AS BIGINT) AS taken
FROM placed
"""


@query("op4_mixing", _MIX_SQL)
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents")).drop("source")


_CHAT_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), sized AS (
  SELECT *, length(replace(replace(role, '\', '\\'), '<|', '<\|')) + length(replace(replace(text, '\', '\\'), '<|', '<\|'))
            + length('<|im_start|><|im_sep|><|im_end|>') AS chars
  FROM rows
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(concat(role, chr(10), text, chr(10)), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""


@query("op5_chat_formatting", _CHAT_SQL)
def op5(spark: SparkSession, folder: str) -> DataFrame:
    said = "<|im_end|><|im_start|>assistant ok"
    own = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    given = table(spark, folder, "conversations").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text"
    )
    messages = given.unionAll(own).select("conv_id", "turn", "role", chat.text_parts(F.col("text")).alias("parts"))
    done = chat.format_conversations(messages)
    read = done.select("conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("turns"), chat.masked_text(F.col("pieces")).alias("loss"))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


_EXACT_SQL = """
WITH normal AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents
)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM normal WINDOW w AS (PARTITION BY norm)
"""


@query("op6_exact_dedup", _EXACT_SQL)
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return exact.copy_groups(table(spark, folder, "documents"), keep="largest")


@query("op7_embedding_dedup")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.near_vectors(table(spark, folder, "embeddings"))


@query("op8_simhash_dedup")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_groups(table(spark, folder, "documents"))


@query("op9_html_extraction")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return pages.extract_pages(table(spark, folder, "pages"))


@query("op10_license_scan")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, folder, "documents"))


@query("op11_sentencepiece")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    done = pieces.encode_texts(table(spark, folder, "documents"), decoded=True)
    return done.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


_SEARCH_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM documents
), total AS (
  SELECT count(*) FILTER (len(t) > 0) AS n_docs, sum(len(t))::BIGINT AS n_terms FROM words
), occurrences AS (
  SELECT doc_id, len(t) AS n, unnest(t) AS term FROM words
), postings AS (
  SELECT doc_id, term, any_value(n)::BIGINT AS n, count(*) AS tf FROM occurrences GROUP BY doc_id, term
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * any_value(n_docs) + 2) / (2.0::DOUBLE * count(*) + 1))) AS BIGINT) AS w
  FROM postings, total GROUP BY term
), asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), scored AS (
  SELECT item_id, doc_id,
         CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM asked JOIN postings USING (term) JOIN weights USING (term), total GROUP BY item_id, doc_id
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""


@query("op12_ranked_search", _SEARCH_SQL)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return search.rank_documents(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


_PHRASE_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), words AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), grams AS (
  SELECT lang, k AS n, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM words, range(1, 5) AS ks(k) WHERE len(w) >= k
), counts AS (
  SELECT lang, n, phrase, count(*) AS f FROM grams GROUP BY lang, n, phrase HAVING count(*) >= 30
), totals AS (
  SELECT lang, CAST(sum(len(w)) AS BIGINT) AS total FROM words GROUP BY lang
), cuts AS (
  SELECT lang, phrase, f AS a, k, array_to_string(string_split(phrase, ' ')[:k], ' ') AS head,
         array_to_string(string_split(phrase, ' ')[k + 1:], ' ') AS tail
  FROM counts, range(1, 4) AS ks(k) WHERE n >= 2 AND k < n
), scored AS (
  SELECT c.*, h.f AS l, t.f AS r, CAST((2000000::HUGEINT * a) // (h.f::HUGEINT + t.f) AS BIGINT) AS score
  FROM cuts c JOIN counts h ON c.lang = h.lang AND c.head = h.phrase JOIN counts t ON c.lang = t.lang AND c.tail = t.phrase
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), covers AS (
  SELECT lang, phrase, max(f) AS longer FROM (
    SELECT lang, f, array_to_string(string_split(phrase, ' ')[s:s + m - 1], ' ') AS phrase
    FROM counts, range(2, 4) AS ms(m), range(1, 4) AS ss(s) WHERE m < n AND s + m - 1 <= n
  ) GROUP BY lang, phrase
), kept AS (
  SELECT s.* FROM lowest s LEFT JOIN covers c ON s.lang = c.lang AND s.phrase = c.phrase
  WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, total AS n, score
FROM kept JOIN totals USING (lang) QUALIFY rank <= 2000
"""


@query("op13_phrase_mining", _PHRASE_SQL)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.mine_phrases(table(spark, folder, "documents"))
