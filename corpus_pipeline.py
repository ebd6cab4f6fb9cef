"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. All but the
last return the columns of ``documents``; the last returns the pieces of the
packed sequences. Outputs are stored between stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortscore.llm import exact, language, mixing, packing, simhash
from cohortscore.session import settle


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that compression tells; what it rejects goes."""
    return language.keep_identified(docs)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, A-Z and a-z alike."""
    return exact.drop_copies(docs, keep="largest")


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each group whose fingerprints of four-word shingles link within four bits."""
    return simhash.drop_near_copies(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target weights: a row for each time a document is taken."""
    return mixing.mixed_rows(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 1024 tokens, with their ids."""
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", identified),
    ("exact_dedup", without_copies),
    ("simhash_dedup", without_near_copies),
    ("mixing", mixed),
    ("packing", packed),
]

#: SQL has no compression, XXH64 or tokenizer; a test compares the whole run with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = settle(docs)
    return docs


QUERIES = {"pipeline": run}
CHECKS = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
