"""Encounters and scored rows derived from the benchmark tables.

Both derivations are plain SQL in the dialect Spark and DuckDB share, so each
query and its check start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# How order keys become encounter columns.
ENCOUNTERS = """
SELECT
  o_orderkey AS encounter_id,
  o_custkey AS patient_nbr,
  CAST(o_orderkey * 7 % 14 + 1 AS INT) AS time_in_hospital,
  CAST((o_orderkey * 31 + o_custkey) % 90 AS INT) AS num_lab_procedures,
  CAST(o_orderkey * 13 % 7 AS INT) AS num_procedures,
  CAST((o_custkey * 11 + o_orderkey) % 40 + CASE WHEN o_orderstatus = 'F' THEN 6 ELSE 0 END AS INT) AS num_medications,
  CAST(o_custkey % 5 AS INT) AS number_outpatient,
  CAST(o_orderkey * 17 % 4 AS INT) AS number_emergency,
  CAST(o_orderkey * 3 % 5 + CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS INT) AS number_inpatient,
  CAST(o_orderkey * 19 % 9 + 1 AS INT) AS number_diagnoses,
  CASE WHEN o_orderkey % 11 = 0 THEN 'Steady' ELSE 'No' END AS repaglinide,
  CASE WHEN o_orderkey % 13 = 0 THEN 'Up' ELSE 'No' END AS `glyburide.metformin`,
  c_mktsegment AS payer_code,
  CASE o_orderstatus WHEN 'P' THEN 'NO' WHEN 'O' THEN '>30' ELSE '<30' END AS readmitted,
  CASE o_orderkey % 4 WHEN 0 THEN 'No' WHEN 1 THEN 'Steady' WHEN 2 THEN 'Down' ELSE 'Up' END AS metformin,
  CASE o_custkey % 4 WHEN 0 THEN 'No' WHEN 1 THEN 'Steady' WHEN 2 THEN 'Down' ELSE 'Up' END AS glipizide,
  CASE WHEN o_orderkey * 5 % 9 < 6 THEN 'No' ELSE 'Steady' END AS glyburide,
  CASE (o_orderkey + o_custkey) % 4 WHEN 0 THEN 'No' WHEN 1 THEN 'Steady' WHEN 2 THEN 'Down' ELSE 'Up' END AS insulin,
  CASE WHEN (o_orderkey + o_custkey) % 3 = 0 THEN 'Ch' ELSE 'No' END AS change,
  CASE WHEN o_custkey % 7 < 5 THEN 'Yes' ELSE 'No' END AS diabetesMed,
  CASE WHEN o_orderkey % 50 = 7 THEN NULL
       WHEN o_orderkey % 50 = 9 THEN '?'
       WHEN o_orderkey % 17 = 3 THEN 'V' || CAST(o_orderkey % 90 + 1 AS STRING)
       WHEN o_orderkey % 19 = 4 THEN 'E' || CAST(o_orderkey % 80 + 850 AS STRING)
       WHEN o_orderkey % 23 = 5 THEN CAST(o_orderkey * 37 % 1000 AS STRING) || '.83'
       ELSE CAST(o_orderkey * 37 % 1000 AS STRING) END AS diag_1,
  CASE WHEN o_custkey % 40 = 7 THEN NULL
       WHEN o_custkey % 40 = 9 THEN '?'
       WHEN o_orderkey % 13 = 3 THEN 'V45.81'
       WHEN o_orderkey % 29 = 4 THEN '250.' || CAST(o_orderkey % 100 AS STRING)
       ELSE CAST((o_orderkey * 53 + o_custkey) % 1000 AS STRING) END AS diag_2,
  CASE WHEN (o_orderkey + o_custkey) % 60 = 7 THEN NULL
       WHEN o_custkey % 31 = 3 THEN 'E' || CAST(o_custkey % 100 + 800 AS STRING)
       ELSE CAST((o_orderkey * 71 + o_custkey * 3) % 1000 AS STRING) END AS diag_3,
  CASE o_orderkey * 3 % 10
    WHEN 0 THEN '[0-10)' WHEN 1 THEN '[10-20)' WHEN 2 THEN '[20-30)' WHEN 3 THEN '[30-40)'
    WHEN 4 THEN '[40-50)' WHEN 5 THEN '[50-60)' WHEN 6 THEN '[60-70)' WHEN 7 THEN '[70-80)'
    WHEN 8 THEN '[80-90)' ELSE '[90-100)' END AS age,
  CAST(o_orderkey % 8 + 1 AS INT) AS admission_type_id,
  CAST((o_orderkey * 7 + o_custkey) % 30 + 1 AS INT) AS discharge_disposition_id,
  CASE WHEN o_custkey % 45 = 11 THEN NULL ELSE CAST(o_custkey % 25 + 1 AS INT) END AS admission_source_id,
  CASE WHEN o_orderkey % 50 = 0 THEN NULL
       WHEN c_nationkey % 5 < 2 THEN 'Caucasian' WHEN c_nationkey % 5 = 2 THEN 'AfricanAmerican'
       WHEN c_nationkey % 5 = 3 THEN 'Asian' ELSE 'Hispanic' END AS race,
  CASE WHEN o_orderkey % 97 = 5 THEN 'Unknown/Invalid' WHEN o_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
  CASE o_orderkey % 5 WHEN 0 THEN 'None' WHEN 1 THEN NULL WHEN 2 THEN '>7' WHEN 3 THEN '>8' ELSE 'Norm' END AS A1Cresult,
  CASE o_custkey % 4 WHEN 0 THEN 'None' WHEN 1 THEN '>200' WHEN 2 THEN '>300' ELSE 'Norm' END AS max_glu_serum
FROM {orders} JOIN {customer} ON o_custkey = c_custkey
"""

SCORED = """
SELECT
  o_orderkey AS id,
  CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS readmitted,
  CAST(o_orderkey * 7919 % 850 + CASE WHEN o_orderstatus = 'F' THEN 150 ELSE 0 END AS DOUBLE) / 1000 AS xgb_prob,
  CAST((o_custkey * 6151 + o_orderkey * 389) % 997 AS DOUBLE) / 997 AS nn_prob,
  o_orderpriority AS priority
FROM {orders}
"""

SCORED_LINES = """
SELECT
  CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS readmitted,
  CAST((l_orderkey * 7919 + l_partkey * 31) % 8500 + CASE WHEN l_returnflag = 'R' THEN 1500 ELSE 0 END AS DOUBLE)
    / 10000 AS xgb_prob,
  CAST((l_partkey * 6151 + l_orderkey * 389 + l_linenumber * 7) % 9973 AS DOUBLE) / 9973 AS nn_prob
FROM {lineitem}
"""

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _derive(spark: SparkSession, folder: str, text: str) -> DataFrame:
    used = {t: table(spark, folder, t) for t in TABLES if "{" + t + "}" in text}
    return spark.sql(text, **used)


def encounters(spark: SparkSession, folder: str) -> DataFrame:
    return _derive(spark, folder, ENCOUNTERS)


def scored(spark: SparkSession, folder: str) -> DataFrame:
    return _derive(spark, folder, SCORED)


def scored_lines(spark: SparkSession, folder: str) -> DataFrame:
    return _derive(spark, folder, SCORED_LINES)


def duck(text: str) -> str:
    """The same derivation as a DuckDB subquery."""
    for t in TABLES:
        text = text.replace("{" + t + "}", t)
    return text.replace("AS STRING)", "AS VARCHAR)").replace("`", '"').strip()


def with_encounters(rest: str) -> str:
    return f"WITH encounters AS ({duck(ENCOUNTERS)})\n{rest}"


def with_scored(rest: str) -> str:
    return f"WITH scored AS ({duck(SCORED)})\n{rest}"


def with_lines(rest: str) -> str:
    return f"WITH scored AS ({duck(SCORED_LINES)})\n{rest}"
