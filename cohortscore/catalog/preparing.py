"""Queries on encounters: sources, cleaning, recodes, encoding, splits, lists."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortscore.catalog.inputs import encounters, scored, table, with_encounters, with_scored
from cohortscore.catalog.registry import query, rounded
from cohortscore.functions.diagnosis import (
    CHAPTER_RANGES, chapter_of, diagnosis_group, external_cause_to_injury, range_table, ungrouped_to_nothing,
)
from cohortscore.functions.labels import (
    binary_label, coerce_label, complete_label, label_violations, normalize_label, strict_label,
)
from cohortscore.functions.numeric import clip_upper, quoted, text_to_double
from cohortscore.functions.recode import (
    AGE_BRACKETS, ANY_MEDICATION, DISCHARGE_LABELS, MEDICATION_CHANGED, MEDICATION_USED,
    READMITTED_WITHIN_30, fill_missing, merge_admission_types, recode, recode_int, recode_ordinal, recode_position,
)
from cohortscore.functions.responses import log_metrics, parse_responses, scores_from_json
from cohortscore.operators.columns import (
    missing_columns,
    align_to_schema, apply_selected_features, attach_scores, by_tag, complete_rows, conform_columns, drop_columns,
    keep_unless, lookup, move_to_front, non_finite_count, prepare_frame, range_lookup, rename_columns, schema_diff,
    select_numeric, select_ranked,
)
from cohortscore.operators.encode import cast_all_int, fit_category_table, fit_one_hot, int_residue
from cohortscore.operators.profile import (
    best_jobs, class_balance, class_weights, correlations, describe_numeric, describe_text, distinct_over,
    full_profile, long_values, modes, null_counts, profile_counts, top_categories, value_counts, weight_bounds,
)
from cohortscore.operators.scale import column_means, fit_mean_fill, fit_scaler
from cohortscore.operators.select import (
    average_importances, keep_share, largest_p_value, moments, rank_features, select_cumulative, select_features, select_top,
    single_fits,
)
from cohortscore.operators.split import (
    k_folds, seeded_positions, seeded_sample, split_by_share, stratified_folds, stratified_split,
)
from cohortscore.operators.sweep import threshold_sweep
from cohortscore.plans.engineering import DUMMY_COLUMNS, clean_encounters, engineer, fit_encoder
from cohortscore.plans.evaluation import evaluate
from cohortscore.session import run_folder, settle
from cohortscore.sources.features import (
    feature_list, follow_pointers, headerless_list, latest_list, list_difference, membership, resolve_list,
    text_list, write_feature_list,
)
from cohortscore.sources.listing import latest_predictions, latest_reports
from cohortscore.sources.reports import (
    read_summary_json, summary_json, write_json, write_metric_tables,
)
from cohortscore.sources.tables import (
    ADMISSION_COLUMNS, COUNT_COLUMNS, DIAGNOSES, MEDICATIONS, RARE_MEDICATIONS, UNUSED_COLUMNS, compact_predictions, encounter_schema, fold_pair,
    read_encounters, read_many, read_table_any, with_predictions, write_folds, write_label_first, write_table,
    write_vectors, write_with_predictions,
)

# ---- SQL building blocks ----------------------------------------------------

IS_NUM = r"coalesce(regexp_full_match({c}, '\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*'), false)"


def sql_number(c: str) -> str:
    return f"CASE WHEN {IS_NUM.format(c=c)} THEN CAST(trim({c}) AS DOUBLE) END"


def sql_chapter(c: str) -> str:
    n = f"CAST(trunc({sql_number(c)}) AS INT)"
    return "CASE " + " ".join(f"WHEN {n} >= {lo} AND {n} < {hi} THEN '{v}'" for lo, hi, v in CHAPTER_RANGES) + " END"


def sql_group(c: str) -> str:
    return (
        f"coalesce({sql_chapter(c)}, CASE WHEN {IS_NUM.format(c=c)} THEN 'Nothing' "
        f"ELSE regexp_replace({c}, '^[VE][0-9]+', 'injury') END)"
    )


def sql_list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


CLEAN = f""", cleaned AS (SELECT encounter_id,
  CASE readmitted WHEN '<30' THEN 1 ELSE 0 END AS readmitted, {", ".join(COUNT_COLUMNS)},
  CASE metformin WHEN 'No' THEN 0 ELSE 1 END AS medication_metformin, CASE glipizide WHEN 'No' THEN 0 ELSE 1 END AS medication_glipizide,
  CASE glyburide WHEN 'No' THEN 0 ELSE 1 END AS medication_glyburide, CASE insulin WHEN 'No' THEN 0 ELSE 1 END AS medication_insulin,
  CASE change WHEN 'Ch' THEN 1 ELSE 0 END AS change, CASE diabetesMed WHEN 'Yes' THEN 1 ELSE 0 END AS any_medication,
  {", ".join(f"{sql_group(c)} AS {c}" for c in DIAGNOSES)},
  list_position({sql_list(AGE_BRACKETS)}, age)::INT AS age,
  CASE WHEN admission_type_id IN (6, 8) THEN 5 ELSE admission_type_id END AS admission_type_id,
  {sql_list(DISCHARGE_LABELS)}[discharge_disposition_id] AS discharge_disposition,
  CASE WHEN admission_source_id > 8 THEN 8 ELSE admission_source_id END AS admission_source_id,
  coalesce(race, 'Other') AS race, CASE gender WHEN 'Unknown/Invalid' THEN 'Female' ELSE gender END AS gender,
  CASE WHEN A1Cresult IS NULL OR A1Cresult = 'None' THEN 'NotTaken' ELSE A1Cresult END AS A1Cresult,
  CASE WHEN max_glu_serum IS NULL OR max_glu_serum = 'None' THEN 'NotTaken' ELSE max_glu_serum END AS max_glu_serum
  FROM encounters WHERE {sql_list(DISCHARGE_LABELS)}[discharge_disposition_id] IS DISTINCT FROM 'died')
"""
# Long form of the columns that become dummies, and their modes.
LONG8 = ", eight AS (" + " UNION ALL ".join(
    f"SELECT encounter_id, '{c}' AS c, CAST({c} AS VARCHAR) AS v FROM cleaned" for c in DUMMY_COLUMNS
) + ")\n"
MODES8 = """, mode8 AS (SELECT c, v FROM (SELECT c, v, count(*) AS n FROM eight WHERE v IS NOT NULL GROUP BY c, v)
  QUALIFY row_number() OVER (PARTITION BY c ORDER BY n DESC, v) = 1)
"""
LONG3 = ", three AS (" + " UNION ALL ".join(f"SELECT encounter_id, {c} AS v FROM cleaned" for c in DIAGNOSES) + ")\n"


def active(names):
    """Names of the dummies that are 1, sorted and joined: one text per row."""
    return F.concat_ws(",", *[F.when(quoted(c) == 1, F.lit(c)) for c in sorted(names)])


def enc(spark, d):
    return encounters(spark, d)


# ---- sources and sinks --------------------------------------------------------


# The columns of the encounters.
ENC_COLUMNS = [
    "encounter_id", "patient_nbr", *COUNT_COLUMNS, "repaglinide", "glyburide.metformin", "payer_code", "readmitted",
    "metformin", "glipizide", "glyburide", "insulin", "change", "diabetesMed", *DIAGNOSES, "age", "admission_type_id",
    "discharge_disposition_id", "admission_source_id", "race", "gender", "A1Cresult", "max_glu_serum",
]


def conformed_sql(absent=()):
    """All columns of the encounter schema, in its order; what the encounters lack is NULL."""
    kinds = {"string": "VARCHAR", "integer": "INTEGER", "long": "BIGINT"}
    columns = []
    for f in encounter_schema().fields:
        given = f'"{f.name}"' if f.name in ENC_COLUMNS and f.name not in absent else "NULL"
        columns.append(f'CAST({given} AS {kinds[f.dataType.typeName()]}) AS "{f.name}"')
    return f"SELECT {', '.join(columns)} FROM encounters"


@query("S1_read_encounters", with_encounters(conformed_sql(["insulin"])))
def _(spark, d):
    path = write_table(enc(spark, d).drop("insulin"), run_folder(spark, "enc") + ".csv")
    return read_encounters(spark, path)


@query("S1_none_as_null", with_encounters("""
SELECT CASE WHEN A1Cresult = 'None' THEN NULL ELSE A1Cresult END AS A1Cresult, count(*) AS n FROM encounters GROUP BY 1"""))
def _(spark, d):
    path = write_table(enc(spark, d), run_folder(spark, "enc") + ".csv")
    return read_encounters(spark, path, none_as_null=True).groupBy("A1Cresult").agg(F.count("*").alias("n"))


@query("S2_read_table_any", """
SELECT f.f AS form, count(*) AS n, round(sum(o_totalprice), 2) AS total, count(DISTINCT o_orderpriority) AS priorities
FROM orders, (SELECT unnest(['csv', 'parquet', 'json']) AS f) f GROUP BY f.f""")
def _(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    out = None
    for form in ("csv", "parquet", "json"):
        path = f"{run_folder(spark, 'any')}.{form}"
        if form == "json":
            o.write.json(path)
        else:
            write_table(o, path)
        back = read_table_any(spark, path)
        part = back.agg(
            F.lit(form).alias("form"), F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"),
            F.countDistinct("o_orderpriority").alias("priorities"),
        )
        out = part if out is None else out.unionByName(part)
    return out


MANY = """
SELECT o_orderkey AS k, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS status,
  CASE WHEN o_orderkey % 2 = 1 THEN o_orderpriority END AS priority FROM orders"""


def many_files(spark, d):
    o = table(spark, d, "orders")
    folder = run_folder(spark, "many")
    even = o.where("o_orderkey % 2 = 0").selectExpr("o_orderkey AS k", "o_orderstatus AS status")
    odd = o.where("o_orderkey % 2 = 1").selectExpr("o_orderpriority AS priority", "o_orderkey AS k")
    for part in (even, odd):
        part.write.mode("append").option("header", True).csv(folder)
    back = read_many(spark, folder)
    return back.select(F.col("k").cast("bigint").alias("k"), "status", "priority")


@query("S3_read_many", MANY)
def _(spark, d):
    return many_files(spark, d)


@query("U1_concat_files", "SELECT status, priority, count(*) AS n FROM (" + MANY + ") GROUP BY ALL")
def _(spark, d):
    return many_files(spark, d).groupBy("status", "priority").agg(F.count("*").alias("n"))


@query("S4_write_table", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def _(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    back = spark.read.option("header", True).csv(write_table(o, run_folder(spark, "t") + ".csv"))
    return back.select(
        F.col("o_orderkey").cast("bigint").alias("o_orderkey"), "o_orderstatus",
        F.col("o_totalprice").cast("double").alias("o_totalprice"),
    )


@query("S5_label_first", with_scored("SELECT readmitted AS c0, id AS c1, xgb_prob AS c2 FROM scored"))
def _(spark, d):
    path = write_label_first(scored(spark, d), "readmitted", run_folder(spark, "first"), ["id", "xgb_prob"])
    return spark.read.schema("c0 int, c1 bigint, c2 double").csv(path)


FOLD_SQL = """, sizes AS (SELECT readmitted AS g, count(*) AS n FROM scored GROUP BY 1)
, skips AS (SELECT g, n, (coalesce(sum(n) OVER (ORDER BY g ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) % 5)::BIGINT AS skip FROM sizes)
, blocks AS (SELECT g, i, n // 5 + CASE WHEN (i - skip + 5) % 5 < n % 5 THEN 1 ELSE 0 END AS size FROM skips, range(5) r(i))
, ends AS (SELECT g, i, sum(size) OVER (PARTITION BY g ORDER BY i) AS hi, sum(size) OVER (PARTITION BY g ORDER BY i) - size AS lo FROM blocks)
, ranked AS (SELECT *, row_number() OVER (PARTITION BY readmitted ORDER BY md5('42:' || id), id) - 1 AS r FROM scored)
, folded AS (SELECT ranked.*, i::INT AS fold FROM ranked JOIN ends ON g = readmitted AND r >= lo AND r < hi)
"""


@query("S6_write_folds", with_scored(FOLD_SQL + """
SELECT 'train' AS part, k::INT AS k, count(*) AS n, sum(readmitted)::BIGINT AS pos FROM folded, range(5) t(k) WHERE fold <> k GROUP BY k
UNION ALL SELECT 'validation', fold, count(*), sum(readmitted)::BIGINT FROM folded GROUP BY fold"""))
def _(spark, d):
    rows = stratified_folds(scored(spark, d), "id", "readmitted").select("readmitted", "id", "xgb_prob", "fold")
    path = write_folds(rows, run_folder(spark, "folds"))
    back = spark.read.schema("readmitted int, id bigint, xgb_prob double, fold int").option("header", True).csv(path)
    out = None
    for k in range(5):
        for name, part in zip(("train", "validation"), fold_pair(back, k)):
            row = part.agg(F.count("*").alias("n"), F.sum("readmitted").alias("pos")).select(
                F.lit(name).alias("part"), F.lit(k).alias("k"), "n", "pos"
            )
            out = row if out is None else out.unionByName(row)
    return out


@query("S7_write_vectors", """
SELECT l_label AS label, n, s FROM (SELECT label::DOUBLE AS l_label, count(*) AS n, round(sum(list_sum(embedding)), 3) AS s FROM embeddings GROUP BY 1)""")
def _(spark, d):
    e = table(spark, d, "embeddings")
    width = e.select(F.max(F.size("embedding"))).first()[0]
    wide = e.select("label", *[F.get("embedding", F.lit(i)).cast("double").alias(f"e{i}") for i in range(width)])
    path = write_vectors(wide, "label", [f"e{i}" for i in range(width)], run_folder(spark, "vectors"))
    back = spark.read.parquet(path).select("label", vector_to_array("features").alias("v"))
    return back.groupBy("label").agg(
        F.count("*").alias("n"),
        F.round(F.sum(F.aggregate("v", F.lit(0.0), lambda a, x: a + x)), 3).alias("s"),
    )


@query("S8_feature_list", """
SELECT p_type AS feature, count(*) AS n FROM part WHERE p_type IS NOT NULL GROUP BY 1""")
def _(spark, d):
    listed = table(spark, d, "part").select("p_partkey", F.col("p_type").alias("feature"))
    return feature_list(listed).groupBy("feature").agg(F.count("*").alias("n"))


LINES = """lines AS (SELECT p_partkey AS pos, CASE WHEN p_partkey = (SELECT min(p_partkey) FROM part) THEN ' Features ,x'
  WHEN p_partkey % 10 = 3 THEN '   ' WHEN p_partkey % 10 = 4 THEN 'feature' ELSE '  ' || p_type || ' ' || p_size || ' , 1' END AS line FROM part)"""


def list_lines(spark, d):
    return spark.sql("WITH " + LINES.replace("FROM part)", "FROM {part})", 2).replace("(SELECT min(p_partkey) FROM part)", "(SELECT min(p_partkey) FROM {part})") + " SELECT * FROM lines", part=table(spark, d, "part"))


@query("S9_headerless_list", "WITH " + LINES + """
SELECT pos, feature FROM (SELECT pos, trim(split_part(line, ',', 1)) AS feature FROM lines)
WHERE feature <> '' AND NOT (pos = (SELECT min(pos) FROM lines) AND lower(feature) IN ('selected_features', 'feature', 'features'))""")
def _(spark, d):
    return headerless_list(list_lines(spark, d))


@query("S10_text_list", "WITH " + LINES + "SELECT pos, trim(line) AS feature FROM lines WHERE trim(line) <> ''")
def _(spark, d):
    return text_list(list_lines(spark, d))


@query("S11_resolve_list", """
SELECT 'text' AS source, p_partkey AS pos, p_type AS feature FROM part WHERE p_size < 5""")
def _(spark, d):
    p = table(spark, d, "part")

    def candidate(priority, source, where, feature):
        return p.where(where).select(
            F.lit(priority).alias("priority"), F.lit(source).alias("source"), F.col("p_partkey").alias("pos"), feature.alias("feature")
        )

    candidates = (
        candidate(1, "explicit", "p_size < 0", F.col("p_type"))
        .unionByName(candidate(2, "tag", "p_size < 9", F.lit("  ")))
        .unionByName(candidate(3, "text", "p_size < 5", F.col("p_type")))
        .unionByName(candidate(4, "default", "p_size >= 0", F.col("p_brand")))
    )
    return resolve_list(candidates)


@query("S11_follow_pointers", """
SELECT 'pointer-' || s_nationkey AS source, p_partkey AS pos, p_type AS feature FROM supplier
JOIN part ON p_brand = 'Brand#' || (s_nationkey % 5 + 1) || '1' WHERE s_suppkey IN (SELECT min(s_suppkey) FROM supplier GROUP BY s_nationkey)""")
def _(spark, d):
    s, p = table(spark, d, "supplier"), table(spark, d, "part")
    pointers = s.groupBy("s_nationkey").agg(F.min("s_suppkey")).select(
        F.lit(1).alias("priority"), F.concat(F.lit("pointer-"), "s_nationkey").alias("source"),
        F.concat(F.lit(" Brand#"), F.col("s_nationkey") % 5 + 1, F.lit("1 ")).alias("target"),
    )
    lists = p.select(F.col("p_brand").alias("path"), F.col("p_partkey").alias("pos"), F.col("p_type").alias("feature"))
    return follow_pointers(pointers, lists).select("source", "pos", "feature")


@query("S12_write_feature_list", "SELECT p_partkey AS pos, p_type AS feature, 'run-2' AS run_id FROM part WHERE p_size % 2 = 1")
def _(spark, d):
    p = table(spark, d, "part").select(F.col("p_partkey").alias("pos"), F.col("p_type").alias("feature"), "p_size")
    path = run_folder(spark, "lists")
    write_feature_list(p.where("p_size % 2 = 0"), path, "run-1", "job-a")
    write_feature_list(p.where("p_size % 2 = 1"), path, "run-2")
    return latest_list(spark.read.parquet(path)).select("pos", "feature", "run_id")


LISTING = """SELECT 'scored/' || CASE event_type WHEN 'click' THEN 'Test_' WHEN 'view' THEN 'train_' WHEN 'error' THEN 'summary_' ELSE 'point_metrics_' END
  || CAST(event_id AS {s}) || CASE WHEN user_id % 3 = 0 THEN '_with_predictions.csv' WHEN user_id % 3 = 1 THEN '.csv' ELSE '_report_.html' END AS path,
  ts AS modified FROM {events}"""


@query("S13_latest_predictions", "WITH l AS (" + LISTING.format(s="VARCHAR", events="events") + """)
SELECT k AS kind, arg_max(path, {'m': modified, 'p': path}) AS path FROM l, (SELECT unnest(['test', 'train']) AS k)
WHERE lower(path) LIKE '%\\_with\\_predictions.csv' ESCAPE '\\' AND contains(lower(path), k) GROUP BY k""")
def _(spark, d):
    return latest_predictions(spark.sql(LISTING.replace("{s}", "STRING"), events=table(spark, d, "events")))


@query("S14_latest_reports", "WITH l AS (" + LISTING.format(s="VARCHAR", events="events") + """)
, t AS (SELECT *, 'summary' AS kind FROM l WHERE ends_with(path, '.csv') AND contains(path, 'summary_')
  UNION ALL SELECT *, 'point_metrics' FROM l WHERE ends_with(path, '.csv') AND contains(path, 'point_metrics_')
  UNION ALL SELECT *, 'report' FROM l WHERE ends_with(path, '.html') AND contains(path, 'report_'))
SELECT kind, arg_max(path, {'m': modified, 'p': path}) AS path FROM t GROUP BY kind""")
def _(spark, d):
    return latest_reports(spark.sql(LISTING.replace("{s}", "STRING"), events=table(spark, d, "events")))


@query("S15_compact_predictions", with_scored("SELECT id, xgb_prob, nn_prob FROM scored"))
def _(spark, d):
    path = write_table(compact_predictions(scored(spark, d)), run_folder(spark, "compact"))
    return spark.read.parquet(path)


@query("S16_with_predictions", with_scored("SELECT id, readmitted, xgb_prob, priority, NULL::DOUBLE AS nn_prob FROM scored"))
def _(spark, d):
    one = scored(spark, d).drop("nn_prob")
    path = write_with_predictions(one, "readmitted", run_folder(spark, "full"), "in/holdout.csv")
    schema = "id bigint, readmitted int, xgb_prob double, priority string, nn_prob double"
    return spark.read.schema(schema).option("header", True).csv(path)


SUMMARY = """, s AS (SELECT CASE m WHEN 'xgb_prob' THEN 'xgb' WHEN 'nn_prob' THEN 'nn' ELSE 'ensemble_avg' END AS model, x, y FROM (
  SELECT 'xgb_prob' AS m, xgb_prob AS x, readmitted AS y FROM scored UNION ALL SELECT 'nn_prob', nn_prob, readmitted FROM scored
  UNION ALL SELECT 'e', (xgb_prob + nn_prob) / 2.0::DOUBLE, readmitted FROM scored))
"""


@query("S17_summary_json", with_scored(SUMMARY + "SELECT model, round(avg((x - y) * (x - y)), 6) AS brier FROM s GROUP BY model"))
def _(spark, d):
    e = evaluate(scored(spark, d))
    facts = {"label_col": e.label, "xgb_col": e.xgb, "nn_col": e.nn, "thresholds": [0.2, 0.3, 0.5], "outputs": {"summary_csv": "summary"}}
    path = write_json(summary_json(e.summary, facts), run_folder(spark, "json"))
    return rounded(read_summary_json(spark, path)).select("model", "brier")


@query("S19_metric_tables", with_scored(SUMMARY + """
SELECT model, t AS threshold, count(*) FILTER (WHERE x >= t AND y = 1) AS tp, count(*) FILTER (WHERE x >= t AND y = 0) AS fp, 'r1' AS run_id
FROM s, (SELECT unnest([0.2, 0.3, 0.5])::DOUBLE AS t) GROUP BY model, t"""))
def _(spark, d):
    e = evaluate(scored(spark, d))
    paths = write_metric_tables(e.summary, e.points, run_folder(spark, "tables"), "r1")
    back = spark.read.option("header", True).csv(paths["point_metrics"])
    return back.select(
        "model", F.col("threshold").cast("double").alias("threshold"), F.col("tp").cast("bigint").alias("tp"),
        F.col("fp").cast("bigint").alias("fp"), "run_id",
    )


# ---- projections and filters ---------------------------------------------------


@query("P1_conform_columns", with_encounters(conformed_sql()))
def _(spark, d):
    return conform_columns(enc(spark, d), encounter_schema())


def names_sql(names: str) -> str:
    return f"SELECT n.n AS name, count(*) AS n_rows FROM encounters, (SELECT unnest({names}) AS n) n GROUP BY n.n"


def names_of_frame(df):
    every = F.array(*[F.lit(c) for c in df.columns])
    return df.select(F.explode(every).alias("name")).groupBy("name").agg(F.count("*").alias("n_rows"))


def without_sql(dropped):
    return f"SELECT {', '.join(f'{chr(34)}{f.name}{chr(34)}' for f in encounter_schema().fields if f.name not in dropped)} FROM ({conformed_sql()})"


@query("P2_drop_rare_medications", with_encounters(without_sql(RARE_MEDICATIONS)))
def _(spark, d):
    return drop_columns(conform_columns(enc(spark, d), encounter_schema()), RARE_MEDICATIONS)


@query("P3_drop_unused", with_encounters(without_sql(UNUSED_COLUMNS)))
def _(spark, d):
    return drop_columns(conform_columns(enc(spark, d), encounter_schema()), UNUSED_COLUMNS)


@query("P4_rename_medications", with_encounters("""
SELECT encounter_id, metformin AS medication_metformin, insulin AS medication_insulin, diabetesMed AS any_medication FROM encounters"""))
def _(spark, d):
    names = {c: f"medication_{c}" for c in ("metformin", "glipizide", "glyburide", "insulin")}
    renamed = rename_columns(enc(spark, d), {**names, "diabetesMed": "any_medication"})
    return renamed.select("encounter_id", "medication_metformin", "medication_insulin", "any_medication")


@query("P5_rename_discharge", with_encounters("SELECT encounter_id, discharge_disposition_id AS discharge_disposition FROM encounters"))
def _(spark, d):
    renamed = rename_columns(enc(spark, d), {"discharge_disposition_id": "discharge_disposition"})
    return renamed.select("encounter_id", "discharge_disposition")


@query("P6_move_to_front", with_encounters("SELECT readmitted, encounter_id, 'readmitted' AS first_column FROM encounters"))
def _(spark, d):
    moved = move_to_front(enc(spark, d), "readmitted")
    return moved.select("readmitted", "encounter_id", F.lit(moved.columns[0]).alias("first_column"))


@query("P7_not_died", """
SELECT o_orderkey AS id, CASE WHEN o_custkey % 7 = 0 THEN NULL WHEN o_custkey % 7 = 1 THEN 'died' ELSE 'home' END AS outcome FROM orders
WHERE CASE WHEN o_custkey % 7 = 0 THEN NULL WHEN o_custkey % 7 = 1 THEN 'died' ELSE 'home' END IS DISTINCT FROM 'died'""")
def _(spark, d):
    k = F.col("o_custkey") % 7
    outcome = F.when(k == 0, None).when(k == 1, "died").otherwise("home")
    rows = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), outcome.alias("outcome"))
    return keep_unless(rows, "outcome", "died")


@query("P8_label_present", with_encounters("SELECT encounter_id, diag_1 FROM encounters WHERE diag_1 IS NOT NULL"))
def _(spark, d):
    return complete_rows(enc(spark, d), ["diag_1"]).select("encounter_id", "diag_1")


@query("P9_complete_rows", with_encounters("""
SELECT encounter_id FROM encounters WHERE diag_1 IS NOT NULL AND diag_2 IS NOT NULL AND race IS NOT NULL AND "glyburide.metformin" IS NOT NULL"""))
def _(spark, d):
    return complete_rows(enc(spark, d), ["diag_1", "diag_2", "race", "glyburide.metformin"]).select("encounter_id")


@query("P10_known_label", """
SELECT o_orderkey AS id, CASE o_orderstatus WHEN 'F' THEN 1 ELSE 0 END AS label FROM orders WHERE o_orderstatus <> 'P'""")
def _(spark, d):
    words = {"F": "YES", "O": "no", "P": "maybe"}
    rows = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), recode(F.col("o_orderstatus"), words).alias("word"))
    return strict_label(rows, "word").select("id", "label")


@query("P11_select_numeric", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem""")
def _(spark, d):
    return select_numeric(table(spark, d, "lineitem"))


@query("P12_apply_selected", with_encounters("""
SELECT num_procedures, 0.0::DOUBLE AS unseen, time_in_hospital, readmitted FROM encounters"""))
def _(spark, d):
    return apply_selected_features(enc(spark, d), ["num_procedures", "unseen", "time_in_hospital"], "readmitted")


@query("P13_align_to_schema", with_encounters("""
SELECT encounter_id, num_procedures::DOUBLE AS num_procedures, 0.0::DOUBLE AS unseen, time_in_hospital::DOUBLE AS time_in_hospital FROM encounters"""))
def _(spark, d):
    return align_to_schema(enc(spark, d), ["num_procedures", "unseen", "time_in_hospital"], ["encounter_id"])


MESSY = """SELECT o_orderkey AS k, o_custkey AS id, CASE o_orderkey % 6 WHEN 0 THEN '1e999' WHEN 1 THEN NULL WHEN 2 THEN 'n/a' WHEN 3 THEN '1d'
  ELSE CAST(o_custkey AS {s}) || '.5' END AS a, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_totalprice END AS b FROM {orders}"""
MESSY_DUCK = MESSY.replace("{s}", "VARCHAR").replace("{orders}", "orders")


def messy(spark, d):
    return spark.sql(MESSY.replace("{s}", "STRING"), orders=table(spark, d, "orders"))


@query("P14_prepare_frame", f"""
SELECT k, CASE WHEN k % 6 >= 4 THEN round(CAST(a AS FLOAT)::DOUBLE, 3) ELSE 0.0 END AS a, round(coalesce(b, 0.0)::FLOAT::DOUBLE, 1) AS b, 0.0::DOUBLE AS id, 0.0::DOUBLE AS unseen
FROM ({MESSY_DUCK})""")
def _(spark, d):
    ready = prepare_frame(messy(spark, d), ["a", "b", "id", "unseen"], keep=["k"])
    return ready.select(
        "k", F.round(F.col("a").cast("double"), 3).alias("a"), F.round(F.col("b").cast("double"), 1).alias("b"),
        F.col("id").cast("double").alias("id"), F.col("unseen").cast("double").alias("unseen"),
    )


@query("A34_non_finite", f"""
SELECT (count(*) FILTER (WHERE k % 6 < 4) + count(*) FILTER (WHERE b IS NULL))::BIGINT AS non_finite FROM ({MESSY_DUCK})""")
def _(spark, d):
    return non_finite_count(messy(spark, d), ["a", "b", "unseen"])


@query("P15_schema_diff", with_encounters("""
SELECT 'unseen' AS missing, 34 AS extra, 'age,unseen,race,gender,change' AS head, 'unseen,race,gender,change,insulin' AS tail, count(*) AS n FROM encounters""".replace(
    "34 AS extra", f"{len(ENC_COLUMNS) - 5} AS extra")))
def _(spark, d):
    e = enc(spark, d)
    diff = schema_diff(e, ["age", "unseen", "race", "gender", "change", "insulin"])
    return e.agg(
        F.lit(",".join(diff["missing"])).alias("missing"), F.lit(len(diff["extra"])).alias("extra"),
        F.lit(",".join(diff["head"])).alias("head"), F.lit(",".join(diff["tail"])).alias("tail"), F.count("*").alias("n"),
    )


@query("P17_ranked_subset", with_encounters("SELECT number_inpatient, race, encounter_id FROM encounters"))
def _(spark, d):
    return select_ranked(enc(spark, d), ["number_inpatient", "race", "encounter_id"])


# ---- scalar recodes ------------------------------------------------------------------


@query("F1_recode_readmitted", with_encounters("SELECT encounter_id, CASE readmitted WHEN '<30' THEN 1 ELSE 0 END AS readmitted FROM encounters"))
def _(spark, d):
    return enc(spark, d).select("encounter_id", recode_int(F.col("readmitted"), READMITTED_WITHIN_30).alias("readmitted"))


@query("F2_recode_medications", with_encounters("""
SELECT encounter_id, CASE metformin WHEN 'No' THEN 0 ELSE 1 END AS metformin, CASE glipizide WHEN 'No' THEN 0 ELSE 1 END AS glipizide,
  CASE glyburide WHEN 'No' THEN 0 ELSE 1 END AS glyburide, CASE insulin WHEN 'No' THEN 0 ELSE 1 END AS insulin FROM encounters"""))
def _(spark, d):
    used = [recode_int(F.col(c), MEDICATION_USED).alias(c) for c in ("metformin", "glipizide", "glyburide", "insulin")]
    return enc(spark, d).select("encounter_id", *used)


@query("F3_binary_recodes", with_encounters("""
SELECT encounter_id, CASE change WHEN 'Ch' THEN 1 ELSE 0 END AS change, CASE diabetesMed WHEN 'Yes' THEN 1 ELSE 0 END AS any_medication FROM encounters"""))
def _(spark, d):
    return enc(spark, d).select(
        "encounter_id", recode_int(F.col("change"), MEDICATION_CHANGED).alias("change"),
        recode_int(F.col("diabetesMed"), ANY_MEDICATION).alias("any_medication"),
    )


@query("F4_icd_group", with_encounters(f"SELECT encounter_id, {', '.join(f'{sql_chapter(c)} AS {c}' for c in DIAGNOSES)} FROM encounters"))
def _(spark, d):
    return enc(spark, d).select("encounter_id", *[chapter_of(F.col(c)).alias(c) for c in DIAGNOSES])


@query("F5_external_cause", with_encounters("""
SELECT encounter_id, regexp_replace(diag_1, '^[VE][0-9]+', 'injury') AS diag_1, regexp_replace(diag_2, '^[VE][0-9]+', 'injury') AS diag_2,
  regexp_replace('x' || diag_3, '[VE][0-9]+', 'injury', 'g') AS anywhere FROM encounters"""))
def _(spark, d):
    return enc(spark, d).select(
        "encounter_id", external_cause_to_injury(F.col("diag_1")).alias("diag_1"), external_cause_to_injury(F.col("diag_2")).alias("diag_2"),
        external_cause_to_injury(F.concat(F.lit("x"), "diag_3"), anywhere=True).alias("anywhere"),
    )


@query("F6_ungrouped", with_encounters(f"""
SELECT encounter_id, CASE WHEN {IS_NUM.format(c='diag_1')} THEN 'Nothing' ELSE diag_1 END AS diag_1,
  CASE WHEN diag_2 IS NULL OR {IS_NUM.format(c='diag_2')} THEN 'Nothing' ELSE diag_2 END AS diag_2 FROM encounters"""))
def _(spark, d):
    return enc(spark, d).select(
        "encounter_id", ungrouped_to_nothing(F.col("diag_1")).alias("diag_1"), ungrouped_to_nothing(F.col("diag_2"), True).alias("diag_2")
    )


@query("F4_F6_diagnosis_group", with_encounters(f"SELECT encounter_id, {', '.join(f'{sql_group(c)} AS {c}' for c in DIAGNOSES)} FROM encounters"))
def _(spark, d):
    return enc(spark, d).select("encounter_id", *[diagnosis_group(F.col(c)).alias(c) for c in DIAGNOSES])


@query("F7_age_ordinal", with_encounters(f"SELECT encounter_id, list_position({sql_list(AGE_BRACKETS)}, age)::INT AS age FROM encounters"))
def _(spark, d):
    return enc(spark, d).select("encounter_id", recode_ordinal(F.col("age"), AGE_BRACKETS).alias("age"))


@query("F8_admission_type", with_encounters("""
SELECT encounter_id, CASE WHEN admission_type_id IN (6, 8) THEN 5 ELSE admission_type_id END AS chained,
  CASE admission_type_id WHEN 8 THEN 6 WHEN 6 THEN 5 ELSE admission_type_id END AS at_once FROM encounters"""))
def _(spark, d):
    code = F.col("admission_type_id")
    return enc(spark, d).select(
        "encounter_id", merge_admission_types(code).alias("chained"), merge_admission_types(code, True).alias("at_once")
    )


@query("F9_discharge_label", with_encounters(f"""
SELECT encounter_id, {sql_list(DISCHARGE_LABELS)}[discharge_disposition_id] AS discharge_disposition FROM encounters"""))
def _(spark, d):
    return enc(spark, d).select("encounter_id", recode_position(F.col("discharge_disposition_id"), DISCHARGE_LABELS).alias("discharge_disposition"))


@query("F10_clip_source", with_encounters("""
SELECT encounter_id, CASE WHEN admission_source_id > 8 THEN 8 ELSE admission_source_id END AS admission_source_id FROM encounters"""))
def _(spark, d):
    return enc(spark, d).select("encounter_id", clip_upper(F.col("admission_source_id"), 8).alias("admission_source_id"))


@query("F11_fill_race", with_encounters("SELECT encounter_id, coalesce(race, 'Other') AS race FROM encounters"))
def _(spark, d):
    return enc(spark, d).select("encounter_id", fill_missing(F.col("race"), "Other").alias("race"))


@query("F12_gender_and_tests", with_encounters("""
SELECT encounter_id, CASE gender WHEN 'Unknown/Invalid' THEN 'Female' ELSE gender END AS gender,
  CASE WHEN A1Cresult IS NULL OR A1Cresult = 'None' THEN 'NotTaken' ELSE A1Cresult END AS A1Cresult FROM encounters"""))
def _(spark, d):
    return enc(spark, d).select(
        "encounter_id", recode(F.col("gender"), {"Unknown/Invalid": "Female"}).alias("gender"),
        fill_missing(F.col("A1Cresult"), "NotTaken", ["None"]).alias("A1Cresult"),
    )


@query("F13_cast_all_int", f"""
SELECT k, TRY_CAST(CASE WHEN a SIMILAR TO '[0-9]+' THEN a END AS INT) AS a FROM (SELECT k, CASE WHEN k % 4 = 0 THEN 'x' ELSE CAST(id AS VARCHAR) END AS a FROM ({MESSY_DUCK}))""")
def _(spark, d):
    rows = messy(spark, d).select("k", F.when(F.col("k") % 4 == 0, "x").otherwise(F.col("id").cast("string")).alias("a"))
    return cast_all_int(rows, ["k"])


@query("F13_int_residue", f"""
SELECT 'a' AS "column", count(*) FILTER (WHERE k % 4 = 0) AS residue FROM ({MESSY_DUCK}) UNION ALL SELECT 'id', 0 FROM orders WHERE o_orderkey = (SELECT min(o_orderkey) FROM orders)""")
def _(spark, d):
    rows = messy(spark, d).select("k", "id", F.when(F.col("k") % 4 == 0, "x").otherwise(F.col("id").cast("string")).alias("a"))
    return int_residue(rows, ["k"])


WORDS = """SELECT o_orderkey AS k, CASE o_orderkey % 9 WHEN 0 THEN 'NO' WHEN 1 THEN 'yes' WHEN 2 THEN 'TRUE' WHEN 3 THEN '<30' WHEN 4 THEN '>30'
  WHEN 5 THEN '0.0' WHEN 6 THEN 'maybe' WHEN 7 THEN NULL ELSE '1' END AS w, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE (o_custkey % 11) / 10.0{cast} END AS x FROM {orders}"""
WORDS_DUCK = WORDS.replace("{cast}", "::DOUBLE").replace("{orders}", "orders")
WORD_CASE = "CASE WHEN w IN ('NO', '0') THEN 0.0 WHEN w IN ('yes', 'TRUE', '<30', '>30', '1') THEN 1.0 END::DOUBLE"


def words(spark, d):
    return spark.sql(WORDS.replace("{cast}", "D"), orders=table(spark, d, "orders"))


@query("F14_normalize_label", f"SELECT k, {WORD_CASE} AS label, x AS numeric_label FROM ({WORDS_DUCK})")
def _(spark, d):
    w = words(spark, d)
    return w.select("k", normalize_label(w, "w").alias("label"), normalize_label(w, "x").alias("numeric_label"))


@query("F15_strict_label", f"SELECT k, ({WORD_CASE})::INT AS label FROM ({WORDS_DUCK}) WHERE ({WORD_CASE}) IS NOT NULL")
def _(spark, d):
    return strict_label(words(spark, d), "w").select("k", "label")


@query("F16_coerce_label", f"SELECT k, CASE WHEN w = '0.0' THEN 0.0 ELSE {WORD_CASE} END AS label FROM ({WORDS_DUCK})")
def _(spark, d):
    w = words(spark, d)
    return w.select("k", coerce_label(w, "w").alias("label"))


@query("F16_complete_label", f"""
SELECT k, CASE WHEN w = '0.0' THEN 0 ELSE ({WORD_CASE})::INT END AS label FROM ({WORDS_DUCK}) WHERE w IS NOT NULL AND w <> 'maybe'""")
def _(spark, d):
    known = words(spark, d).where("w IS NOT NULL AND w <> 'maybe'")
    return complete_label(known, "w").select("k", "label")


@query("F17_coerce_binary", f"SELECT k, ({WORD_CASE})::INT AS w, CASE WHEN x IS NULL THEN NULL WHEN x >= 0.5 THEN 1 ELSE 0 END AS x FROM ({WORDS_DUCK})")
def _(spark, d):
    w = words(spark, d)
    return w.select("k", binary_label(w, "w").alias("w"), binary_label(w, "x").alias("x"))


@query("F18_to_numeric", f"""
SELECT k, CASE k % 6 WHEN 0 THEN 1.0 WHEN 4 THEN CAST(a AS DOUBLE) WHEN 5 THEN CAST(a AS DOUBLE) END AS a
FROM (SELECT k, CASE WHEN k % 6 = 0 THEN '1' ELSE a END AS a FROM ({MESSY_DUCK}))""")
def _(spark, d):
    text = F.when(F.col("k") % 6 == 0, F.lit(" 1.0 ")).otherwise(F.col("a"))
    return messy(spark, d).select("k", text_to_double(text).alias("a"))


@query("U6_label_violations", f"""
SELECT count(*) FILTER (WHERE x IS NULL) AS missing, count(*) FILTER (WHERE x IS NOT NULL AND x NOT IN (0.0, 1.0)) AS not_binary FROM ({WORDS_DUCK})""")
def _(spark, d):
    w = words(spark, d)
    return label_violations(w, F.col("x"))


RESPONSES = """SELECT event_id AS batch_id, 2 AS n_rows, CASE event_id % 5
  WHEN 0 THEN '{{"predictions": [[' || CAST(user_id AS {s}) || '.25], [' || CAST(event_id AS {s}) || ']]}}'
  WHEN 1 THEN '{{"predictions": [' || CAST(user_id AS {s}) || '.25, ' || CAST(event_id AS {s}) || ']}}'
  WHEN 2 THEN CAST(user_id AS {s}) || '.25, ' || CAST(event_id AS {s})
  WHEN 3 THEN CAST(user_id AS {s}) || '.25' || {nl} || CAST(event_id AS {s}) || {nl}
  ELSE CAST(user_id AS {s}) || '.25' END AS raw FROM {events}"""


@query("F27_parse_predictions", """
SELECT event_id AS batch_id, 0 AS pos, user_id + 0.25::DOUBLE AS score, event_id % 5 <> 4 AS complete FROM events
UNION ALL SELECT event_id, 1, event_id::DOUBLE, true FROM events WHERE event_id % 5 <> 4""")
def _(spark, d):
    text = RESPONSES.replace("{nl}", "chr(10)").replace("{s}", "STRING").replace("{{", "\x01").replace("}}", "\x02")
    table(spark, d, "events").createOrReplaceTempView("cohort_events")
    text = text.replace("{events}", "cohort_events").replace("\x01", "{").replace("\x02", "}")
    return parse_responses(spark.sql(text))


@query("F27_missing_predictions", """
SELECT event_id AS batch_id, NULL::INTEGER AS pos, NULL::DOUBLE AS score, event_id % 2 = 0 AS complete FROM events WHERE event_id % 4 <> 3
UNION ALL SELECT event_id, 0, user_id + 0.25::DOUBLE, event_id % 2 = 1 FROM events WHERE event_id % 4 = 3""")
def _(spark, d):
    kind, text = F.col("event_id") % 4, F.col("user_id").cast("string")
    raw = F.when(kind == 0, '{"predictions": []}').when(kind == 1, "").when(kind == 3, F.concat(text, F.lit(".25")))
    rows = F.when(F.col("event_id") % 2 == 0, 0).otherwise(1)
    return parse_responses(table(spark, d, "events").select(F.col("event_id").alias("batch_id"), rows.alias("n_rows"), raw.alias("raw")))


@query("F28_scores_from_json", """
SELECT event_id, 0 AS pos, value AS score FROM events UNION ALL SELECT event_id, 1, CAST(json_extract_string(props, '$.k') AS DOUBLE) FROM events""")
def _(spark, d):
    e = table(spark, d, "events")
    scores = F.array(
        F.struct(F.col("value").alias("score")),
        F.struct(F.get_json_object("props", "$.k").cast("double").alias("score")),
    )
    rows = e.select("event_id", F.to_json(F.struct(scores.alias("predictions"))).alias("body"))
    return scores_from_json(rows, "body", ["event_id"])


@query("F29_log_metrics", """
SELECT event_id, 'auc' AS metric, (user_id % 1000) / 1000.0::DOUBLE AS value FROM events WHERE event_id % 2 = 0
UNION ALL SELECT event_id, 'aucpr', (event_id % 1000) / 1000.0::DOUBLE FROM events""")
def _(spark, d):
    e = table(spark, d, "events")
    auc = F.when(
        F.col("event_id") % 2 == 0, F.concat(F.lit("[9] validation-auc:"), (F.col("user_id") % 1000 / 1000.0).cast("string"))
    ).otherwise("epoch done")
    aucpr = F.concat(F.lit(" validation:aucpr="), (F.col("event_id") % 1000 / 1000.0).cast("string"), F.lit(" loss=0.5"))
    return log_metrics(e.select("event_id", F.concat(auc, aucpr).alias("line")))


# ---- joins ----------------------------------------------------------------------------


@query("J1_column_concat", with_scored("SELECT readmitted, id, xgb_prob, nn_prob FROM scored"))
def _(spark, d):
    return move_to_front(scored(spark, d).select("id", "xgb_prob", "nn_prob", "readmitted"), "readmitted")


@query("J2_attach_scores", with_scored("""
SELECT o_orderkey AS id, o_totalprice, xgb_prob FROM orders LEFT JOIN (SELECT * FROM scored WHERE id % 3 <> 0) s ON s.id = o_orderkey"""))
def _(spark, d):
    rows = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), "o_totalprice")
    return attach_scores(rows, scored(spark, d).where("id % 3 <> 0").select("id", "xgb_prob"), "id")


@query("J3_range_lookup", with_encounters(f"SELECT encounter_id, {sql_chapter('diag_3')} AS chapter FROM encounters"))
def _(spark, d):
    rows = enc(spark, d).select("encounter_id", "diag_3")
    code = text_to_double(F.col("diag_3"))
    return range_lookup(rows, code, range_table(spark), "chapter").select("encounter_id", "chapter")


@query("J3_wide_ranges", """
WITH ranges AS (SELECT p_partkey * 20000 AS low, p_partkey * 20000 + p_size * 1000000 AS high, p_brand AS label, p_size AS priority FROM part)
SELECT o_orderkey, (SELECT label FROM ranges WHERE low <= code AND code < high ORDER BY priority, label LIMIT 1) AS brand
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 3 > 0 THEN CAST(round(o_totalprice * 100) AS BIGINT) END AS code FROM orders)""")
def _(spark, d):
    cents = F.when(F.col("o_orderkey") % 3 > 0, F.round(F.col("o_totalprice") * 100).cast("long"))
    low = F.col("p_partkey") * 20000
    ranges = table(spark, d, "part").select(
        low.alias("low"), (low + F.col("p_size").cast("long") * 1000000).alias("high"), F.col("p_brand").alias("label"), F.col("p_size").alias("priority")
    )
    return range_lookup(table(spark, d, "orders"), cents, ranges, "brand").select("o_orderkey", "brand")


@query("J4_code_lookup", "SELECT c_custkey, n_name, n_regionkey FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey")
def _(spark, d):
    codes = table(spark, d, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    return lookup(table(spark, d, "customer").select("c_custkey", "c_nationkey"), codes, "c_nationkey").select("c_custkey", "n_name", "n_regionkey")


@query("J5_scores_by_cutoffs", with_scored("""
SELECT 'xgb_prob' AS model, c AS threshold, count(*) FILTER (WHERE xgb_prob >= c AND readmitted = 1) AS tp, count(*) FILTER (WHERE xgb_prob >= c AND readmitted = 0) AS fp
FROM scored, (SELECT round((i + 1) * 0.05::DOUBLE, 2) AS c FROM range(19) r(i)) GROUP BY c"""))
def _(spark, d):
    grid = [round(0.05 * i, 2) for i in range(1, 20)]
    return threshold_sweep(scored(spark, d), "readmitted", ["xgb_prob"], grid).select("model", "threshold", "tp", "fp")


@query("J7_list_membership", """
SELECT p_type AS feature, count(*) AS n, 'in' AS side FROM part WHERE p_type IN (SELECT p_type FROM part WHERE p_size > 45) GROUP BY 1
UNION ALL SELECT p_type, count(*), 'out' FROM part WHERE p_type NOT IN (SELECT p_type FROM part WHERE p_size > 45) GROUP BY 1""")
def _(spark, d):
    p = table(spark, d, "part").select(F.col("p_type").alias("feature"), "p_size")
    schema = p.where("p_size > 45").select("feature")
    sides = [membership(p, schema, present).withColumn("side", F.lit(name)) for present, name in ((True, "in"), (False, "out"))]
    return sides[0].unionByName(sides[1]).groupBy("feature", "side").agg(F.count("*").alias("n"))


# ---- aggregates -------------------------------------------------------------------------


@query("A1_value_counts", with_encounters("SELECT race AS value, count(*) AS n FROM encounters WHERE race IS NOT NULL GROUP BY 1"))
def _(spark, d):
    return value_counts(enc(spark, d), "race")


@query("A2_top_categories", with_encounters("""
SELECT diag_1 AS value, count(*) AS n FROM encounters WHERE diag_1 IS NOT NULL GROUP BY 1 ORDER BY n DESC, value LIMIT 10"""))
def _(spark, d):
    return top_categories(enc(spark, d), "diag_1")


@query("A3_describe_numeric", """
SELECT 'l_extendedprice' AS "column", count(l_extendedprice) AS count, round(avg(l_extendedprice), 4) AS mean, round(stddev_samp(l_extendedprice), 4) AS std,
  min(l_extendedprice) AS min, round(quantile_cont(l_extendedprice, 0.25), 4) AS q25, round(quantile_cont(l_extendedprice, 0.5), 4) AS q50,
  round(quantile_cont(l_extendedprice, 0.75), 4) AS q75, max(l_extendedprice) AS max FROM lineitem
UNION ALL SELECT 'l_quantity', count(l_quantity), round(avg(l_quantity), 4), round(stddev_samp(l_quantity), 4), min(l_quantity),
  round(quantile_cont(l_quantity, 0.25), 4), round(quantile_cont(l_quantity, 0.5), 4), round(quantile_cont(l_quantity, 0.75), 4), max(l_quantity) FROM lineitem""")
def _(spark, d):
    return rounded(describe_numeric(table(spark, d, "lineitem"), ["l_extendedprice", "l_quantity"]), 4)


@query("A3_describe_text", with_encounters("""
, v AS (SELECT 'diag_1' AS c, diag_1 AS v FROM encounters UNION ALL SELECT 'race', race FROM encounters)
, g AS (SELECT c, v, count(*) AS n FROM v WHERE v IS NOT NULL GROUP BY c, v)
SELECT c AS "column", sum(n)::BIGINT AS count, count(*) AS unique, arg_min(v, {'n': -n, 'v': v}) AS top, max(n) AS freq FROM g GROUP BY c"""))
def _(spark, d):
    return describe_text(enc(spark, d), ["diag_1", "race"])


@query("A4_null_counts", with_encounters("SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE \"{c}\" IS NULL) AS n_null FROM encounters" for c in ENC_COLUMNS) + ")"))
def _(spark, d):
    return null_counts(enc(spark, d))


NUMERIC_ENC = [c for c in ENC_COLUMNS if c in (*COUNT_COLUMNS, "encounter_id", "patient_nbr", *ADMISSION_COLUMNS)]


@query("A5_profile", with_encounters("SELECT c AS \"column\", v AS value, count(*) AS n FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS c, CAST(\"{c}\" AS VARCHAR) AS v FROM encounters" for c in ENC_COLUMNS) + ") GROUP BY c, v"))
def _(spark, d):
    return profile_counts(enc(spark, d), ENC_COLUMNS)


def profile_sql(c):
    q, numeric = f'"{c}"', c in NUMERIC_ENC
    figures = [f"round(avg({q}), 6)", f"round(stddev_samp({q}), 6)", f"min({q})::DOUBLE"]
    figures += [f"round(quantile_cont({q}, {x}), 6)" for x in (0.25, 0.5, 0.75)] + [f"max({q})::DOUBLE"]
    names = ["mean", "std", "min", "q25", "q50", "q75", "max"]
    return f"""SELECT '{c}' AS "column", count(*) AS n, count(*) - count({q}) AS n_null, count(DISTINCT {q}) AS n_distinct,
  (SELECT CAST({q} AS VARCHAR) FROM encounters WHERE {q} IS NOT NULL GROUP BY {q} ORDER BY count(*) DESC, CAST({q} AS VARCHAR) LIMIT 1) AS mode,
  {', '.join(f"{x if numeric else 'NULL::DOUBLE'} AS {n}" for x, n in zip(figures, names))} FROM encounters"""


@query("A5_full_profile", with_encounters(" UNION ALL ".join(profile_sql(c) for c in ENC_COLUMNS)))
def _(spark, d):
    return rounded(full_profile(enc(spark, d)))


@query("A6_distinct_diagnoses", with_encounters(CLEAN + LONG3 + "SELECT DISTINCT v AS value FROM three WHERE v IS NOT NULL"))
def _(spark, d):
    return distinct_over(clean_encounters(enc(spark, d)), DIAGNOSES)


@query("U2_union_of_columns", with_encounters(CLEAN + LONG3 + "SELECT v AS value, count(*) AS n FROM three GROUP BY v"))
def _(spark, d):
    values = long_values(clean_encounters(enc(spark, d)), DIAGNOSES)
    return values.groupBy("value").agg(F.count(F.lit(1)).alias("n"))


@query("A7_modes", with_encounters(CLEAN + LONG8 + """
SELECT c AS "column", v AS mode, n FROM (SELECT c, v, count(*) AS n FROM eight WHERE v IS NOT NULL GROUP BY c, v)
QUALIFY row_number() OVER (PARTITION BY c ORDER BY n DESC, v) = 1"""))
def _(spark, d):
    return modes(clean_encounters(enc(spark, d)), DUMMY_COLUMNS)


@query("A8_class_balance", with_scored("""
SELECT sum(readmitted)::BIGINT AS pos, sum(1 - readmitted)::BIGINT AS neg, round(sum(1 - readmitted) / greatest(sum(readmitted), 1)::DOUBLE, 6) AS scale_pos_weight FROM scored"""))
def _(spark, d):
    return rounded(class_balance(scored(spark, d), F.col("readmitted")))


@query("A9_class_weights", with_scored("""
SELECT readmitted AS label, round((SELECT count(*) FROM scored) / (2.0::DOUBLE * count(*)), 6) AS weight FROM scored GROUP BY 1"""))
def _(spark, d):
    return rounded(class_weights(scored(spark, d), F.col("readmitted")))


@query("A10_weight_bounds", with_scored("""
, w AS (SELECT sum(1 - readmitted) / greatest(sum(readmitted), 1)::DOUBLE AS w FROM scored)
SELECT round(greatest(1.0, sqrt(w)), 6) AS low, round(greatest(1.5 * w, w + 0.1), 6) AS high FROM w"""))
def _(spark, d):
    return rounded(weight_bounds(class_balance(scored(spark, d), F.col("readmitted"))))


HOLES = """SELECT l_orderkey AS id, CASE WHEN l_orderkey % 9 = 0 THEN NULL ELSE l_quantity END AS q, l_tax + 0.0 AS t, {null} AS nothing FROM {lineitem}"""
HOLES_DUCK = HOLES.replace("{null}", "NULL::DOUBLE").replace("{lineitem}", "lineitem")


def holes(spark, d):
    return spark.sql(HOLES.replace("{null}", "CAST(NULL AS DOUBLE)"), lineitem=table(spark, d, "lineitem"))


@query("A11_column_means", f"""
SELECT 'q' AS "column", round(avg(q), 6) AS mean FROM ({HOLES_DUCK}) UNION ALL SELECT 't', round(avg(t), 6) FROM ({HOLES_DUCK})
UNION ALL SELECT 'nothing', coalesce(round(avg(nothing), 6), 0.0) FROM ({HOLES_DUCK})""")
def _(spark, d):
    return rounded(column_means(holes(spark, d), ["q", "t", "nothing"]))


@query("A11_mean_fill", f"""
WITH h AS ({HOLES_DUCK}), m AS (SELECT avg(q) AS mq FROM h WHERE id % 5 <> 0)
SELECT id, round(coalesce(q, mq), 6) AS q, 0.0::DOUBLE AS nothing FROM h, m""")
def _(spark, d):
    rows = holes(spark, d)
    filled = fit_mean_fill(rows.where("id % 5 <> 0"), ["q", "nothing"]).transform(rows)
    return rounded(filled.select("id", "q", "nothing"))


NUMERIC_CLEAN = [
    *COUNT_COLUMNS, *[f"medication_{c}" for c in MEDICATIONS], "change", "any_medication", "age", "admission_type_id", "admission_source_id",
]
CORRELATED = CLEAN + ", corrs AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, abs(corr({c}, readmitted)) AS correlation, count({c}) AS n FROM cleaned" for c in NUMERIC_CLEAN) + ")\n"


@query("A31_correlations", with_encounters(CORRELATED + "SELECT feature, round(correlation, 6) AS correlation FROM corrs UNION ALL SELECT 'flat', NULL"))
def _(spark, d):
    rows = clean_encounters(enc(spark, d)).withColumn("flat", F.lit(3))
    return rounded(correlations(rows, "readmitted", [*NUMERIC_CLEAN, "flat"]))


@query("A33_average_importances", """
SELECT p_brand AS feature, round(sum(g) / 5, 4) AS gain_cv FROM (
  SELECT p_brand, l_linenumber % 5 AS fold, sum(l_quantity) AS g FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2) GROUP BY 1""")
def _(spark, d):
    return rounded(average_importances(per_fold_gains(spark, d)), 4)


def per_fold_gains(spark, d):
    """Stand-in importances: one row per brand and fold."""
    li, p = table(spark, d, "lineitem"), table(spark, d, "part")
    joined = li.join(p, li.l_partkey == p.p_partkey)
    return joined.groupBy(F.col("p_brand").alias("feature"), (F.col("l_linenumber") % 5).alias("fold")).agg(
        F.sum("l_quantity").alias("gain")
    )


def gains(spark, d):
    return average_importances(per_fold_gains(spark, d))


@query("A37_best_jobs", """
SELECT o_orderkey AS job_name, o_custkey % 5 AS fold, o_totalprice AS objective FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey % 5 ORDER BY o_totalprice DESC, o_orderkey DESC) = 1""")
def _(spark, d):
    results = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("job_name"), (F.col("o_custkey") % 5).alias("fold"), F.col("o_totalprice").alias("objective")
    )
    return best_jobs(results, ["fold"])


# ---- ranking and selection -----------------------------------------------------------------

GAINS = """WITH g AS (SELECT p_brand AS feature, sum(l_quantity) / 5 AS gain_cv FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1)
, ranking AS (SELECT feature, gain_cv, sum(gain_cv) OVER (ORDER BY gain_cv DESC, feature) / sum(gain_cv) OVER () AS cum_importance,
  row_number() OVER (ORDER BY gain_cv DESC, feature)::INT AS position FROM g)
"""


@query("W1_cumulative_importance", GAINS + "SELECT feature, round(gain_cv, 4) AS gain_cv, round(cum_importance, 6) AS cum_importance, position FROM ranking")
def _(spark, d):
    r = rank_features(gains(spark, d))
    return r.select("feature", F.round("gain_cv", 4).alias("gain_cv"), F.round("cum_importance", 6).alias("cum_importance"), "position")


@query("W2_row_position", GAINS + "SELECT feature, position FROM ranking WHERE position <= 7")
def _(spark, d):
    return rank_features(gains(spark, d)).where("position <= 7").select("feature", "position")


@query("T1_sorted_gains", GAINS + "SELECT feature, round(gain_cv, 4) AS gain_cv FROM ranking ORDER BY gain_cv DESC, feature")
def _(spark, d):
    return rank_features(gains(spark, d)).orderBy("position").select("feature", F.round("gain_cv", 4).alias("gain_cv"))


@query("T2_top_k", GAINS + "SELECT feature AS selected_features, position FROM ranking WHERE position <= 10")
def _(spark, d):
    return select_top(rank_features(gains(spark, d)), 10)


@query("T3_cumulative_share", GAINS + "SELECT feature AS selected_features, position FROM ranking WHERE cum_importance <= 0.8")
def _(spark, d):
    return select_cumulative(rank_features(gains(spark, d)), 0.8)


KEPT_BY_CORRELATION = int(0.80 * (len(NUMERIC_CLEAN) + 1))


@query("T4_keep_by_correlation", with_encounters(CORRELATED + f"""SELECT feature, position FROM (
  SELECT feature, row_number() OVER (ORDER BY correlation DESC NULLS LAST, feature)::INT AS position FROM corrs) WHERE position <= {KEPT_BY_CORRELATION}"""))
def _(spark, d):
    found = correlations(clean_encounters(enc(spark, d)), "readmitted", NUMERIC_CLEAN)
    return keep_share(found, "correlation", KEPT_BY_CORRELATION).select("feature", "position")


@query("T9_seeded_sample", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY md5('42:' || o_orderkey), o_orderkey LIMIT 3")
def _(spark, d):
    return seeded_sample(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", 3)


@query("T10_largest_p_value", with_encounters(CLEAN + ", corrs AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, abs(corr({c}, readmitted)) AS r, count({c}) AS n FROM cleaned" for c in COUNT_COLUMNS) + """)
SELECT feature, round(r * sqrt((n - 2) / (1 - r * r)), 6) AS t_value FROM corrs ORDER BY t_value, feature LIMIT 1"""))
def _(spark, d):
    fits = single_fits(moments(clean_encounters(enc(spark, d)), COUNT_COLUMNS, "readmitted"))
    table = spark.createDataFrame(fits, "feature string, t_value double, p_value double")
    return rounded(largest_p_value(table).select("feature", "t_value"))


@query("M3_rank_and_select", GAINS + "SELECT feature AS selected_features, position, 'top' AS method FROM ranking WHERE position <= 5 UNION ALL SELECT feature, position, 'share' FROM ranking WHERE cum_importance <= 0.5")
def _(spark, d):
    r = rank_features(gains(spark, d))
    top = select_features(r, 5).withColumn("method", F.lit("top"))
    return top.unionByName(select_features(r, cumulative=0.5).withColumn("method", F.lit("share")))


@query("U5_list_difference", """
SELECT p_brand, array_to_string(list_sort(list_filter(list_distinct(a), lambda v: NOT list_contains(b, v))), ',') AS only_a,
  array_to_string(list_sort(list_filter(list_distinct(b), lambda v: NOT list_contains(a, v))), ',') AS only_b FROM (
  SELECT p_brand, [min(p_type), max(p_type), 'x'] AS a, [max(p_type), 'y'] AS b FROM part GROUP BY 1)""")
def _(spark, d):
    ends = table(spark, d, "part").groupBy("p_brand").agg(F.min("p_type").alias("lo"), F.max("p_type").alias("hi"))
    lists = ends.select(
        "p_brand", F.array("lo", "hi", F.lit("x")).alias("a"), F.array("hi", F.lit("y")).alias("b")
    )
    both = list_difference(lists, F.col("a"), F.col("b"), ["p_brand"])
    return both.select("p_brand", *[F.array_join(F.array_sort(c), ",").alias(c) for c in ("only_a", "only_b")])


# ---- encoding, splits and folds ----------------------------------------------------------------


@query("E1_combined_one_hot", with_encounters(CLEAN + LONG3 + """
, hot AS (SELECT encounter_id, string_agg(DISTINCT 'diagnosis_' || v, ',' ORDER BY 'diagnosis_' || v) AS active FROM three WHERE v IS NOT NULL GROUP BY 1)
SELECT cleaned.encounter_id, coalesce(active, '') AS active FROM cleaned LEFT JOIN hot USING (encounter_id)"""))
def _(spark, d):
    cleaned = clean_encounters(enc(spark, d), ["encounter_id"]).select("encounter_id", *DIAGNOSES)
    model = fit_one_hot(cleaned, combined={"diagnosis": DIAGNOSES})
    return model.transform(cleaned).select("encounter_id", active(model.columns()).alias("active"))


HOT8 = LONG8 + MODES8 + """, hot8 AS (SELECT encounter_id, string_agg(c || '_' || v, ',' ORDER BY c || '_' || v) AS active
  FROM eight WHERE v IS NOT NULL AND (c, v) NOT IN (SELECT (c, v) FROM mode8) GROUP BY 1)
"""


@query("E2_sparse_rows", with_encounters(CLEAN + LONG8 + LONG3 + MODES8 + f"""
, names AS (SELECT DISTINCT 0 AS place, 'diagnosis' AS c, v FROM three WHERE v IS NOT NULL
  UNION ALL SELECT DISTINCT list_position({sql_list(DUMMY_COLUMNS)}, c), c, v FROM eight WHERE v IS NOT NULL AND (c, v) NOT IN (SELECT (c, v) FROM mode8))
, dictionary AS (SELECT c, v, row_number() OVER (ORDER BY place, v) - 1 AS index FROM names)
SELECT DISTINCT encounter_id, index FROM (SELECT encounter_id, 'diagnosis' AS c, v FROM three UNION ALL SELECT * FROM eight) JOIN dictionary USING (c, v)"""))
def _(spark, d):
    cleaned = clean_encounters(enc(spark, d), ["encounter_id"])
    dictionary = fit_category_table(cleaned, DUMMY_COLUMNS, {"diagnosis": DIAGNOSES})
    return dictionary.encode(cleaned).select("encounter_id", F.explode("indices").alias("index"))


@query("E2_one_hot_drop_mode", with_encounters(CLEAN + HOT8 + """
SELECT cleaned.encounter_id, coalesce(active, '') AS active FROM cleaned LEFT JOIN hot8 USING (encounter_id)"""))
def _(spark, d):
    cleaned = clean_encounters(enc(spark, d), ["encounter_id"]).select("encounter_id", *DUMMY_COLUMNS)
    model = fit_one_hot(cleaned, DUMMY_COLUMNS)
    return model.transform(cleaned).select("encounter_id", active(model.columns()).alias("active"))


@query("E3_dummy_names", with_encounters(CLEAN + LONG8 + MODES8 + """
SELECT c || '_' || v AS name, count(*) AS n FROM eight WHERE v IS NOT NULL AND (c, v) NOT IN (SELECT (c, v) FROM mode8) GROUP BY 1"""))
def _(spark, d):
    cleaned = clean_encounters(enc(spark, d)).select(*DUMMY_COLUMNS)
    model = fit_one_hot(cleaned, DUMMY_COLUMNS)
    hot = model.transform(cleaned)
    totals = F.array(*[F.struct(F.lit(c).alias("name"), F.sum(quoted(c)).alias("n")) for c in model.columns()])
    return hot.agg(totals.alias("t")).select(F.inline("t"))


def share_sql(share: str) -> str:
    return f"""SELECT o_orderkey AS id, CASE WHEN row_number() OVER (ORDER BY md5('42:' || o_orderkey), o_orderkey)
  <= floor({share}::DECIMAL(4, 2) * (SELECT count(*) FROM orders)) THEN 'train' ELSE 'test' END AS split FROM orders"""


def keys(spark, d):
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("id"))


@query("E4_split_80_20", share_sql("0.80"))
def _(spark, d):
    return split_by_share(keys(spark, d), "id", 0.8)


@query("E6_split_85_15", share_sql("0.85"))
def _(spark, d):
    return split_by_share(keys(spark, d), "id", 0.85)


@query("P19_split_tag", f"SELECT id FROM ({share_sql('0.85')}) WHERE split = 'test'")
def _(spark, d):
    return by_tag(split_by_share(keys(spark, d), "id", 0.85), "split", "test")


STRATIFIED = """, sizes AS (SELECT readmitted AS g, count(*) AS s FROM scored GROUP BY 1)
, quota AS (SELECT g, s, sum(s) OVER () AS n, ceil(0.2::DECIMAL(3, 1) * sum(s) OVER ())::BIGINT AS total FROM sizes)
, parts AS (SELECT g, (total * s // n)::BIGINT AS base, (total * s % n) AS rest, total FROM quota)
, full_quota AS (SELECT g, base + CASE WHEN row_number() OVER (ORDER BY rest DESC, g) <= total - sum(base) OVER () THEN 1 ELSE 0 END AS q FROM parts)
, ranked AS (SELECT *, row_number() OVER (PARTITION BY readmitted ORDER BY md5('42:' || id), id) AS r FROM scored)
"""


@query("E5_stratified_split", with_scored(STRATIFIED + """
SELECT id, readmitted, CASE WHEN r <= q THEN 'test' ELSE 'train' END AS split FROM ranked JOIN full_quota ON g = readmitted"""))
def _(spark, d):
    return stratified_split(scored(spark, d).select("id", "readmitted"), "id", "readmitted")


@query("E7_stratified_folds", with_scored(FOLD_SQL + "SELECT id, readmitted, fold FROM folded"))
def _(spark, d):
    return stratified_folds(scored(spark, d).select("id", "readmitted"), "id", "readmitted")


@query("E8_k_folds", """
WITH n AS (SELECT count(*) AS n FROM orders), r AS (SELECT o_orderkey AS id, row_number() OVER (ORDER BY md5('7:' || o_orderkey), o_orderkey) - 1 AS r FROM orders)
, e AS (SELECT i, sum(n // 4 + CASE WHEN i < n % 4 THEN 1 ELSE 0 END) OVER (ORDER BY i) AS hi FROM n, range(4) t(i))
SELECT id, (SELECT count(*) FROM e WHERE hi <= r)::INT AS fold FROM r""")
def _(spark, d):
    return k_folds(keys(spark, d), "id", 4, seed=7)


@query("W10_seeded_positions", with_scored("""
SELECT id, readmitted, row_number() OVER (PARTITION BY readmitted ORDER BY md5('42:' || id), id) AS pos FROM scored"""))
def _(spark, d):
    return seeded_positions(scored(spark, d).select("id", "readmitted"), "id", "readmitted")


@query("E9_standard_scaler", """
WITH s AS (SELECT avg(l_quantity) AS mq, stddev_pop(l_quantity) AS sq FROM lineitem WHERE l_orderkey % 5 <> 0)
SELECT l_orderkey, l_linenumber, l_partkey, round((l_quantity - mq) / sq, 6) AS l_quantity, 0.0::DOUBLE AS flat FROM lineitem, s""")
def _(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", F.lit(4.0).alias("flat"))
    model = fit_scaler(rows.where("l_orderkey % 5 <> 0"), ["l_quantity", "flat"], "standard")
    return rounded(model.transform(rows))


@query("E9_minmax_scaler", """
WITH s AS (SELECT min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, round((l_quantity - lo) / (hi - lo), 6) AS l_quantity, 0.0::DOUBLE AS flat FROM lineitem, s""")
def _(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", F.lit(4.0).alias("flat"))
    return rounded(fit_scaler(rows, ["l_quantity", "flat"], "minmax").transform(rows))


# ---- the whole engineering step ------------------------------------------------------------------

BASE_COLUMNS = [
    "readmitted", *COUNT_COLUMNS, "medication_metformin", "medication_glipizide", "medication_glyburide",
    "medication_insulin", "change", "any_medication",
]


@query("L1_clean_encounters", with_encounters(CLEAN + "SELECT * FROM cleaned"))
def _(spark, d):
    return clean_encounters(enc(spark, d), ["encounter_id"])


@query("L1_clean_encounters_by_script", with_encounters(CLEAN + """
SELECT c.* REPLACE (CASE e.admission_type_id WHEN 6 THEN 5 WHEN 8 THEN 6 ELSE e.admission_type_id END AS admission_type_id)
FROM cleaned c JOIN encounters e USING (encounter_id)"""))
def _(spark, d):
    return clean_encounters(enc(spark, d), ["encounter_id"], simultaneous=True)


@query("P16_missing_columns", "SELECT unnest(['o_total', 'weight']) AS missing, count(*) AS n FROM orders GROUP BY 1")
def _(spark, d):
    orders = table(spark, d, "orders")
    names = missing_columns(orders, ["o_orderkey", "o_total", "o_totalprice", "weight"])
    return orders.groupBy().count().select(F.explode(F.array(*[F.lit(c) for c in names])).alias("missing"), F.col("count").alias("n"))


@query("L1_data_engineering", with_encounters(CLEAN + LONG3 + HOT8 + f"""
, every AS (SELECT encounter_id, 'diagnosis_' || v AS a FROM three WHERE v IS NOT NULL
  UNION SELECT encounter_id, c || '_' || v FROM eight WHERE v IS NOT NULL AND (c, v) NOT IN (SELECT (c, v) FROM mode8))
, hot AS (SELECT encounter_id, string_agg(a, ',' ORDER BY a) AS active FROM every GROUP BY 1)
, pos AS (SELECT encounter_id, row_number() OVER (ORDER BY md5('42:' || encounter_id), encounter_id) AS r, count(*) OVER () AS n FROM cleaned)
SELECT encounter_id, {", ".join(BASE_COLUMNS)}, coalesce(active, '') AS active, CASE WHEN r <= floor(0.8::DECIMAL(3, 1) * n) THEN 'train' ELSE 'test' END AS split
FROM cleaned JOIN pos USING (encounter_id) LEFT JOIN hot USING (encounter_id)"""))
def _(spark, d):
    cleaned = settle(clean_encounters(enc(spark, d), ["encounter_id"]))
    encoder = fit_encoder(cleaned)
    split = split_by_share(cleaned, "encounter_id", 0.8)  # before the columns become many
    tagged = cast_all_int(encoder.transform(split), ["encounter_id", "split"])
    return tagged.select("encounter_id", *BASE_COLUMNS, active(encoder.columns()).alias("active"), "split")


@query("L1_separate_diagnoses", with_encounters(CLEAN + """
, d AS (SELECT encounter_id, 'diag_1' AS c, diag_1 AS v FROM cleaned UNION ALL SELECT encounter_id, 'diag_2', diag_2 FROM cleaned UNION ALL SELECT encounter_id, 'diag_3', diag_3 FROM cleaned)
, m AS (SELECT c, v FROM (SELECT c, v, count(*) AS n FROM d WHERE v IS NOT NULL GROUP BY c, v) QUALIFY row_number() OVER (PARTITION BY c ORDER BY n DESC, v) = 1)
SELECT c || '_' || v AS name, count(*) AS n FROM d WHERE v IS NOT NULL AND (c, v) NOT IN (SELECT (c, v) FROM m) GROUP BY 1"""))
def _(spark, d):
    cleaned = clean_encounters(enc(spark, d))
    encoder = fit_encoder(cleaned, separate_diagnoses=True)
    hot = encoder.transform(cleaned)
    names = [c for c in encoder.columns() if c.startswith("diag_")]
    totals = F.array(*[F.struct(F.lit(c).alias("name"), F.sum(quoted(c)).alias("n")) for c in names])
    return hot.agg(totals.alias("t")).select(F.inline("t"))
