"""Queries on scored rows: metrics, curves, cutoffs, costs."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortscore.catalog.inputs import scored, scored_lines, table, with_lines, with_scored
from cohortscore.catalog.registry import query, rounded
from cohortscore.functions.numeric import quoted
from cohortscore.functions.scores import (
    cutoff_label, ensemble_mean, flag_thresholds, hard_prediction, looks_like_probability,
    min_max_scale, symmetric_thresholds, threshold_flags, to_probability,
)
from cohortscore.operators.cost import baselines, cost_columns, top_tables
from cohortscore.operators.metrics import (
    balanced_cutoffs, hard_auc, mean_losses, metrics_vs_all, normalized_confusion, optimal_cutoffs,
    pick_cutoffs, point_metrics, pr_curve, ranking_metrics, rate_metrics, roc_curve, sort_metrics,
    summary_metrics, validation_metrics,
)
from cohortscore.operators.profile import (
    binary_columns, detect_label, detect_score, histogram, quantiles,
)
from cohortscore.operators.sweep import threshold_sweep
from cohortscore.operators.tally import ordered_points, tally
from cohortscore.plans.evaluation import (
    export_metrics,
    assess_cutoffs, best_cases, best_rows, best_saving, cutoff_table, evaluate, export, first_best,
)

Y = "readmitted"
REPORT = [0.2, 0.3, 0.5]


def with_mean(df):
    return df.withColumn("ensemble_prob", ensemble_mean(F.col("xgb_prob"), F.col("nn_prob")))


THREE = ["xgb_prob", "nn_prob", "ensemble_prob"]

# ---- SQL building blocks ----------------------------------------------------

LONG = """, long AS (
  SELECT 'xgb_prob' AS m, xgb_prob AS x, readmitted AS y FROM scored
  UNION ALL SELECT 'nn_prob', nn_prob, readmitted FROM scored
  UNION ALL SELECT 'ensemble_prob', (xgb_prob + nn_prob) / 2.0::DOUBLE, readmitted FROM scored)
"""
POINTS = """, t AS (SELECT m, x, sum(y)::BIGINT AS pos, sum(1 - y)::BIGINT AS neg FROM long
  WHERE x IS NOT NULL AND y IS NOT NULL GROUP BY m, x)
, pts AS (SELECT m, x, pos, neg,
    (sum(pos) OVER (PARTITION BY m ORDER BY x DESC))::DOUBLE AS tp,
    (sum(neg) OVER (PARTITION BY m ORDER BY x DESC))::DOUBLE AS fp,
    (sum(pos) OVER (PARTITION BY m))::DOUBLE AS p,
    (sum(neg) OVER (PARTITION BY m))::DOUBLE AS q,
    min(x) OVER (PARTITION BY m) AS lo, max(x) OVER (PARTITION BY m) AS hi,
    count(*) OVER (PARTITION BY m) AS nd FROM t)
"""
GRID3 = ", grid AS (SELECT unnest([0.2, 0.3, 0.5])::DOUBLE AS threshold)\n"
CONF = """, conf AS (SELECT m AS model, threshold,
    count(*) FILTER (WHERE y = 0 AND x < threshold) AS tn,
    count(*) FILTER (WHERE y = 0 AND x >= threshold) AS fp,
    count(*) FILTER (WHERE y = 1 AND x < threshold) AS fn,
    count(*) FILTER (WHERE y = 1 AND x >= threshold) AS tp
  FROM long, grid GROUP BY m, threshold)
"""
POINT_COLUMNS = """
  round((tp + tn)::DOUBLE / (tp + tn + fp + fn), 6) AS accuracy,
  round(CASE WHEN tp + fp = 0 THEN 0 ELSE tp::DOUBLE / (tp + fp) END, 6) AS precision,
  round(CASE WHEN tp + fn = 0 THEN 0 ELSE tp::DOUBLE / (tp + fn) END, 6) AS recall,
  round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp::DOUBLE / (2 * tp + fp + fn) END, 6) AS f1
"""


def cost_sql(n: str = "(tp + tn + fp + fn)", other: str | None = None) -> str:
    other = other or n
    return f"""
  (tp + fp)::DOUBLE * 500 AS total_cost_of_implimenting_program,
  round_even((tp + fp)::DOUBLE * 500 / {n} * 100, 0) / 100 AS per_patient_outlay,
  round_even(0.5::DOUBLE * tp, 0) AS readmissions_prevented,
  round_even(0.5::DOUBLE * tp, 0) * 15000 AS savings_from_readmissions_prevention,
  round_even(round_even(0.5::DOUBLE * tp, 0) * 15000 / {other} * 100, 0) / 100
    AS per_patient_savings_from_readmissions_prevention,
  round_even(0.5::DOUBLE * tp, 0) * 15000 - (tp + fp)::DOUBLE * 500 AS net_savings_to_hosptial_system,
  round_even((round_even(0.5::DOUBLE * tp, 0) * 15000 - (tp + fp)::DOUBLE * 500) / {n} * 100, 0) / 100
    AS net_per_patient_savings
"""


# ---- scalar functions on scores ---------------------------------------------


@query("F19_ensemble_avg", with_scored(
    "SELECT id, round((xgb_prob + CASE WHEN id % 9 = 0 THEN NULL ELSE nn_prob END) / 2.0::DOUBLE, 9) AS ensemble FROM scored"))
def _(spark, d):
    some = F.when(F.col("id") % 9 != 0, F.col("nn_prob"))
    return scored(spark, d).select("id", F.round(ensemble_mean(F.col("xgb_prob"), some), 9).alias("ensemble"))


_FLAGS = ", ".join(
    f"CASE WHEN s IS NULL THEN NULL WHEN s >= {t} THEN 1 ELSE 0 END AS s_ge_{round(t * 100):03d}pct" for t in [i * 5 / 100 for i in range(1, 20)]
)


@query("F20_threshold_flags", with_scored(
    f"SELECT id, {_FLAGS} FROM (SELECT id, CASE WHEN id % 11 = 0 THEN NULL ELSE xgb_prob END AS s FROM scored)"))
def _(spark, d):
    rows = scored(spark, d).select("id", F.when(F.col("id") % 11 != 0, F.col("xgb_prob")).alias("s"))
    return threshold_flags(rows, ["s"], 0.05, 0.95, 0.05).drop("s")


@query("F20_threshold_flags_listed", with_scored("""
SELECT id, CASE WHEN s >= 0.15 THEN 1 ELSE 0 END AS s_ge_015pct, CASE WHEN s >= 0.35 THEN 1 ELSE 0 END AS s_ge_035pct
FROM (SELECT id, CASE WHEN id % 11 = 0 THEN NULL ELSE nn_prob END AS s FROM scored)"""))
def _(spark, d):
    rows = scored(spark, d).select("id", F.when(F.col("id") % 11 != 0, F.col("nn_prob")).alias("s"))
    return threshold_flags(rows, ["s"], listed=[0.35, 0.15, 0.349], preserve_na=False).drop("s")


@query("F21_generate_thresholds", with_scored("""
, grid AS (SELECT round(0.11::DOUBLE + (i - 500) * 0.0001::DOUBLE, 5) AS threshold FROM range(1001) r(i))
SELECT threshold, count(s.id) AS at_or_above
FROM grid LEFT JOIN scored s ON s.nn_prob >= threshold GROUP BY threshold"""))
def _(spark, d):
    grid = symmetric_thresholds(0.11, 0.05, 0.0001, 5)
    return threshold_sweep(scored(spark, d), Y, ["nn_prob"], grid).select(
        "threshold", (F.col("tp") + F.col("fp")).alias("at_or_above")
    )


@query("F22_cutoff_label", with_scored("""
SELECT id, printf('%.2f%%', xgb_prob * 100) AS label FROM scored"""))
def _(spark, d):
    return scored(spark, d).select("id", cutoff_label(F.col("xgb_prob")).alias("label"))


@query("F23_hard_prediction", with_scored("""
SELECT id, CASE WHEN xgb_prob >= 0.3 THEN 1 ELSE 0 END AS predicted FROM scored"""))
def _(spark, d):
    return scored(spark, d).select("id", hard_prediction(F.col("xgb_prob"), 0.3).alias("predicted"))


@query("F24_looks_like_prob", """
SELECT 'o_totalprice' AS "column", count(o_totalprice) AS n, min(o_totalprice) AS low, max(o_totalprice) AS high,
  count(o_totalprice) > 0 AND min(o_totalprice) >= 0 AND max(o_totalprice) <= 1 AS is_probability FROM orders
UNION ALL SELECT 'share', count(*), min(o_custkey % 100 / 100.0::DOUBLE), max(o_custkey % 100 / 100.0::DOUBLE), true FROM orders
UNION ALL SELECT 'nothing', 0, NULL, NULL, false FROM orders LIMIT 3""".replace(
    "UNION ALL SELECT 'nothing', 0, NULL, NULL, false FROM orders LIMIT 3",
    "UNION ALL SELECT 'nothing', count(CASE WHEN o_orderkey < 0 THEN 1 END), NULL, NULL, false FROM orders"))
def _(spark, d):
    o = table(spark, d, "orders")
    rows = o.select(
        "o_totalprice",
        (F.col("o_custkey") % 100 / 100.0).alias("share"),
        F.when(F.col("o_orderkey") < 0, F.lit(1.0)).alias("nothing"),
    )
    return looks_like_probability(rows, rows.columns)


@query("F25_to_proba", """
WITH s AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE (o_custkey % 200 - 100) / 25.0::DOUBLE END AS logit,
  CASE WHEN o_orderkey % 10 = 1 THEN NULL ELSE o_custkey % 100 / 100.0::DOUBLE END AS prob FROM orders)
SELECT id, round(1.0 / (1.0 + exp(-coalesce(logit, 0.0::DOUBLE))), 6) AS logit, round(coalesce(prob, 0.0::DOUBLE), 6) AS prob FROM s""")
def _(spark, d):
    o = table(spark, d, "orders")
    rows = o.select(
        F.col("o_orderkey").alias("id"),
        F.when(F.col("o_orderkey") % 10 != 0, (F.col("o_custkey") % 200 - 100) / 25.0).alias("logit"),
        F.when(F.col("o_orderkey") % 10 != 1, F.col("o_custkey") % 100 / 100.0).alias("prob"),
    )
    return rounded(to_probability(rows, ["logit", "prob"]))


@query("F26_min_max_scale", """
SELECT o_orderkey AS id, round((o_totalprice - lo) / (hi - lo), 9) AS price_scaled, NULL::DOUBLE AS flat_scaled
FROM orders, (SELECT min(o_totalprice) lo, max(o_totalprice) hi FROM orders)""")
def _(spark, d):
    o = table(spark, d, "orders")
    rows = o.select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("price"), F.lit(3.0).alias("flat"))
    return rounded(min_max_scale(rows, ["price", "flat"]).drop("price", "flat"), 9)


@query("F30_round_half_even", with_scored("""
SELECT id, round_even(id * 0.5::DOUBLE, 0) AS halves, round_even(xgb_prob * 12.5::DOUBLE * 100, 0) / 100 AS cents FROM scored"""))
def _(spark, d):
    from cohortscore.functions.numeric import round_half_even

    return scored(spark, d).select(
        "id",
        round_half_even(F.col("id") * 0.5).alias("halves"),
        round_half_even(F.col("xgb_prob") * 12.5, 2).alias("cents"),
    )


# ---- confusion counts and what follows from them ------------------------------


@query("A12_confusion_counts", with_scored(LONG + ", grid AS (SELECT 0.5::DOUBLE AS threshold)" + CONF + "SELECT * FROM conf"))
def _(spark, d):
    return threshold_sweep(with_mean(scored(spark, d)), Y, THREE, [0.5])


@query("A13_threshold_sweep", with_lines(LONG + """
, grid AS (SELECT round(0.11::DOUBLE + (i - 500) * 0.0001::DOUBLE, 5) AS threshold FROM range(1001) r(i))
, g AS (SELECT m, x, sum(y) AS pos, sum(1 - y) AS neg FROM long GROUP BY m, x)
, tot AS (SELECT m, sum(pos) AS p, sum(neg) AS q FROM g GROUP BY m)
, c AS (SELECT g.m, threshold, sum(pos) AS tp, sum(neg) AS fp FROM g JOIN grid ON g.x >= threshold GROUP BY g.m, threshold)
SELECT m AS model, threshold, (q - fp)::BIGINT AS tn, fp::BIGINT AS fp, (p - tp)::BIGINT AS fn, tp::BIGINT AS tp
FROM c JOIN tot USING (m)"""))
def _(spark, d):
    grid = symmetric_thresholds(0.11, 0.05, 0.0001, 5)
    return threshold_sweep(with_mean(scored_lines(spark, d)), Y, THREE, grid)


@query("A14_point_metrics", with_scored(LONG + GRID3 + CONF + f"SELECT *, {POINT_COLUMNS} FROM conf"))
def _(spark, d):
    return rounded(point_metrics(threshold_sweep(with_mean(scored(spark, d)), Y, THREE, REPORT)))


@query("A14_point_metrics_null", with_scored(LONG + ", grid AS (SELECT unnest([0.5, 0.999, 2.0])::DOUBLE AS threshold)" + CONF + """
SELECT model, threshold, round(tp::DOUBLE / nullif(tp + fp, 0), 6) AS precision, round(tp::DOUBLE / nullif(tp + fn, 0), 6) AS recall FROM conf"""))
def _(spark, d):
    counts = threshold_sweep(with_mean(scored(spark, d)), Y, THREE, [0.5, 0.999, 2.0])
    return rounded(point_metrics(counts, None)).select("model", "threshold", "precision", "recall")


@query("A15_rate_metrics", with_scored(LONG + GRID3 + CONF + """
SELECT *, round(tn::DOUBLE / nullif(tn + fp, 0), 6) AS specificity,
  round(CASE WHEN (tp + fp) * (tp + fn) * (tn + fp) * (tn + fn) = 0 THEN 0 ELSE
    (tp::DOUBLE * tn - fp::DOUBLE * fn) / sqrt((tp + fp)::DOUBLE * (tp + fn) * (tn + fp) * (tn + fn)) END, 6) AS mcc,
  round((tp + fn)::DOUBLE / (tp + tn + fp + fn), 6) AS prevalence,
  round((tp + fp)::DOUBLE / (tp + tn + fp + fn), 6) AS pred_pos_rate, tp + tn + fp + fn AS n FROM conf"""))
def _(spark, d):
    return rounded(rate_metrics(threshold_sweep(with_mean(scored(spark, d)), Y, THREE, REPORT)))


AUC = "sum(pos * (q - fp + neg / 2.0::DOUBLE)) / max(p * q)"
AP = "sum(pos * tp / (tp + fp)) / max(p)"


@query("A16_roc_auc", with_lines(LONG + POINTS + f"SELECT m AS feature, round({AUC}, 6) AS roc_auc FROM pts GROUP BY m"))
def _(spark, d):
    points = ordered_points(tally(with_mean(scored_lines(spark, d)), Y, THREE))
    return rounded(ranking_metrics(points)).select("feature", "roc_auc")


@query("A17_hard_auc", with_scored(LONG + GRID3 + CONF + """
SELECT model, threshold, round((tp::DOUBLE / (tp + fn) + tn::DOUBLE / (tn + fp)) / 2, 6) AS roc_auc FROM conf"""))
def _(spark, d):
    counts = threshold_sweep(with_mean(scored(spark, d)), Y, THREE, REPORT)
    return rounded(hard_auc(counts)).select("model", "threshold", "roc_auc")


@query("A18_average_precision", with_lines(LONG + POINTS + f"SELECT m AS feature, round({AP}, 6) AS pr_auc FROM pts GROUP BY m"))
def _(spark, d):
    points = ordered_points(tally(with_mean(scored_lines(spark, d)), Y, THREE))
    return rounded(ranking_metrics(points)).select("feature", "pr_auc")


# The trapezoid over the curve of a 0/1 prediction: all flagged, the flagged, none.
PR_TRAPEZOID = """CASE WHEN tp + fp = 0 OR tn + fn = 0 THEN (1 + prev) / 2
  ELSE (1 - r) * (prev + pr) / 2 + r * (pr + 1) / 2 END"""


@query("A19_hard_pr_auc", with_scored(LONG + ", grid AS (SELECT unnest([0.2, 0.3, 0.5, -1.0, 2.0])::DOUBLE AS threshold)" + CONF + f"""
, d AS (SELECT *, (tp + fn)::DOUBLE / (tp + tn + fp + fn) AS prev, tp::DOUBLE / (tp + fn) AS r,
  tp::DOUBLE / nullif(tp + fp, 0) AS pr FROM conf)
SELECT model, threshold, round({PR_TRAPEZOID}, 6) AS pr_auc FROM d"""))
def _(spark, d):
    counts = threshold_sweep(with_mean(scored(spark, d)), Y, THREE, [*REPORT, -1.0, 2.0])
    return rounded(hard_auc(counts)).select("model", "threshold", "pr_auc")


@query("A20_brier", with_scored(LONG + """
SELECT m AS feature, round(avg((x - y) * (x - y)), 6) AS brier FROM long GROUP BY m"""))
def _(spark, d):
    return rounded(mean_losses(with_mean(scored(spark, d)), Y, THREE).select("feature", "brier"))


@query("A21_log_loss", with_scored(LONG + """
, s AS (SELECT m, y, (x - min(x) OVER (PARTITION BY m)) / (max(x) OVER (PARTITION BY m) - min(x) OVER (PARTITION BY m)) AS p FROM long)
SELECT m AS feature, round(avg(-(y * ln(greatest(2.220446049250313e-16::DOUBLE, least(1 - 2.220446049250313e-16::DOUBLE, p)))
  + (1 - y) * ln(greatest(2.220446049250313e-16::DOUBLE, least(1 - 2.220446049250313e-16::DOUBLE, 1 - p))))), 5) AS log_loss
FROM s GROUP BY m"""))
def _(spark, d):
    return rounded(mean_losses(with_mean(scored(spark, d)), Y, THREE, scaled=True).select("feature", "log_loss"), 5)


ALL_CORNERS = "SELECT *, true AS stays FROM pts"
CORNERS = """SELECT *, row_number() OVER down = 1 OR lead(pos) OVER down IS NULL OR lead(pos) OVER down <> pos OR lead(neg) OVER down <> neg AS stays
  FROM pts WINDOW down AS (PARTITION BY m ORDER BY x DESC)"""


def roc_sql(corners):
    return with_scored(LONG + POINTS + f""", corners AS ({corners})
SELECT m AS feature, round(x, 6) AS threshold, round(fp / q, 6) AS fpr, round(tp / p, 6) AS tpr FROM corners WHERE stays
UNION ALL SELECT DISTINCT m, 'inf'::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE FROM pts""")


@query("A22_roc_curve_all_points", roc_sql(ALL_CORNERS))
def _(spark, d):
    return rounded(roc_curve(ordered_points(tally(with_mean(scored(spark, d)), Y, THREE)), drop_collinear=False))


@query("A22_roc_curve", roc_sql(CORNERS))
def _(spark, d):
    return rounded(roc_curve(ordered_points(tally(with_mean(scored(spark, d)), Y, THREE))))


@query("A23_pr_curve", with_scored(LONG + POINTS + """
SELECT m AS feature, round(x, 6) AS threshold, round(tp / (tp + fp), 6) AS precision, round(tp / p, 6) AS recall FROM pts
UNION ALL SELECT DISTINCT m, NULL::DOUBLE, 1.0::DOUBLE, 0.0::DOUBLE FROM pts"""))
def _(spark, d):
    return rounded(pr_curve(ordered_points(tally(with_mean(scored(spark, d)), Y, THREE))))


@query("A24_binary_columns", """
SELECT 'l_linenumber' AS "column", bool_and(l_linenumber IN (0, 1)) AND count(DISTINCT l_linenumber) <= 3 AS is_binary FROM lineitem
UNION ALL SELECT 'odd', bool_and(l_linenumber % 2 IN (0, 1)) FROM lineitem
UNION ALL SELECT 'nearly', count(DISTINCT CASE l_linenumber % 3 WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 1.0000001 END) <= 3 FROM lineitem
UNION ALL SELECT 'l_discount', bool_and(l_discount IN (0, 1)) FROM lineitem""")
def _(spark, d):
    li = table(spark, d, "lineitem")
    n = F.col("l_linenumber")
    rows = li.select(
        "l_linenumber",
        (n % 2).alias("odd"),
        F.when(n % 3 == 0, 0.0).when(n % 3 == 1, 1.0).otherwise(1.0000001).alias("nearly"),
        "l_discount",
    )
    return binary_columns(rows, rows.columns)


@query("A26_summary", with_lines(LONG + POINTS + f"""
SELECT CASE m WHEN 'xgb_prob' THEN 'xgb' WHEN 'nn_prob' THEN 'nn' ELSE 'ensemble_avg' END AS model,
  round({AUC}, 6) AS roc_auc, round({AP}, 6) AS pr_auc,
  round(sum(pos * (x - 1) * (x - 1) + neg * x * x) / max(p + q), 6) AS brier FROM pts GROUP BY m"""))
def _(spark, d):
    names = {"xgb_prob": "xgb", "nn_prob": "nn", "ensemble_prob": "ensemble_avg"}
    return rounded(summary_metrics(with_mean(scored_lines(spark, d)), Y, names))


@query("A27_cost_model", with_scored(LONG + GRID3 + CONF + f"SELECT *, {cost_sql()} FROM conf"))
def _(spark, d):
    return cost_columns(threshold_sweep(with_mean(scored(spark, d)), Y, THREE, REPORT))


@query("A28_baselines", with_scored("""
, k AS (SELECT count(*) FILTER (WHERE readmitted = 1) AS p, count(*) FILTER (WHERE readmitted = 0) AS q FROM scored)
SELECT 'all_prediction' AS model, 0::BIGINT AS tn, q AS fp, 0::BIGINT AS fn, p AS tp FROM k
UNION ALL SELECT 'no_prediction', q, 0, p, 0 FROM k"""))
def _(spark, d):
    totals = scored(spark, d).agg(F.count_if(F.col(Y) == 1).alias("pos"), F.count_if(F.col(Y) == 0).alias("neg"))
    return baselines(totals)


@query("A29_histogram", """
WITH s AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi, count(l_extendedprice) AS n, avg(l_extendedprice) AS mean FROM lineitem)
, b AS (SELECT least(floor((l_extendedprice - lo) / (hi - lo) * 1000), 999)::INT AS bin, count(*) AS n FROM lineitem, s GROUP BY 1)
SELECT 'l_extendedprice' AS "column", i::INT AS bin, round(lo + i * ((hi - lo) / 1000), 6) AS low,
  round(lo + i * ((hi - lo) / 1000) + (hi - lo) / 1000, 6) AS high, coalesce(b.n, 0) AS n,
  round(coalesce(b.n, 0) / (s.n * ((hi - lo) / 1000)), 9) AS density, round(mean, 3) AS mean
FROM range(1000) r(i) CROSS JOIN s LEFT JOIN b ON b.bin = i""")
def _(spark, d):
    bins = histogram(table(spark, d, "lineitem"), ["l_extendedprice", "absent"], 1000, on_missing="skip")
    return bins.withColumns(
        {c: F.round(c, 6) for c in ("low", "high")} | {"mean": F.round("mean", 3), "density": F.round("density", 9)}
    )


@query("A30_normalized_confusion", with_scored(LONG + GRID3 + CONF + """
SELECT 'all' AS how, *, round(tn::DOUBLE / (tp+tn+fp+fn), 6) AS tn_share, round(fp::DOUBLE / (tp+tn+fp+fn), 6) AS fp_share,
  round(fn::DOUBLE / (tp+tn+fp+fn), 6) AS fn_share, round(tp::DOUBLE / (tp+tn+fp+fn), 6) AS tp_share FROM conf
UNION ALL SELECT 'true', *, round(tn::DOUBLE / (tn+fp), 6), round(fp::DOUBLE / (tn+fp), 6),
  round(fn::DOUBLE / (tp+fn), 6), round(tp::DOUBLE / (tp+fn), 6) FROM conf
UNION ALL SELECT 'pred', *, coalesce(round(tn::DOUBLE / nullif(tn+fn, 0), 6), 0), coalesce(round(fp::DOUBLE / nullif(tp+fp, 0), 6), 0),
  coalesce(round(fn::DOUBLE / nullif(tn+fn, 0), 6), 0), coalesce(round(tp::DOUBLE / nullif(tp+fp, 0), 6), 0) FROM conf"""))
def _(spark, d):
    counts = threshold_sweep(with_mean(scored(spark, d)), Y, THREE, REPORT)
    out = None
    for how in ("all", "true", "pred"):
        part = normalized_confusion(counts, how).withColumn("how", F.lit(how))
        out = part if out is None else out.unionByName(part)
    return rounded(out)


@query("A32_quantile_grid", """
WITH r AS (SELECT l_extendedprice AS x, row_number() OVER (ORDER BY l_extendedprice) - 1 AS i, count(*) OVER () AS n FROM lineitem)
, g AS (SELECT k, k / 1000.0::DOUBLE AS q, (k * (n - 1) // 1000) AS lo, (k * (n - 1) % 1000) / 1000.0::DOUBLE AS part
  FROM range(1001) t(k), (SELECT count(*) AS n FROM lineitem))
SELECT 'l_extendedprice' AS feature, k, q, round(a.x + part * (coalesce(b.x, a.x) - a.x), 6) AS value
FROM g JOIN r a ON a.i = lo LEFT JOIN r b ON b.i = lo + 1""")
def _(spark, d):
    return quantiles(table(spark, d, "lineitem"), ["l_extendedprice"], 1000).withColumn("value", F.round("value", 6))


@query("A32_median", with_scored(LONG + "SELECT m AS feature, round(median(x), 6) AS median FROM long GROUP BY m"))
def _(spark, d):
    grid = quantiles(with_mean(scored(spark, d)), THREE, 2).where("k = 1")
    return grid.select("feature", F.round("value", 6).alias("median"))


# ---- optimal cutoffs ----------------------------------------------------------


@query("W3_cumulative_counts", with_lines(LONG + POINTS + """
SELECT m AS feature, round(x, 9) AS x, pos, neg, tp::BIGINT AS tp, fp::BIGINT AS fp FROM pts"""))
def _(spark, d):
    points = ordered_points(tally(with_mean(scored_lines(spark, d)), Y, THREE))
    return rounded(points.select("feature", "x", "pos", "neg", "tp", "fp"), 9)


@query("W3_cumulative_counts_in_cells", with_lines(LONG + POINTS + """
SELECT m AS feature, round(x, 9) AS x, pos, neg, tp::BIGINT AS tp, fp::BIGINT AS fp FROM pts"""))
def _(spark, d):
    points = ordered_points(tally(with_mean(scored_lines(spark, d)), Y, THREE), cell_rows=2000)
    return rounded(points.select("feature", "x", "pos", "neg", "tp", "fp"), 9)


YOUDEN = "CASE WHEN max(tp / p - fp / q) > 0 THEN arg_max(x, {'j': tp / p - fp / q, 'x': x}) ELSE 'inf'::DOUBLE END"
F1 = "CASE WHEN tp / (tp + fp) + tp / p > 0 THEN 2 * (tp / (tp + fp)) * (tp / p) / (tp / (tp + fp) + tp / p) ELSE 0 END"


@query("W4_youden_threshold", with_scored(LONG + POINTS + f"SELECT m AS feature, round({YOUDEN}, 6) AS youden FROM pts GROUP BY m"))
def _(spark, d):
    points = ordered_points(tally(with_mean(scored(spark, d)), Y, THREE))
    return rounded(optimal_cutoffs(points)).select("feature", "youden")


@query("W5_f1_threshold", with_scored(LONG + POINTS + f"SELECT m AS feature, round(arg_max(x, {{'f': {F1}, 'x': -x}}), 6) AS f1 FROM pts GROUP BY m"))
def _(spark, d):
    points = ordered_points(tally(with_mean(scored(spark, d)), Y, THREE))
    return rounded(optimal_cutoffs(points)).select("feature", "f1")


@query("W6_balanced_threshold", with_scored(LONG + POINTS + """
SELECT m AS feature, round(arg_min(x, {'g': round(abs((tp + fp) / (p + q) - p / (p + q)), 12), 't': x}), 6) AS balanced FROM pts GROUP BY m"""))
def _(spark, d):
    points = ordered_points(tally(with_mean(scored(spark, d)), Y, THREE))
    return rounded(balanced_cutoffs(points))


@query("W6_balanced_quantile", with_scored(LONG + POINTS + """
, rk AS (SELECT m, x, row_number() OVER (PARTITION BY m ORDER BY x) - 1 AS i, count(*) OVER (PARTITION BY m) AS n FROM long)
, ps AS (SELECT m, k, (k * (n - 1) // 1000) AS lo, (k * (n - 1) % 1000) / 1000.0::DOUBLE AS part
  FROM (SELECT m, max(n) AS n FROM rk GROUP BY m), range(1001) t(k))
, cand AS (SELECT DISTINCT ps.m, a.x + part * (coalesce(b.x, a.x) - a.x) AS t FROM ps JOIN rk a ON a.m = ps.m AND a.i = lo
  LEFT JOIN rk b ON b.m = ps.m AND b.i = lo + 1)
, rate AS (SELECT c.m, c.t, abs(sum(CASE WHEN l.x >= c.t THEN 1 ELSE 0 END) / count(*)::DOUBLE - avg(l.y)) AS gap
  FROM cand c JOIN (SELECT m, x, y FROM long) l ON l.m = c.m GROUP BY c.m, c.t)
SELECT m AS feature, round(arg_min(t, {'g': round(gap, 12), 't': t}), 6) AS balanced FROM rate GROUP BY m"""))
def _(spark, d):
    points = ordered_points(tally(with_mean(scored(spark, d)), Y, THREE))
    return rounded(balanced_cutoffs(points, quantiles=1000))


@query("W7_fixed_or_median", """
WITH s AS (SELECT 'fixed' AS feature, 0.4::DOUBLE AS threshold FROM orders LIMIT 1)
SELECT 'flat' AS feature, median(3.5::DOUBLE) AS threshold FROM orders
UNION ALL SELECT 'price', arg_max(x, {'j': tp / p - fp / q, 'x': x}) FROM (
  SELECT x, (sum(pos) OVER (ORDER BY x DESC))::DOUBLE AS tp, (sum(neg) OVER (ORDER BY x DESC))::DOUBLE AS fp,
    (sum(pos) OVER ())::DOUBLE AS p, (sum(neg) OVER ())::DOUBLE AS q
  FROM (SELECT o_totalprice AS x, count(*) FILTER (WHERE o_orderstatus = 'F') AS pos, count(*) FILTER (WHERE o_orderstatus <> 'F') AS neg FROM orders GROUP BY 1))
UNION ALL SELECT 'price fixed', max(0.4::DOUBLE) FROM orders""")
def _(spark, d):
    o = table(spark, d, "orders")
    rows = o.select(
        (F.col("o_orderstatus") == "F").cast("int").alias("y"), F.lit(3.5).alias("flat"), F.col("o_totalprice").alias("price")
    )
    points = ordered_points(tally(rows, F.col("y"), ["flat", "price"]))
    fixed = pick_cutoffs(points.where("feature = 'price'"), "fixed", 0.4)
    return pick_cutoffs(points, "youden").unionByName(
        fixed.withColumn("feature", F.lit("price fixed"))
    )


# ---- every column against the label --------------------------------------------

VS_LONG = """, wide AS (SELECT readmitted AS y, xgb_prob, nn_prob, 1 - xgb_prob AS inverse,
    CASE WHEN xgb_prob >= 0.35 THEN 1 ELSE 0 END AS flag, 1 AS always, 7 AS flat,
    CASE WHEN id % 3 = 0 THEN NULL ELSE nn_prob END AS gaps FROM scored)
, long AS (SELECT 'xgb_prob' AS m, xgb_prob AS x, y FROM wide UNION ALL SELECT 'nn_prob', nn_prob, y FROM wide
  UNION ALL SELECT 'inverse', inverse, y FROM wide UNION ALL SELECT 'flag', flag, y FROM wide
  UNION ALL SELECT 'always', always, y FROM wide UNION ALL SELECT 'flat', flat, y FROM wide
  UNION ALL SELECT 'gaps', gaps, y FROM wide)
"""


def vs_sql(pick: str) -> str:
    """The metric table from first principles; ``pick`` chooses the cutoff from points s, tp, fp, p, q, per m."""
    eps = "2.220446049250313e-16::DOUBLE"
    return POINTS + f"""
, a AS (SELECT m, max(p) AS p, max(q) AS q, max(nd) AS nd, max(lo) AS lo, max(hi) AS hi,
    bool_and(x IN (0, 1)) AS is_bin, {AUC} AS auc FROM pts GROUP BY m)
, kept AS (SELECT *, NOT is_bin AND auc < 0.5 AS turned FROM a WHERE p > 0 AND q > 0 AND (is_bin OR nd >= 2))
, s AS (SELECT l.m, CASE WHEN turned THEN -x ELSE x END AS s, y, k.p, k.q FROM long l JOIN kept k ON l.m = k.m WHERE x IS NOT NULL)
, st AS (SELECT m, s, sum(y) AS pos, sum(1 - y) AS neg, max(p) AS p, max(q) AS q FROM s GROUP BY m, s)
, sp AS (SELECT m, s, pos, neg, p, q, (sum(pos) OVER (PARTITION BY m ORDER BY s DESC))::DOUBLE AS tp,
    (sum(neg) OVER (PARTITION BY m ORDER BY s DESC))::DOUBLE AS fp FROM st)
, ap AS (SELECT m, sum(pos * tp / (tp + fp)) / max(p) AS ap FROM sp GROUP BY m)
, cut AS ({pick})
, pred AS (SELECT s.m, y, CASE WHEN k.is_bin THEN s >= 1 ELSE s >= cut.t END AS hat FROM s JOIN kept k USING (m) JOIN cut USING (m))
, cm AS (SELECT m, count(*) FILTER (WHERE hat AND y = 1) AS tp, count(*) FILTER (WHERE NOT hat AND y = 0) AS tn,
    count(*) FILTER (WHERE hat AND y = 0) AS fp, count(*) FILTER (WHERE NOT hat AND y = 1) AS fn FROM pred GROUP BY m)
, sc AS (SELECT l.m, y, CASE WHEN is_bin THEN x ELSE (x - lo) / nullif(hi - lo, 0) END AS pr FROM long l JOIN kept k ON l.m = k.m WHERE x IS NOT NULL)
, loss AS (SELECT m, avg((pr - y) * (pr - y)) AS brier,
    avg(-(y * ln(greatest({eps}, least(1 - {eps}, pr))) + (1 - y) * ln(greatest({eps}, least(1 - {eps}, 1 - pr))))) AS ll FROM sc GROUP BY m)
, full_table AS (SELECT m AS feature,
    round(CASE WHEN is_bin AND nd < 2 THEN NULL WHEN turned THEN 1 - auc ELSE auc END, 6) AS auc_roc,
    round(CASE WHEN is_bin AND nd < 2 THEN NULL ELSE ap END, 6) AS auc_pr,
    round(CASE WHEN is_bin AND nd < 2 THEN NULL ELSE ap END, 6) AS avg_precision,
    round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp::DOUBLE / (2 * tp + fp + fn) END, 6) AS f1,
    round(CASE WHEN tp + fp = 0 THEN 0 ELSE tp::DOUBLE / (tp + fp) END, 6) AS precision,
    round(CASE WHEN tp + fn = 0 THEN 0 ELSE tp::DOUBLE / (tp + fn) END, 6) AS recall,
    round(tn::DOUBLE / nullif(tn + fp, 0), 6) AS specificity,
    round((tp + tn)::DOUBLE / (tp + tn + fp + fn), 6) AS accuracy,
    round(CASE WHEN tp + fp = 0 OR tp + fn = 0 OR tn + fp = 0 OR tn + fn = 0 THEN 0 ELSE
      (tp::DOUBLE * tn - fp::DOUBLE * fn) / sqrt((tp + fp)::DOUBLE * (tp + fn) * (tn + fp) * (tn + fn)) END, 6) AS mcc,
    round(ll, 5) AS log_loss, round(brier, 6) AS brier, tp, tn, fp, fn,
    round(CASE WHEN is_bin THEN NULL ELSE t END, 6) AS threshold_used,
    round((tp + fp)::DOUBLE / (tp + tn + fp + fn), 6) AS pred_pos_rate,
    round((tp + fn)::DOUBLE / (tp + tn + fp + fn), 6) AS prevalence, tp + tn + fp + fn AS n
  FROM kept JOIN ap USING (m) JOIN cut USING (m) JOIN cm USING (m) JOIN loss USING (m))
"""


PICK_YOUDEN = "SELECT m, CASE WHEN max(tp / p - fp / q) > 0 THEN arg_max(s, {'j': tp / p - fp / q, 's': s}) ELSE 'inf'::DOUBLE END AS t FROM sp GROUP BY m"
PICK_F1 = f"SELECT m, arg_max(s, {{'f': {F1}, 's': -s}}) AS t FROM sp GROUP BY m"
PICK_FIXED = "SELECT DISTINCT m, 0.5::DOUBLE AS t FROM sp"
PICK_BALANCED = "SELECT m, arg_min(s, {'g': abs((tp + fp) / (p + q) - p / (p + q)), 's': s}) AS t FROM sp GROUP BY m"


def vs_all(spark, d, strategy):
    s = scored(spark, d)
    wide = s.select(
        "readmitted", "xgb_prob", "nn_prob", (1 - F.col("xgb_prob")).alias("inverse"),
        (F.col("xgb_prob") >= 0.35).cast("int").alias("flag"), F.lit(1).alias("always"), F.lit(7).alias("flat"),
        F.when(F.col("id") % 3 != 0, F.col("nn_prob")).alias("gaps"),
    )
    out = metrics_vs_all(wide, Y, wide.columns[1:], strategy)
    return rounded(out.withColumn("log_loss", F.round("log_loss", 5)))


@query("A25_metrics_vs_all_youden", with_scored(VS_LONG + vs_sql(PICK_YOUDEN) + "SELECT * FROM full_table"))
def _(spark, d):
    return vs_all(spark, d, "youden")


@query("A25_metrics_vs_all_f1", with_scored(VS_LONG + vs_sql(PICK_F1) + "SELECT * FROM full_table"))
def _(spark, d):
    return vs_all(spark, d, "f1")


@query("A25_metrics_vs_all_fixed", with_scored(VS_LONG + vs_sql(PICK_FIXED) + "SELECT * FROM full_table"))
def _(spark, d):
    return vs_all(spark, d, "fixed")


@query("A25_metrics_vs_all_balanced", with_scored(VS_LONG + vs_sql(PICK_BALANCED) + "SELECT * FROM full_table"))
def _(spark, d):
    return vs_all(spark, d, "balanced")


@query("J6_column_by_label", with_scored(LONG + """
SELECT m AS feature, round(x, 6) AS x, sum(y)::BIGINT AS pos, sum(1 - y)::BIGINT AS neg FROM long GROUP BY m, x"""))
def _(spark, d):
    return rounded(tally(with_mean(scored(spark, d)), Y, THREE))


@query("A35_detect_label", """
SELECT 'flag' AS label_column, sum(l_linenumber % 2)::BIGINT AS positives FROM lineitem""")
def _(spark, d):
    rows = table(spark, d, "lineitem").select("l_quantity", "l_shipdate", (F.col("l_linenumber") % 2).alias("flag"), "l_tax")
    found = detect_label(rows)
    return rows.agg(F.lit(found).alias("label_column"), F.sum(quoted(found)).alias("positives"))


@query("A36_detect_score", with_scored("""
SELECT 'XGB_final_score' AS xgb, 'calibrated' AS nn, round(sum(xgb_prob), 3) AS xgb_sum, round(sum(nn_prob), 3) AS nn_sum FROM scored""".replace(
    "'calibrated'", "'prob_nn'")))
def _(spark, d):
    rows = scored(spark, d).select(
        F.col("id").alias("xgb_id"), F.col("xgb_prob").alias("XGB_final_score"), F.col("nn_prob").alias("prob_nn"), "priority"
    )
    xgb, nn = detect_score(rows, "xgb"), detect_score(rows, "nn")
    return rows.agg(
        F.lit(xgb).alias("xgb"), F.lit(nn).alias("nn"),
        F.round(F.sum(quoted(xgb)), 3).alias("xgb_sum"), F.round(F.sum(quoted(nn)), 3).alias("nn_sum"),
    )


@query("M16_validation_metrics", with_scored(LONG + POINTS + f"""
SELECT m AS feature, round(greatest(0, least(1, {AUC})), 6) AS validation_auc, round(greatest(0, least(1, {AP})), 6) AS validation_aucpr
FROM pts GROUP BY m"""))
def _(spark, d):
    return rounded(validation_metrics(ordered_points(tally(with_mean(scored(spark, d)), Y, THREE))))


# ---- tables of cutoffs ------------------------------------------------------------

SEARCH = """, grid AS (SELECT round(0.11::DOUBLE + (i - 500) * 0.0001::DOUBLE, 5) AS threshold FROM range(1001) r(i))
, g AS (SELECT CASE m WHEN 'xgb_prob' THEN 'xgb' WHEN 'nn_prob' THEN 'linear' ELSE 'stacked' END AS m, x, sum(y) AS pos, sum(1 - y) AS neg FROM long GROUP BY 1, 2)
, tot AS (SELECT m, sum(pos) AS p, sum(neg) AS q FROM g GROUP BY m)
, conf AS (SELECT g.m AS model, threshold, max(q)::BIGINT - sum(CASE WHEN g.x >= threshold THEN neg ELSE 0 END)::BIGINT AS tn,
    sum(CASE WHEN g.x >= threshold THEN neg ELSE 0 END)::BIGINT AS fp, max(p)::BIGINT - sum(CASE WHEN g.x >= threshold THEN pos ELSE 0 END)::BIGINT AS fn,
    sum(CASE WHEN g.x >= threshold THEN pos ELSE 0 END)::BIGINT AS tp FROM g JOIN tot USING (m) CROSS JOIN grid GROUP BY g.m, threshold)
, every AS (SELECT *, printf('%.2f%%', threshold * 100) AS cp FROM conf
  UNION ALL SELECT 'all_prediction', 1.0::DOUBLE, 0, max(q), 0, max(p), '100%' FROM tot
  UNION ALL SELECT 'no_prediction', 0.0::DOUBLE, max(q), 0, max(p), 0, '0%' FROM tot)
, e AS (SELECT *, tp + tn + fp + fn AS n, (tp + fn)::DOUBLE / (tp + tn + fp + fn) AS prev, tp::DOUBLE / (tp + fn) AS r,
    tp::DOUBLE / nullif(tp + fp, 0) AS pr FROM every)
, cuts AS (SELECT cp AS Cutoff_Percentage, round((r + tn::DOUBLE / (tn + fp)) / 2, 6) AS ROC_AUC,
    round_even((round_even(0.5::DOUBLE * tp, 0) * 15000 - (tp + fp)::DOUBLE * 500) / n * 100, 0) / 100 AS Net_Cost_Savings,
    round_even(0.5::DOUBLE * tp, 0) AS Prevented_Readmissions, round(r, 6) AS Recall, round(pr, 6) AS Precision,
    round(2 * tp::DOUBLE / (2 * tp + fp + fn), 6) AS F1_Score, round((tp + tn)::DOUBLE / n, 6) AS Accuracy,
    round(""" + PR_TRAPEZOID + """, 6) AS "PR AUC", tp::BIGINT AS True_Positives, fp::BIGINT AS False_Positives, fn::BIGINT AS False_Negatives,
    round(tn::DOUBLE / (tn + fp), 6) AS Specificity,
    round_even(round_even(0.5::DOUBLE * tp, 0) * 15000 / n * 100, 0) / 100 AS "Per-Patient Savings",
    round_even((tp + fp)::DOUBLE * 500 / n * 100, 0) / 100 AS Up_front_Expense, model AS Type_of_assessment, threshold FROM e)
"""
MODELS = {"xgb_prob": "xgb", "nn_prob": "linear", "ensemble_prob": "stacked"}


def cuts(spark, d):
    return rounded(cutoff_table(with_mean(scored_lines(spark, d)), Y, MODELS))


@query("U3_union_of_assessments", with_lines(LONG + SEARCH + "SELECT * FROM cuts"))
def _(spark, d):
    return cuts(spark, d)


@query("P18_assessment_filter", with_lines(LONG + SEARCH + "SELECT * FROM cuts WHERE Type_of_assessment IN ('all_prediction', 'no_prediction')"))
def _(spark, d):
    return cuts(spark, d).where(F.col("Type_of_assessment").isin("all_prediction", "no_prediction"))


@query("W8_best_with_ties", with_lines(LONG + SEARCH + """
SELECT * FROM cuts WHERE Type_of_assessment NOT LIKE '%prediction'
QUALIFY rank() OVER (PARTITION BY Type_of_assessment ORDER BY ROC_AUC DESC) = 1"""))
def _(spark, d):
    searched = cuts(spark, d).where(~F.col("Type_of_assessment").endswith("prediction"))
    return best_rows(searched, "ROC_AUC")


@query("W9_first_best", with_lines(LONG + SEARCH + """
SELECT * FROM cuts WHERE Type_of_assessment NOT LIKE '%prediction'
QUALIFY row_number() OVER (PARTITION BY Type_of_assessment ORDER BY Net_Cost_Savings DESC, threshold DESC) = 1"""))
def _(spark, d):
    searched = cuts(spark, d).where(~F.col("Type_of_assessment").endswith("prediction"))
    return first_best(searched, "Net_Cost_Savings")


CASES = """
SELECT *, Type_of_assessment || '_auc' AS "case" FROM (SELECT * FROM cuts WHERE Type_of_assessment NOT LIKE '%prediction'
  QUALIFY rank() OVER (PARTITION BY Type_of_assessment ORDER BY ROC_AUC DESC) = 1)
UNION ALL SELECT *, Type_of_assessment || '_cost' FROM (SELECT * FROM cuts WHERE Type_of_assessment NOT LIKE '%prediction'
  QUALIFY rank() OVER (PARTITION BY Type_of_assessment ORDER BY Net_Cost_Savings DESC) = 1)
UNION ALL SELECT *, Type_of_assessment FROM cuts WHERE Type_of_assessment LIKE '%prediction'"""


@query("U4_best_cases", with_scored(LONG + SEARCH + CASES))
def _(spark, d):
    return best_cases(rounded(cutoff_table(with_mean(scored(spark, d)), Y, MODELS)))


@query("L8_best_cutoffs", with_lines(LONG + SEARCH + CASES))
def _(spark, d):
    return best_cases(cuts(spark, d))


@query("T8_models_by_saving", with_lines(LONG + SEARCH + """
SELECT Type_of_assessment, max(Net_Cost_Savings) AS saving FROM cuts GROUP BY 1 ORDER BY saving DESC"""))
def _(spark, d):
    best = cuts(spark, d).groupBy("Type_of_assessment").agg(F.max("Net_Cost_Savings").alias("saving"))
    return best.orderBy(F.desc("saving"), "Type_of_assessment")


# ---- the evaluations ------------------------------------------------------------------


@query("L6_evaluator_summary", with_scored(LONG + POINTS + f"""
SELECT CASE m WHEN 'xgb_prob' THEN 'xgb' WHEN 'nn_prob' THEN 'nn' ELSE 'ensemble_avg' END AS model,
  round({AUC}, 6) AS roc_auc, round({AP}, 6) AS pr_auc,
  round(sum(pos * (x - 1) * (x - 1) + neg * x * x) / max(p + q), 6) AS brier FROM pts GROUP BY m"""))
def _(spark, d):
    return rounded(evaluate(scored(spark, d)).summary)


@query("L6_evaluator_points", with_scored(LONG + GRID3 + CONF + f"""
SELECT CASE model WHEN 'xgb_prob' THEN 'xgb' WHEN 'nn_prob' THEN 'nn' ELSE 'ensemble_avg' END AS model,
  threshold, tn, fp, fn, tp, {POINT_COLUMNS} FROM conf"""))
def _(spark, d):
    return rounded(evaluate(scored(spark, d), "readmitted").points)


@query("L6_evaluator_curves", with_scored(LONG + POINTS + """
, roc AS (SELECT m, x AS threshold, fp / q AS fpr, tp / p AS tpr FROM pts
  UNION ALL SELECT DISTINCT m, 'inf'::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE FROM pts)
SELECT CASE m WHEN 'xgb_prob' THEN 'xgb' WHEN 'nn_prob' THEN 'nn' ELSE 'ensemble_avg' END AS feature,
  round(threshold, 6) AS threshold, round(fpr, 6) AS fpr, round(tpr, 6) AS tpr FROM roc"""))
def _(spark, d):
    return rounded(evaluate(scored(spark, d)).roc)


EXPORT_LONG = """, base AS (SELECT readmitted AS y, xgb_prob, nn_prob, (xgb_prob + nn_prob) / 2.0::DOUBLE AS ensemble_prob FROM scored)
, three AS (SELECT 'xgb_prob' AS m, xgb_prob AS x, y FROM base UNION ALL SELECT 'nn_prob', nn_prob, y FROM base
  UNION ALL SELECT 'ensemble_prob', ensemble_prob, y FROM base)
, cutoffs AS (SELECT round((i + 1) * 0.05::DOUBLE, 2) AS c FROM range(19) r(i))
, long AS (SELECT m, x, y FROM three UNION ALL
  SELECT m || '_ge_' || lpad(CAST(round(c * 100)::INT AS VARCHAR), 3, '0') || 'pct', CASE WHEN x >= c THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END, y FROM three, cutoffs)
"""
EXPORT = EXPORT_LONG + vs_sql(PICK_YOUDEN) + f", priced AS (SELECT *, {cost_sql()} FROM full_table)\n"


def export_table(spark, d):
    return rounded(export(scored(spark, d)).metrics.withColumn("log_loss", F.round("log_loss", 5)))


@query("L7_export_metrics", with_scored(EXPORT + "SELECT * FROM priced"))
def _(spark, d):
    return export_table(spark, d)


@query("L7_export_metrics_per_table_row", with_scored(EXPORT_LONG + vs_sql(PICK_YOUDEN) + f"""
, long_ends AS (SELECT count(*)::DOUBLE AS n_rows FROM full_table)
SELECT full_table.*, {cost_sql(other="n_rows")} FROM full_table, long_ends"""))
def _(spark, d):
    base = with_mean(scored(spark, d))
    out = export_metrics(base, "readmitted", THREE, savings_per_table_row=True)
    return rounded(out.withColumn("log_loss", F.round("log_loss", 5)))


@query("L7_export_confusion", with_scored(EXPORT + """
SELECT feature, tn, fp, fn, tp, round(tn::DOUBLE / n, 6) AS tn_share, round(fp::DOUBLE / n, 6) AS fp_share,
  round(fn::DOUBLE / n, 6) AS fn_share, round(tp::DOUBLE / n, 6) AS tp_share
FROM priced WHERE feature IN ('xgb_prob', 'xgb_prob_ge_035pct', 'ensemble_prob_ge_035pct')"""))
def _(spark, d):
    return rounded(export(scored(spark, d)).confusion)


@query("T6_top_tables", with_scored(EXPORT + """
SELECT 'fewest_misses' AS kind, * FROM (SELECT * FROM priced ORDER BY fn, net_per_patient_savings DESC, feature LIMIT 10)
UNION ALL SELECT 'greatest_auc', * FROM (SELECT * FROM priced ORDER BY auc_roc DESC NULLS LAST, feature LIMIT 10)
UNION ALL SELECT 'greatest_savings', * FROM (SELECT * FROM priced ORDER BY net_per_patient_savings DESC NULLS LAST, feature LIMIT 10)"""))
def _(spark, d):
    out = None
    for name, part in sorted(top_tables(export_table(spark, d)).items()):
        part = part.withColumn("kind", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


@query("T7_sorted_metrics", with_scored(VS_LONG + vs_sql(PICK_YOUDEN) + "SELECT feature, auc_roc FROM full_table ORDER BY auc_roc DESC NULLS LAST, feature"))
def _(spark, d):
    return sort_metrics(vs_all(spark, d, "youden")).select("feature", "auc_roc")


@query("L0_best_saving", with_scored(LONG + GRID3 + CONF + f"""
SELECT *, {POINT_COLUMNS}, {cost_sql()} FROM conf ORDER BY net_per_patient_savings DESC, model, threshold LIMIT 10"""))
def best_saving_query(spark, d):
    return rounded(best_saving(with_mean(scored(spark, d)), Y, THREE, REPORT))
