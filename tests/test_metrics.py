"""Metrics against brute force on small literal tables."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortscore.operators.cost import cost_columns
from cohortscore.operators.metrics import (
    balanced_cutoffs, hard_auc, metrics_vs_all, optimal_cutoffs, pick_cutoffs, point_metrics, pr_curve,
    ranking_metrics, roc_curve, summarize_points,
)
from cohortscore.operators.profile import histogram, quantiles
from cohortscore.operators.sweep import threshold_sweep
from cohortscore.operators.tally import ordered_points, tally
from cohortscore.plans.evaluation import evaluate

# Published counts (threshold, tn, fp, fn, tp) and what was derived from them.
PUBLISHED = [
    (0.2, 15757, 2015, 1719, 532, 0.8135, 0.2089, 0.2363, 0.2218),
    (0.3, 17094, 678, 1995, 256, 0.8665, 0.2741, 0.1137, 0.1608),
    (0.5, 17629, 143, 2183, 68, 0.8838, 0.3223, 0.0302, 0.0552),
]


def sample(spark, n=400, ties=40, seed=1):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        y = int(draw.random() < 0.3)
        rows.append((i, y, draw.randrange(ties) / ties + 0.1 * y, draw.random()))
    return rows, spark.createDataFrame(rows, "id int, y int, a double, b double")


def brute_auc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    diff = pos[:, None] - neg[None, :]
    return ((diff > 0).sum() + 0.5 * (diff == 0).sum()) / (len(pos) * len(neg))


def brute_curve(y, s):
    cuts = np.unique(s)[::-1]
    tp = np.array([((s >= c) & (y == 1)).sum() for c in cuts])
    fp = np.array([((s >= c) & (y == 0)).sum() for c in cuts])
    return cuts, tp, fp


def brute_ap(y, s):
    _, tp, fp = brute_curve(y, s)
    recall, precision = tp / y.sum(), tp / (tp + fp)
    return float(np.sum(np.diff(np.concatenate([[0], recall])) * precision))


def test_published_counts(spark):
    counts = spark.createDataFrame([r[:5] for r in PUBLISHED], "threshold double, tn long, fp long, fn long, tp long")
    got = {r["threshold"]: r for r in point_metrics(counts).collect()}
    for t, _, _, _, _, accuracy, precision, recall, f1 in PUBLISHED:
        row = got[t]
        assert [round(row[c], 4) for c in ("accuracy", "precision", "recall", "f1")] == [accuracy, precision, recall, f1]


def test_published_counts_from_scores(spark):
    """The nested counts, spread out to a scored table, come back from the sweep."""
    (_, _, fp2, _, tp2, *_), (_, _, fp3, _, tp3, *_), (_, tn5, fp5, fn5, tp5, *_) = PUBLISHED
    pos, neg = fn5 + tp5, tn5 + fp5
    groups = [
        (1, 0.6, tp5), (1, 0.4, tp3 - tp5), (1, 0.25, tp2 - tp3), (1, 0.1, pos - tp2),
        (0, 0.6, fp5), (0, 0.4, fp3 - fp5), (0, 0.25, fp2 - fp3), (0, 0.1, neg - fp2),
    ]
    grouped = spark.createDataFrame(groups, "y int, p double, n int")
    rows = grouped.select("y", "p", F.explode(F.sequence(F.lit(1), F.col("n"))))
    got = {r["threshold"]: (r["tn"], r["fp"], r["fn"], r["tp"]) for r in threshold_sweep(rows, "y", ["p"], [0.2, 0.3, 0.5]).collect()}
    assert got == {t: (tn, fp, fn, tp) for t, tn, fp, fn, tp, *_ in PUBLISHED}


@pytest.mark.parametrize("cell_rows", [10**6, 7])
def test_ranking_matches_brute_force(spark, cell_rows):
    rows, df = sample(spark)
    y = np.array([r[1] for r in rows])
    points = ordered_points(tally(df, "y", ["a", "b"]), cell_rows=cell_rows)
    got = {r["feature"]: r for r in ranking_metrics(points).collect()}
    for name, at in (("a", 2), ("b", 3)):
        s = np.array([r[at] for r in rows])
        assert got[name]["roc_auc"] == pytest.approx(brute_auc(y, s), abs=1e-12)
        assert got[name]["pr_auc"] == pytest.approx(brute_ap(y, s), abs=1e-12)


def test_one_hot_value_in_cells(spark):
    """A value that fills a third of the rows changes nothing."""
    rows = [(i % 2, 0.5 if i % 3 == 0 else i / 3000) for i in range(3000)]
    df = spark.createDataFrame(rows, "y int, a double")
    t = tally(df, "y", ["a"])
    plain = sorted(tuple(r) for r in ordered_points(t).collect())
    cells = sorted(tuple(r) for r in ordered_points(t, cell_rows=100).collect())
    assert plain == cells and plain[-1][4] + plain[-1][5] >= 1


def test_turning_the_score_mirrors_the_area(spark):
    rows, df = sample(spark)
    both = df.select("y", "a", (-F.col("a")).alias("minus"))
    got = {r["feature"]: r["roc_auc"] for r in ranking_metrics(ordered_points(tally(both, "y", ["a", "minus"]))).collect()}
    assert got["a"] + got["minus"] == pytest.approx(1.0, abs=1e-12)


def test_cutoffs_and_their_ties(spark):
    rows, df = sample(spark, 300, 12, 5)
    y, s = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    cuts, tp, fp = brute_curve(y, s)
    j = tp / y.sum() - fp / (len(y) - y.sum())
    f1 = 2 * tp / (2 * tp + fp + (y.sum() - tp))
    row = optimal_cutoffs(ordered_points(tally(df, "y", ["a"]))).first()
    assert row["youden"] == cuts[np.argmax(j)]
    assert row["f1"] == cuts[::-1][np.argmax(f1[::-1])]
    gap = np.abs((tp + fp) / len(y) - y.mean())[::-1]
    assert balanced_cutoffs(ordered_points(tally(df, "y", ["a"]))).first()["balanced"] == cuts[::-1][np.argmin(gap)]


def test_balanced_over_quantiles_both_ways(spark):
    draw = random.Random(3)
    rows = [(int(draw.random() < 0.2), draw.random()) for _ in range(2500)]
    df = spark.createDataFrame(rows, "y int, a double")
    y, s = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    points = ordered_points(tally(df, "y", ["a"]))
    for flipped, scores in ((False, s), (True, -s)):
        grid = np.quantile(scores, np.linspace(0, 1, 1001))
        rate = np.array([(scores >= t).mean() for t in grid])
        gaps = np.round(np.abs(rate - y.mean()), 12)
        want = grid[int(np.argmin(gaps))]
        got = balanced_cutoffs(points, flipped, quantiles=1000).first()["balanced"]
        assert got == pytest.approx(want, abs=2e-3)
        assert abs((scores >= got).mean() - y.mean()) <= gaps.min() + 1e-3


def test_uninformative_score_flags_nobody(spark):
    df = spark.createDataFrame([(1, 0.1), (0, 0.9), (1, 0.2), (0, 0.8)], "y int, a double")
    points = ordered_points(tally(df, "y", ["a"]))
    assert math.isinf(optimal_cutoffs(points).first()["youden"])


def test_constant_score_gives_its_median(spark):
    df = spark.createDataFrame([(1, 0.4), (0, 0.4)], "y int, a double")
    assert pick_cutoffs(ordered_points(tally(df, "y", ["a"]))).first()["threshold"] == 0.4


def test_metrics_vs_all_rules(spark):
    rows = [(i % 2, float(i), 1.0 if i > 5 else 0.0, 1.0, 7.0, -float(i), None) for i in range(10)]
    df = spark.createDataFrame(rows, "y int, up double, flag double, always double, flat double, down double, nothing double")
    got = {r["feature"]: r for r in metrics_vs_all(df, "y", df.columns[1:]).collect()}
    assert set(got) == {"up", "flag", "always", "down"}
    assert got["always"]["auc_roc"] is None and got["always"]["tp"] == 5
    assert got["down"]["auc_roc"] == pytest.approx(got["up"]["auc_roc"])
    assert got["down"]["threshold_used"] == got["up"]["threshold_used"]  # refers to the turned score
    assert got["flag"]["threshold_used"] is None and got["flag"]["n"] == 10
    one_class = spark.createDataFrame([(1, 0.2), (1, 0.4)], "y int, a double")
    for strategy in ("youden", "f1", "fixed", "balanced"):
        assert metrics_vs_all(one_class, "y", ["a"], strategy).collect() == []


def test_missing_scores_are_dropped_pairwise(spark):
    rows = [(1, 0.9, None), (0, None, 0.5), (1, float("nan"), 0.7), (0, 0.1, 0.2), (None, 0.3, 0.3)]
    df = spark.createDataFrame(rows, "y int, a double, b double")
    got = {r["feature"]: (r["n"], r["auc_roc"]) for r in metrics_vs_all(df, "y", ["a", "b"]).collect()}
    assert got == {"a": (2, 1.0), "b": (3, 1.0)}


def test_curve_ends(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.2)], "y int, a double")
    points = ordered_points(tally(df, "y", ["a"]))
    roc = sorted((r["fpr"], r["tpr"]) for r in roc_curve(points).collect())
    assert roc[0] == (0.0, 0.0) and roc[-1] == (1.0, 1.0)
    assert (1.0, 0.0) in {(r["precision"], r["recall"]) for r in pr_curve(points).collect()}


def test_sweep_edges_and_monotony(spark):
    df = spark.createDataFrame([(1, 0.15), (0, 0.15), (1, 0.3), (0, 0.1)], "y int, a double")
    rows = threshold_sweep(df, "y", ["a"], [0.1, 0.15, 0.15000001, 0.9]).orderBy("threshold").collect()
    assert [r["tp"] + r["fp"] for r in rows] == [4, 3, 1, 0]
    assert all(r["tp"] + r["fp"] + r["tn"] + r["fn"] == 4 for r in rows)
    assert [r["tp"] for r in rows] == sorted((r["tp"] for r in rows), reverse=True)


def test_hard_areas_match_the_curve(spark):
    rows, df = sample(spark, 200)
    counts = hard_auc(threshold_sweep(df, "y", ["a"], [0.4])).first()
    y = np.array([r[1] for r in rows])
    hat = np.array([float(r[2] >= 0.4) for r in rows])
    assert counts["roc_auc"] == pytest.approx(brute_auc(y, hat), abs=1e-12)
    recall = np.array([1.0, counts["tp"] / y.sum(), 0.0])
    precision = np.array([y.mean(), counts["tp"] / (counts["tp"] + counts["fp"]), 1.0])
    trapezoid = float(np.sum((recall[:-1] - recall[1:]) * (precision[:-1] + precision[1:]) / 2))
    assert counts["pr_auc"] == pytest.approx(trapezoid, abs=1e-12)


def test_costs(spark):
    counts = spark.createDataFrame([(3, 2, 1, 4)], "tp long, fp long, fn long, tn long")
    row = cost_columns(counts).first()
    assert row["total_cost_of_implimenting_program"] == 2500 and row["readmissions_prevented"] == 2
    assert row["net_savings_to_hosptial_system"] == 27500 and row["net_per_patient_savings"] == 2750
    other = cost_columns(counts, F.lit(20), F.lit(4)).first()
    assert other["per_patient_savings_from_readmissions_prevention"] == 7500 and other["per_patient_outlay"] == 125


def test_quantiles_are_exact(spark):
    draw = random.Random(9)
    values = [round(draw.gauss(0, 1), 2) for _ in range(501)] + [5.0] * 200
    df = spark.createDataFrame([(v,) for v in values], "a double")
    got = [r["value"] for r in quantiles(df, ["a"], 1000).orderBy("k").collect()]
    assert got == pytest.approx(list(np.quantile(values, np.linspace(0, 1, 1001))), abs=1e-9)
    single = spark.createDataFrame([(4.0,)], "a double")
    assert [r["value"] for r in quantiles(single, ["a"], 4).collect()] == [4.0] * 5


def test_histogram_matches_numpy(spark):
    draw = random.Random(2)
    values = [draw.random() for _ in range(300)]
    df = spark.createDataFrame([(v,) for v in values], "a double")
    want, _ = np.histogram(values, bins=20)
    got = histogram(df, ["a"], 20).orderBy("bin").collect()
    assert [r["n"] for r in got] == want.tolist()
    assert sum(r["density"] * (r["high"] - r["low"]) for r in got) == pytest.approx(1.0)
    with pytest.raises(KeyError):
        histogram(df, ["absent"])


def test_one_class_gives_null_areas(spark):
    for y in (0, 1):
        df = spark.createDataFrame([(y, 0.2), (y, 0.4)], "y int, a double")
        points = ordered_points(tally(df, "y", ["a"]))
        row = summarize_points(points, {"a": "m"}).first()
        assert row["roc_auc"] is None and row["pr_auc"] is None and row["brier"] is not None
        assert optimal_cutoffs(points).collect() == []
        assert all(r["fpr"] is None or r["tpr"] is None or r["threshold"] == math.inf for r in roc_curve(points).collect())


def test_cells_are_no_more_than_partitions_and_columns(spark):
    from cohortscore.operators.tally import placed

    names = [f"c{k}" for k in range(50)]
    df = spark.range(300).select((F.col("id") % 2).cast("int").alias("y"), *[(F.col("id") * (k + 1) % 97).cast("double").alias(c) for k, c in enumerate(names)])
    stored = placed(tally(df, "y", names), cell_rows=200)
    pairs, cells = stored.select("feature", "cell").distinct().count(), stored.select("cell").distinct().count()
    assert cells > 5 and pairs <= cells + len(names)


def test_balanced_is_exact_above_any_number_of_values(spark):
    rows, df = sample(spark, 3000, 10**6, 8)
    y, s = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    cuts, tp, fp = brute_curve(y, s)
    gap = np.abs((tp + fp) / len(y) - y.mean())[::-1]
    assert balanced_cutoffs(ordered_points(tally(df, "y", ["a"]))).first()["balanced"] == cuts[::-1][np.argmin(gap)]


def test_baselines_count_patients_without_a_score(spark):
    from cohortscore.plans.evaluation import cutoff_table

    df = spark.createDataFrame([(1, 0.9), (0, 0.1), (1, None), (0, None)], "y int, p double")
    table = cutoff_table(df, "y", {"p": "p"}, [0.4, 0.5])
    everyone = table.where("Type_of_assessment = 'all_prediction'").first()
    assert list(everyone.asDict().values()).count(2) == 2  # true and false positives


def test_evaluator_curves_have_every_score(spark):
    """Scores in a straight line of equal steps are points of the evaluator's curve, too."""
    rows = spark.createDataFrame([(i % 2, i // 2 / 10, i // 2 / 20) for i in range(20)], "readmitted int, xgb_prob double, nn_prob double")
    found = evaluate(rows, "readmitted").roc
    assert {r["feature"]: r["count"] for r in found.groupBy("feature").count().collect()} == {"xgb": 11, "nn": 11, "ensemble_avg": 11}


def test_small_cells_need_no_partitions_of_their_own(spark):
    """The files of a placed tally are those of the shuffle's partitions, however small its cells are."""
    from cohortscore.operators.tally import placed

    df = spark.range(4000).select((F.col("id") % 3 == 0).cast("int").alias("y"), F.col("id").cast("double").alias("a"))
    stored = placed(tally(df, "y", ["a"]), cell_rows=5)
    assert stored.select("cell").distinct().count() >= 800 and stored.groupBy("cell").count().agg({"count": "max"}).first()[0] <= 5
    assert len(stored.inputFiles()) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    spans = [tuple(r) for r in stored.groupBy("cell").agg(F.min("x"), F.max("x")).orderBy("cell").select("min(x)", "max(x)").collect()]
    assert all(high < low for (_, high), (low, _) in zip(spans, spans[1:]))
