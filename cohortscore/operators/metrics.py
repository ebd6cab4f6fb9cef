"""Classifier metrics from confusion counts and from ordered points."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortscore.functions.numeric import ratio
from cohortscore.operators.tally import long_scores, ordered_points, quantile_grid, tally
from cohortscore.session import settle

# Fixed value: machine epsilon of a double, the clip of the log loss.
EPSILON = 2.220446049250313e-16


def _d(name: str) -> Column:
    return F.col(name).cast("double")


def point_metrics(counts: DataFrame, zero_division: float | None = 0.0) -> DataFrame:
    """Add accuracy, precision, recall and f1 to confusion counts."""
    hits, n = _d("tp") + _d("tn"), _d("tp") + _d("tn") + _d("fp") + _d("fn")
    return counts.withColumns(
        {
            "accuracy": ratio(hits, n, zero_division),
            "precision": ratio(_d("tp"), _d("tp") + _d("fp"), zero_division),
            "recall": ratio(_d("tp"), _d("tp") + _d("fn"), zero_division),
            "f1": ratio(2 * _d("tp"), 2 * _d("tp") + _d("fp") + _d("fn"), zero_division),
        }
    )


def rate_metrics(counts: DataFrame) -> DataFrame:
    """Add specificity, mcc, prevalence, pred_pos_rate and n."""
    n = F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn")
    spread = (
        (_d("tp") + _d("fp")) * (_d("tp") + _d("fn")) * (_d("tn") + _d("fp")) * (_d("tn") + _d("fn"))
    )
    return counts.withColumns(
        {
            "specificity": ratio(_d("tn"), _d("tn") + _d("fp"), None),
            "mcc": ratio(_d("tp") * _d("tn") - _d("fp") * _d("fn"), F.sqrt(spread), 0.0),
            "prevalence": ratio(_d("tp") + _d("fn"), n, None),
            "pred_pos_rate": ratio(_d("tp") + _d("fp"), n, None),
            "n": n,
        }
    )


def hard_auc(counts: DataFrame) -> DataFrame:
    """Add the areas of a 0/1 prediction: ``roc_auc`` and trapezoid ``pr_auc``."""
    prevalence = ratio(_d("tp") + _d("fn"), _d("tp") + _d("tn") + _d("fp") + _d("fn"), None)
    recall = ratio(_d("tp"), _d("tp") + _d("fn"), None)
    precision = ratio(_d("tp"), _d("tp") + _d("fp"), None)
    specificity = ratio(_d("tn"), _d("tn") + _d("fp"), None)
    one_value = (F.col("tp") + F.col("fp") == 0) | (F.col("tn") + F.col("fn") == 0)
    split_area = (1 - recall) * (prevalence + precision) / 2 + recall * (precision + 1) / 2
    return counts.withColumns(
        {
            "roc_auc": (recall + specificity) / 2,
            "pr_auc": F.when(one_value, (1 + prevalence) / 2).otherwise(split_area),
        }
    )


def normalized_confusion(counts: DataFrame, how: str) -> DataFrame:
    """Shares of the four cells of all rows, of the true class or of the prediction."""
    bottoms = {
        "all": {c: ("tp", "tn", "fp", "fn") for c in ("tp", "tn", "fp", "fn")},
        "true": {"tp": ("tp", "fn"), "fn": ("tp", "fn"), "tn": ("tn", "fp"), "fp": ("tn", "fp")},
        "pred": {"tp": ("tp", "fp"), "fp": ("tp", "fp"), "tn": ("tn", "fn"), "fn": ("tn", "fn")},
    }[how]
    shares = {}
    for cell, parts in bottoms.items():
        total = sum((_d(p) for p in parts), F.lit(0.0))
        shares[f"{cell}_share"] = ratio(_d(cell), total, 0.0)
    return counts.withColumns(shares)


# ---- from ordered points --------------------------------------------------

Side = tuple[Column, Column]


def _p() -> Column:
    return _d("p_total")


def _n() -> Column:
    return _d("n_total")


def _none_if_zero(value: Column) -> Column:
    """A divisor that makes the quotient NULL instead of failing."""
    return F.nullif(value, F.lit(0.0))


def _down() -> Side:
    """Positives and negatives at or above x."""
    return _d("tp"), _d("fp")


def _up() -> Side:
    """The same with the order reversed."""
    return _p() - _d("tp") + _d("pos"), _n() - _d("fp") + _d("neg")


def roc_auc() -> Column:
    """Rank-sum area: a tied pair counts one half."""
    return F.sum(_d("pos") * (_n() - _down()[1] + _d("neg") / 2)) / _none_if_zero(F.max(_p() * _n()))


def average_precision(side: Side | None = None) -> Column:
    """Step sum of precision over the recall gained at each distinct score."""
    hits, misses = side or _down()
    return F.sum(_d("pos") * hits / (hits + misses)) / _none_if_zero(F.max(_p()))


def brier(p: Column) -> Column:
    return F.sum(_d("pos") * (p - 1) * (p - 1) + _d("neg") * p * p) / F.max(_p() + _n())


def log_loss(p: Column) -> Column:
    def clip(v):
        return F.greatest(F.lit(EPSILON), F.least(F.lit(1.0 - EPSILON), v))

    return F.sum(-_d("pos") * F.ln(clip(p)) - _d("neg") * F.ln(clip(1 - p))) / F.max(_p() + _n())


def mean_losses(df: DataFrame, label: Column | str, features: Sequence[str], scaled: bool = False) -> DataFrame:
    """(feature, brier, log_loss): plain means over the rows, no order needed.

    ``scaled`` first brings each feature to 0..1 by its least and largest value.
    """
    rows = long_scores(df, label, features)
    x, y = F.col("x"), F.col("y").cast("double")
    if scaled:
        span = rows.groupBy("feature").agg(F.min("x").alias("low"), F.max("x").alias("high"))
        rows = rows.join(F.broadcast(span), "feature")  # one row per feature
        x = (x - F.col("low")) / _none_if_zero(F.col("high") - F.col("low"))

    def clip(v):
        return F.greatest(F.lit(EPSILON), F.least(F.lit(1.0 - EPSILON), v))

    return rows.groupBy("feature").agg(
        F.avg((x - y) * (x - y)).alias("brier"),
        F.avg(-y * F.ln(clip(x)) - (1 - y) * F.ln(clip(1 - x))).alias("log_loss"),
    )


def _both_classes() -> Column:
    return F.max((F.col("p_total") > 0) & (F.col("n_total") > 0))


def ranking_metrics(points: DataFrame) -> DataFrame:
    """(feature, roc_auc, pr_auc) of each feature as a score; NULL with one class."""
    return points.groupBy("feature").agg(
        F.when(_both_classes(), roc_auc()).alias("roc_auc"),
        F.when(_both_classes(), average_precision()).alias("pr_auc"),
    )


def summary_metrics(df: DataFrame, label: Column | str, scores: dict[str, str]) -> DataFrame:
    """(model, roc_auc, pr_auc, brier); ``scores`` maps column to model name."""
    points = ordered_points(tally(df, label, list(scores)))
    return summarize_points(points, scores)


def summarize_points(points: DataFrame, scores: dict[str, str]) -> DataFrame:
    rows = points.groupBy("feature").agg(
        F.when(_both_classes(), roc_auc()).alias("roc_auc"),
        F.when(_both_classes(), average_precision()).alias("pr_auc"),
        brier(F.col("x")).alias("brier"),
    )
    name = F.col("feature")
    for column, model in scores.items():
        name = F.when(F.col("feature") == column, F.lit(model)).otherwise(name)
    return rows.select(name.alias("model"), "roc_auc", "pr_auc", "brier")


def validation_metrics(points: DataFrame) -> DataFrame:
    """AUC and average precision of a fit, held to [0, 1]."""
    clip = {
        f"validation_{short}": F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col(c)))
        for short, c in (("auc", "roc_auc"), ("aucpr", "pr_auc"))
    }
    return ranking_metrics(points).withColumns(clip).select("feature", *clip)


# ---- curves and optimal cutoffs -------------------------------------------


def roc_curve(points: DataFrame, drop_collinear: bool = True) -> DataFrame:
    """(feature, threshold, fpr, tpr), with the start point at infinity.

    Points inside a straight line of equal steps, where the next lower score
    adds as many positives and negatives as the point itself did, are left out
    unless ``drop_collinear`` is false; the highest and the lowest score stay.
    """
    if drop_collinear:
        first = (F.col("tp") == F.col("pos")) & (F.col("fp") == F.col("neg"))
        turns = (F.col("pos") != F.col("next_pos")) | (F.col("neg") != F.col("next_neg"))
        points = points.where(first | F.col("next_pos").isNull() | turns)
    curve = points.select(
        "feature", F.col("x").alias("threshold"), ratio(_down()[1], _n(), None).alias("fpr"), ratio(_down()[0], _p(), None).alias("tpr")
    )
    start = points.select("feature").distinct().select(
        "feature", F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return curve.unionByName(start)


def pr_curve(points: DataFrame) -> DataFrame:
    """(feature, threshold, precision, recall), with the end point (1, 0)."""
    curve = points.select(
        "feature",
        F.col("x").alias("threshold"),
        ratio(_down()[0], _down()[0] + _down()[1], None).alias("precision"),
        ratio(_down()[0], _p(), None).alias("recall"),
    )
    end = points.select("feature").distinct().select(
        "feature",
        F.lit(None).cast("double").alias("threshold"),
        F.lit(1.0).alias("precision"),
        F.lit(0.0).alias("recall"),
    )
    return curve.unionByName(end)


def _cut(x: Column, side: Side) -> Column:
    return F.struct(x.alias("threshold"), side[0].alias("tp"), side[1].alias("fp"))


def _youden(x: Column, side: Side) -> Column:
    """Largest tpr - fpr, highest cutoff of ties; flagging nobody scores 0."""
    j = side[0] / _none_if_zero(_p()) - side[1] / _none_if_zero(_n())
    best = F.max_by(_cut(x, side), F.struct(j.alias("j"), x.alias("x")))
    nobody = F.struct(
        F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("tp"), F.lit(0.0).alias("fp")
    )
    return F.when(F.max(j) > 0, best).otherwise(nobody)


def _best_f1(x: Column, side: Side) -> Column:
    """Largest F1, lowest cutoff of ties."""
    precision, recall = side[0] / (side[0] + side[1]), side[0] / _none_if_zero(_p())
    f1 = F.when(precision + recall > 0, 2 * precision * recall / (precision + recall)).otherwise(0.0)
    return F.max_by(_cut(x, side), F.struct(f1.alias("f1"), (-x).alias("x")))


def _at(x: Column, value: Column) -> Column:
    return F.struct(
        F.max(value).alias("threshold"),
        F.sum(F.when(x >= value, _d("pos")).otherwise(0.0)).alias("tp"),
        F.sum(F.when(x >= value, _d("neg")).otherwise(0.0)).alias("fp"),
    )


def optimal_cutoffs(points: DataFrame) -> DataFrame:
    """(feature, youden, f1): the two optimal cutoffs of each score."""
    x = F.col("x")
    return (
        points.where((F.col("p_total") > 0) & (F.col("n_total") > 0))
        .groupBy("feature")
        .agg(_youden(x, _down()).alias("j"), _best_f1(x, _down()).alias("f"))
        .select("feature", F.col("j.threshold").alias("youden"), F.col("f.threshold").alias("f1"))
    )


def balanced_cutoffs(points: DataFrame, flipped: bool = False, quantiles: int | None = None) -> DataFrame:
    """Cutoff whose flagged share is nearest the share of positives.

    Candidates are all distinct scores, or, if ``quantiles`` is given, the
    values at that many equal steps; the lowest of ties wins. ``flipped`` ranks
    by -x.
    """
    n = F.col("p_total") + F.col("n_total")
    share = (_p() / n.cast("double")).alias("share")
    side = _up() if flipped else _down()
    sign = F.lit(-1.0 if flipped else 1.0)
    if quantiles is None:
        candidates = points.select(
            "feature", (F.col("x") * sign).alias("t"), ((side[0] + side[1]) / n).alias("flagged"), share
        )
    else:
        grid = quantile_grid(points, quantiles)
        shares = points.groupBy("feature").agg(F.max(_p() / n.cast("double")).alias("share"))
        # Turning the sign turns the order: x at or below the value is then flagged.
        flagged = (F.col("n") - F.col("above") if flipped else F.col("at_or_above")) / F.col("n")
        candidates = grid.join(F.broadcast(shares), "feature").select(
            "feature", (F.col("value") * sign).alias("t"), flagged.alias("flagged"), "share"
        )
    gap = F.abs(F.col("flagged") - F.col("share"))
    return (
        candidates.groupBy("feature")
        .agg(F.min_by("t", F.struct(gap.alias("gap"), F.col("t").alias("t"))).alias("balanced"))
    )


def pick_cutoffs(points: DataFrame, strategy: str = "youden", fixed: float = 0.5) -> DataFrame:
    """(feature, threshold) by strategy; a constant score gives its median."""
    both = (F.col("p_total") > 0) & (F.col("n_total") > 0)
    if strategy == "fixed":
        return points.groupBy("feature").agg(F.max(F.lit(float(fixed))).alias("threshold"))
    if strategy == "balanced":
        chosen = balanced_cutoffs(points.where(F.col("n_distinct") > 1)).withColumnRenamed("balanced", "threshold")
    else:
        chosen = optimal_cutoffs(points.where(F.col("n_distinct") > 1)).select(
            "feature", F.col({"youden": "youden", "f1": "f1"}[strategy]).alias("threshold")
        )
    constant = points.where((F.col("n_distinct") == 1) & both).select("feature", F.col("x").alias("threshold"))
    return chosen.unionByName(constant)


# ---- every column against one label ---------------------------------------


def metrics_vs_all(
    df: DataFrame,
    label: Column | str,
    features: Sequence[str],
    strategy: str = "youden",
    fixed: float = 0.5,
    min_distinct: int = 2,
    flip_below_half: bool = True,
) -> DataFrame:
    """One metrics row per column, each judged as a score of ``label``."""
    return tally_metrics(
        ordered_points(tally(df, label, features)), strategy, fixed, min_distinct, flip_below_half
    )


def tally_metrics(
    points: DataFrame,
    strategy: str = "youden",
    fixed: float = 0.5,
    min_distinct: int = 2,
    flip_below_half: bool = True,
) -> DataFrame:
    """The same from ordered points.

    A 0/1 column is its own prediction. Any other column is ranked, turned
    round when it ranks worse than chance, and cut by ``strategy``. Columns
    with one class, and constant columns that are not 0/1, give no row. Both
    directions are summed in one aggregate, so turning costs no second sort.
    """
    x = F.col("x")
    if strategy == "balanced":
        points = settle(points)  # read several times below
        down = balanced_cutoffs(points).withColumnRenamed("balanced", "t_down")
        up = balanced_cutoffs(points, flipped=True).withColumnRenamed("balanced", "t_up")
        points = points.join(F.broadcast(down.join(up, "feature")), "feature", "left")
        cut_down, cut_up = _at(x, F.col("t_down")), _at(-x, F.col("t_up"))
    elif strategy == "fixed":
        cut_down, cut_up = _at(x, F.lit(float(fixed))), _at(-x, F.lit(float(fixed)))
    else:
        rule = {"youden": _youden, "f1": _best_f1}[strategy]
        cut_down, cut_up = rule(x, _down()), rule(-x, _up())
    near_01 = (F.abs(x) <= 5e-7) | (F.abs(x - 1) <= 5e-7)
    whole = F.when(x > 0, F.floor(x)).otherwise(F.ceil(x))
    scaled = F.when(
        F.col("x_max") > F.col("x_min"), (x - F.col("x_min")) / (F.col("x_max") - F.col("x_min"))
    )
    sums = points.groupBy("feature").agg(
        F.max("p_total").alias("p"),
        F.max("n_total").alias("q"),
        F.max("n_distinct").alias("n_distinct"),
        ((F.max("n_distinct") <= 3) & F.bool_and(near_01)).alias("is_binary"),
        F.bool_and(x.isin(0.0, 1.0)).alias("exactly_01"),
        roc_auc().alias("auc"),
        average_precision(_down()).alias("ap_down"),
        average_precision(_up()).alias("ap_up"),
        cut_down.alias("down"),
        cut_up.alias("up"),
        F.sum(F.when(whole == 1, _d("pos")).otherwise(0.0)).alias("tp_binary"),
        F.sum(F.when(whole == 1, _d("neg")).otherwise(0.0)).alias("fp_binary"),
        brier(x).alias("brier_raw"),
        log_loss(x).alias("log_loss_raw"),
        brier(scaled).alias("brier_scaled"),
        log_loss(scaled).alias("log_loss_scaled"),
    )
    sums = sums.where((F.col("p") > 0) & (F.col("q") > 0)).where(
        F.col("is_binary") | (F.col("n_distinct") >= min_distinct)
    )
    binary, several = F.col("is_binary"), F.col("n_distinct") >= min_distinct
    turned = ~binary & (F.col("auc") < 0.5) if flip_below_half else F.lit(False)
    cut = F.when(turned, F.col("up")).otherwise(F.col("down"))
    ranked_ap = F.when(turned, F.col("ap_up")).otherwise(F.col("ap_down"))
    hits = F.when(binary, F.col("tp_binary")).otherwise(cut["tp"]).cast("bigint")
    false_hits = F.when(binary, F.col("fp_binary")).otherwise(cut["fp"]).cast("bigint")
    area = F.when(turned, 1.0 - F.col("auc")).otherwise(F.col("auc"))
    counts = sums.select(
        "feature",
        F.when(several | ~binary, area).alias("auc_roc"),
        F.when(several | ~binary, ranked_ap).alias("auc_pr"),
        F.when(several | ~binary, ranked_ap).alias("avg_precision"),
        F.when(binary, F.when(F.col("exactly_01"), F.col("log_loss_raw")))
        .otherwise(F.col("log_loss_scaled"))
        .alias("log_loss"),
        F.when(binary, F.when(F.col("exactly_01"), F.col("brier_raw")))
        .otherwise(F.col("brier_scaled"))
        .alias("brier"),
        hits.alias("tp"),
        (F.col("q") - false_hits).alias("tn"),
        false_hits.alias("fp"),
        (F.col("p") - hits).alias("fn"),
        F.when(~binary, cut["threshold"]).alias("threshold_used"),
    )
    full = rate_metrics(point_metrics(counts))
    return full.select(*METRIC_COLUMNS)


# The metric table's columns in order.
METRIC_COLUMNS = [
    "feature", "auc_roc", "auc_pr", "avg_precision", "f1", "precision", "recall",
    "specificity", "accuracy", "mcc", "log_loss", "brier", "tp", "tn", "fp", "fn",
    "threshold_used", "pred_pos_rate", "prevalence", "n",
]


def sort_metrics(table: DataFrame, by: str = "auc_roc", descending: bool = True) -> DataFrame:
    """Sorted by one metric, missing values last, ties by feature name."""
    key = F.desc_nulls_last(by) if descending else F.asc_nulls_last(by)
    return table.orderBy(key, "feature")
