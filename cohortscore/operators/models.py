"""Fitting, tuning and batch scoring of binary classifiers with Spark ML."""

from __future__ import annotations

import json
import random
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark.ml.classification import (
    LogisticRegression,
    LogisticRegressionModel,
    MultilayerPerceptronClassificationModel,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortscore.functions.numeric import finite_or_zero, quoted, to_double
from cohortscore.operators.boosting import BoostedModel, Settings, fit, fit_many
from cohortscore.operators.forest import TASK_ROWS, importances_in_tasks
from cohortscore.operators.linear import Logistic, fit_linear_together, left_out_scores
from cohortscore.operators.metrics import ranking_metrics
from cohortscore.operators.networks import Fit, classifier, fit_together, left_out_tally, pack
from cohortscore.operators.profile import class_balance, weight_bounds
from cohortscore.operators.scale import MeanFill, Scaler, fit_mean_fill, fit_scaler
from cohortscore.operators.split import order_hash, stratified_folds
from cohortscore.operators.tally import ordered_points, tally
from cohortscore.session import compiled, settle

FOREST = {"numTrees": 200, "maxDepth": 30, "featureSubsetStrategy": "sqrt", "minInstancesPerNode": 1}
# Search ranges (low, high, whole numbers only), or the values to choose from.
TREE_SPACE = {
    "eta": (0.01, 0.3, False), "rounds": (200, 1500, True), "max_depth": (3, 10, True),
    "min_child_weight": (1.0, 10.0, False), "gamma": (0.0, 5.0, False),
    "subsample": (0.5, 1.0, False), "colsample": (0.5, 1.0, False),
    "reg_lambda": (0.0, 10.0, False), "reg_alpha": (0.0, 10.0, False), "max_delta_step": (0.0, 10.0, False),
}
NETWORK_SPACE = {
    "hidden": (64, 1024, True), "depth": (1, 6, True), "blockSize": [64, 128, 256, 512],
    "stepSize": (0.00001, 0.003, False), "standardize": [0, 1],
}
#: Rows up to which networks and searches of linear models are Spark ML's own fits; more are packed and fitted side by side (``networks``, ``linear``).
FEW_ROWS = 50_000
#: Rounds without a larger area after which boosting ends.
PATIENCE = 50
#: Settings of a network's descent that packed fits have, too.
_PACKED_PARAMS = {"blockSize", "stepSize", "solver", "maxIter", "tol"}
#: Settings of a linear model that packed fits have, too.
_PACKED_LINEAR = {"regParam", "elasticNetParam", "fitIntercept", "maxIter", "tol"}
LINEAR_SPACE = {
    "regParam": (0.0001, 0.1, False), "elasticNetParam": (0.0, 1.0, False), "fitIntercept": (0, 1, True),
}


def feature_vector(
    df: DataFrame, features: Sequence[str], scaler: Scaler | None = None, fill: MeanFill | None = None
) -> Column:
    """Features in list order as one vector."""
    return array_to_vector(F.array(*feature_values(df, features, scaler, fill)))


def feature_values(
    df: DataFrame, features: Sequence[str], scaler: Scaler | None = None, fill: MeanFill | None = None
) -> list[Column]:
    """Features in list order as doubles.

    Absent and non-finite values are 0, missing ones the mean of ``fill``, or 0.
    """
    means = dict(zip(fill.columns, fill.means)) if fill else {}
    values = []
    for i, c in enumerate(features):
        if c not in df.columns:
            values.append(F.lit(0.0))
            continue
        x = to_double(df, c)
        if isinstance(df.schema[c].dataType, (T.IntegralType, T.BooleanType)):
            v = F.coalesce(x, F.lit(means.get(c, 0.0)))  # always finite
        else:
            v = F.when(x.isNull(), F.lit(means.get(c, 0.0))).otherwise(F.coalesce(finite_or_zero(x), F.lit(0.0)))
        if scaler is not None and scaler.kind != "none":
            v = (v - scaler.shift[i]) / (scaler.scale[i] or 1.0)
        values.append(v)
    return values


def training_frame(
    df: DataFrame, features: Sequence[str], label: str, keep: Sequence[str] = (), scaler: Scaler | None = None,
    fill: MeanFill | None = None,
) -> DataFrame:
    """(label, features, weight, kept columns); positives weigh neg / pos."""
    y = to_double(df, label)
    weight = _positive_weight(df, y)
    return df.where(y.isNotNull()).select(
        y.alias("label"),
        feature_vector(df, features, scaler, fill).alias("features"),
        F.when(y == 1, F.lit(weight)).otherwise(1.0).alias("weight"),
        *[quoted(c) for c in keep],
    )


def _positive_weight(df: DataFrame, y: Column) -> float:
    return float(class_balance(df, y).first()["scale_pos_weight"])


@dataclass
class Scorer:
    """A fitted classifier with the feature list it expects."""

    name: str
    features: list[str]
    model: object
    scaler: Scaler | None = None
    params: dict = field(default_factory=dict)
    fill: MeanFill | None = None

    def score(self, df: DataFrame, out: str = "predicted_proba") -> DataFrame:
        """Add the probability of the positive class; rows keep their columns."""
        if isinstance(self.model, BoostedModel):
            return self.model.score(df, out)
        ready = df.withColumn("__features", feature_vector(df, self.features, self.scaler, self.fill))
        scored = _positive(self.model, ready, "__features", "__positive")
        kept = [quoted(c) for c in df.columns if c != out]
        return scored.select(*kept, F.col("__positive").alias(out))


def _positive(model, df: DataFrame, features: str, out: str) -> DataFrame:
    """Add the probability of the positive class as ``out``, and no other column."""
    own = model.copy()
    own.setFeaturesCol(features).setPredictionCol("").setRawPredictionCol("").setProbabilityCol("__probability")
    return own.transform(df).withColumn(out, vector_to_array("__probability")[1]).drop("__probability")


def score_models(df: DataFrame, scorers: Mapping[str, Scorer | None], mode: str = "both") -> DataFrame:
    """Add ``<name>_prob`` per model; a model not run gives NULLs.

    ``mode`` is ``both`` or the name of the only model to run.
    """
    for name, scorer in scorers.items():
        column = f"{name}_prob"
        if scorer is None or mode not in ("both", name):
            df = df.withColumn(column, F.lit(None).cast("double"))
        else:
            df = scorer.score(df, column)
    return df


# ---- fits ------------------------------------------------------------------


def fit_boosted(
    df: DataFrame, features: Sequence[str], label: str, params: Mapping | None = None,
    validation: str | None = None, weighted: bool = True, seed: int = 42, name: str = "xgb", id_column: str | None = None,
) -> Scorer:
    """Boosted trees; positives weigh neg / pos of the rows they are fitted on.

    With a boolean ``validation`` column, rows marked true only decide where
    the trees end: after the prefix with the largest precision-recall area,
    once ``PATIENCE`` rounds (or those of ``params``) have not raised it.
    """
    params = {"patience": PATIENCE, **dict(params or {})}
    if weighted and "scale_pos_weight" not in params:
        rows = df.where(~F.coalesce(quoted(validation), F.lit(False))) if validation else df
        params["scale_pos_weight"] = float(class_balance(rows, to_double(rows, label)).first()["scale_pos_weight"])
    model = fit(df, features, label, id_column, Settings(**params), validation, seed)
    return Scorer(name, list(features), model, None, params)


def _packs(df: DataFrame, label: str, settings: Sequence[str], few_rows: int) -> bool:
    """Whether searched linear models of these settings are fitted packed: many rows, of classes 0 and 1."""
    if not set(settings) <= _PACKED_LINEAR:
        return False
    y = to_double(df, label)
    n, others = df.agg(F.count(y), F.count_if(~y.isin(0.0, 1.0))).first()
    return n > few_rows and not others


def fit_linear(
    df: DataFrame, features: Sequence[str], label: str, params: Mapping | None = None, name: str = "linear"
) -> Scorer:
    """Logistic regression. Features are read once; the fit's passes are over their vectors, stored without zeros."""
    params = dict(params or {})
    y = to_double(df, label)
    names = [f"x{i}" for i in range(len(features))]
    values = [v.alias(n) for v, n in zip(feature_values(df, features), names)]
    vectors = VectorAssembler(inputCols=names, outputCol="features", handleInvalid="keep")
    with compiled(df.sparkSession):
        weight = F.when(F.col("label") == 1, F.lit(_positive_weight(df, y))).otherwise(1.0).alias("weight")
        rows = df.where(y.isNotNull()).select(y.alias("label"), *values)
        train = settle(vectors.transform(rows).select("label", "features", weight))
        model = LogisticRegression(
            labelCol="label", featuresCol="features", weightCol="weight",
            **{"maxIter": 15, **params},
        ).fit(train)
    return Scorer(name, list(features), model, None, params)


def repeat_positives(df: DataFrame, label: str, id_column: str, weight: float, seed: int = 42) -> DataFrame:
    """Repeat each positive row ``weight`` times on average; no row is lost.

    Stands in for class weights where a learner has none. The fractional part
    is decided by the row's hash, so a rerun repeats the same rows.
    """
    whole = int(weight)
    digits = F.conv(F.substring(order_hash(quoted(id_column), seed), 1, 8), 16, 10).cast("double")
    extra = (digits / float(16**8) < weight - whole).cast("int")
    copies = F.when(quoted(label) == 1, F.lit(whole) + extra).otherwise(1)
    copies = F.greatest(copies, F.lit(1))
    repeated = df.withColumn("__copy", F.explode(F.sequence(F.lit(1), copies)))
    return repeated.drop("__copy")


def fit_network(
    df: DataFrame, features: Sequence[str], label: str, id_column: str, hidden: int = 128, depth: int = 2,
    scaler: str = "standard", balance: bool = True, params: Mapping | None = None, seed: int = 42, name: str = "nn",
    pos_weight: float | None = None, few_rows: int = FEW_ROWS,
) -> Scorer:
    """Multilayer perceptron on scaled features, classes balanced by repetition.

    Missing values take the mean of the training rows. Positives weigh neg /
    pos, or ``pos_weight``. More than ``few_rows`` rows, which are counted, are
    fitted packed.
    """
    described = {"hidden": hidden, "depth": depth, "scaler": scaler, **dict(params or {})}
    if scaler in ("standard", "none") and set(params or {}) <= _PACKED_PARAMS and df.count() > few_rows:
        weight = (pos_weight or class_balance(df, to_double(df, label)).first()["scale_pos_weight"]) if balance else 1.0
        one = Fit(hidden, depth, scaler, max(1.0, weight), **dict(params or {}))
        packed = pack(df, features, label, id_column, [one], seed=seed)
        fill, fitted = packed.scaling(one)
        model = classifier(df.sparkSession, one.layers(len(features)), seed, fit_together(packed, [one], seed)[0])
        return Scorer(name, list(features), model, fitted, described, fill)
    fill = fit_mean_fill(df, features)
    fitted = fit_scaler(fill.transform(df), features, scaler)
    if balance:
        weight = pos_weight or class_balance(df, to_double(df, label)).first()["scale_pos_weight"]
        df = repeat_positives(df, label, id_column, max(1.0, weight), seed)
    train = training_frame(df, features, label, scaler=fitted, fill=fill)
    layers = [len(features), *[hidden] * depth, 2]
    network = MultilayerPerceptronClassifier(
        labelCol="label", featuresCol="features", layers=layers, seed=seed, **dict(params or {})
    )
    return Scorer(name, list(features), network.fit(train), fitted, described, fill)


# ---- importances -----------------------------------------------------------


def boosted_importance(
    df: DataFrame, features: Sequence[str], label: str, params: Mapping | None = None, seed: int = 42
) -> DataFrame:
    """(feature, gain) of one boosted-tree fit: the mean gain of the feature's splits."""
    fitted = fit(df, features, label, None, Settings(**dict(params or {})), seed=seed)
    return df.sparkSession.createDataFrame(list(fitted.importances().items()), "feature string, gain double")


def boosted_importance_cv(
    df: DataFrame, features: Sequence[str], label: str, id_column: str, folds: int = 5,
    params: Mapping | None = None, seed: int = 42,
) -> DataFrame:
    """(feature, gain, fold) of one fit per stratified fold, on the other folds; all of them grow together."""
    folded = stratified_folds(df, id_column, label, folds, seed, "__fold")
    s = Settings(**dict(params or {}))
    fitted = fit_many(folded, features, label, id_column, [s] * folds, list(range(folds)), "__fold", seed)
    rows = [(f, gain, k) for k, model in enumerate(fitted) for f, gain in model.importances().items()]
    return df.sparkSession.createDataFrame(rows, "feature string, gain double, fold int")


def forest_importance(
    df: DataFrame, features: Sequence[str], label: str, params: Mapping | None = None, seed: int = 42, task_rows: int = TASK_ROWS,
) -> DataFrame:
    """(feature, gain) of a random forest, at most 30 deep.

    Up to ``task_rows`` rows, which are counted, each tree grows in a task of
    its own; of more, and with other settings than the number of trees and
    their depth, the forest is Spark ML's.
    """
    settings = {**FOREST, **dict(params or {})}
    plain = set(params or {}) <= {"numTrees", "maxDepth"}
    if plain and df.where(to_double(df, label).isNotNull()).limit(task_rows + 1).count() <= task_rows:
        gains = importances_in_tasks(df, features, label, settings["numTrees"], settings["maxDepth"], seed)
        return df.sparkSession.createDataFrame(list(zip(features, gains)), "feature string, gain double")
    train = training_frame(df, features, label)
    forest = RandomForestClassifier(
        labelCol="label", featuresCol="features", seed=seed, **settings
    ).fit(train)
    rows = list(zip(features, map(float, forest.featureImportances.toArray())))
    return df.sparkSession.createDataFrame(rows, "feature string, gain double")


# ---- tuning ----------------------------------------------------------------


def random_settings(space: Mapping[str, tuple], jobs: int, seed: int = 42) -> list[dict]:
    """``jobs`` seeded draws from the ranges."""
    draw = random.Random(seed)
    settings = []
    for _ in range(jobs):
        one = {}
        for key, span in space.items():
            if isinstance(span, list):
                one[key] = draw.choice(span)
                continue
            low, high, whole = span
            one[key] = draw.randint(low, high) if whole else round(draw.uniform(low, high), 6)
        settings.append(one)
    return settings


def _param_maps(estimator, settings: Sequence[Mapping]) -> list[dict]:
    maps = []
    for one in settings:
        converted = {}
        for key, value in one.items():
            if key == "fitIntercept":
                value = bool(value)
            converted[estimator.getParam(key)] = value
        maps.append(converted)
    return maps


def _jobs(settings: Sequence[Mapping], areas: Sequence[Sequence[float | None]]) -> list[dict]:
    """Each job's objective is the mean of its areas; a fold with one class counts for none."""
    results = []
    for i, (one, own) in enumerate(zip(settings, areas)):
        known = [a for a in own if a is not None]
        objective = sum(known) / len(known) if known else None
        results.append({"job_name": f"job-{i:03d}", "objective": objective, "params": {k: str(v) for k, v in one.items()}})
    return results


def _held_areas(scored: DataFrame, names: Sequence[str]) -> dict[str, float | None]:
    found = ranking_metrics(ordered_points(tally(scored, "label", names))).collect()  # a row per setting
    return {row["feature"]: row["pr_auc"] for row in found}


def _cross_validate(
    estimator, folded: DataFrame, features: Sequence[str], label: str, settings: Sequence[Mapping], maps, parallelism: int
) -> list[dict]:
    """Fold-averaged precision-recall area of each setting, exact from a tally.

    Vectors are stored once for all folds; the class balance is that of each
    fold's training rows. All settings of a fold are judged in one pass;
    nothing is fitted but what is judged.
    """
    areas: list[list[float | None]] = [[] for _ in settings]
    names = [f"p{i}" for i in range(len(settings))]
    y = to_double(folded, label)
    with compiled(folded.sparkSession):
        stored = settle(folded.where(y.isNotNull()).select(y.alias("label"), feature_vector(folded, features).alias("features"), "fold"))
    for k in range(stored.select(F.max("fold")).first()[0] + 1):
        train, scored = stored.where(F.col("fold") != k), stored.where(F.col("fold") == k)
        weight = float(class_balance(train, F.col("label")).first()["scale_pos_weight"])
        frame = train.withColumn("weight", F.when(F.col("label") == 1, F.lit(weight)).otherwise(1.0))
        with ThreadPool(parallelism) as pool:
            models = pool.map(lambda chosen: estimator.fit(frame, chosen), maps)  # noqa: B023
        for name, model in zip(names, models):
            scored = _positive(model, scored, "features", name)
        found = _held_areas(scored, names)
        for name, own in zip(names, areas):
            own.append(found.get(name))
    return _jobs(settings, areas)


def results_frame(spark, results: Sequence[Mapping]) -> DataFrame:
    rows = [(r["job_name"], r["objective"], r["params"]) for r in results]
    return spark.createDataFrame(rows, "job_name string, objective double, params map<string,string>")


def tune_boosted(
    df: DataFrame, features: Sequence[str], label: str, id_column: str, space: Mapping = TREE_SPACE,
    jobs: int = 20, folds: int = 5, seed: int = 42, patience: int = PATIENCE,
) -> DataFrame:
    """(job_name, objective, params): fold-averaged best precision-recall area of each drawn setting.

    Every setting grows on every fold's other rows until its area on the fold
    has not risen for ``patience`` rounds; ``jobs`` x ``folds`` models grow
    side by side. Positives weigh neg / pos of all labelled rows.
    """
    with compiled(df.sparkSession):
        folded = settle(stratified_folds(df, id_column, label, folds, seed, "__fold"))
    weight = float(class_balance(folded, to_double(folded, label)).first()["scale_pos_weight"])
    settings = random_settings(space, jobs, seed)
    each = [Settings(**one, scale_pos_weight=weight, patience=patience) for one in settings for _ in range(folds)]
    fitted = fit_many(folded, features, label, id_column, each, list(range(folds)) * jobs, "__fold", seed)
    best = [max((a for a in model.areas if a is not None), default=None) for model in fitted]
    return results_frame(df.sparkSession, _jobs(settings, [best[i * folds : (i + 1) * folds] for i in range(jobs)]))


def tune_linear(
    df: DataFrame, features: Sequence[str], label: str, id_column: str, space: Mapping = LINEAR_SPACE,
    jobs: int = 20, folds: int = 5, parallelism: int = 4, seed: int = 42, few_rows: int = FEW_ROWS,
) -> DataFrame:
    """(job_name, objective, params) of linear models; of more than ``few_rows`` rows all are fitted side by side."""
    with compiled(df.sparkSession):
        folded = settle(stratified_folds(df, id_column, label, folds, seed))
    settings = random_settings(space, jobs, seed)
    if _packs(folded, label, list(space), few_rows):
        areas = _linear_areas(folded, features, label, settings, folds)
        if areas:
            return results_frame(df.sparkSession, _jobs(settings, areas))
    linear = LogisticRegression(labelCol="label", featuresCol="features", weightCol="weight", maxIter=15)
    return results_frame(
        df.sparkSession, _cross_validate(linear, folded, features, label, settings, _param_maps(linear, settings), parallelism)
    )


def _linear_areas(folded: DataFrame, features: Sequence[str], label: str, settings: Sequence[Mapping], folds: int) -> list[list[float | None]] | None:
    """Areas of each setting on each fold; None if a fold's training rows have one class only."""
    fits = [Logistic(**{**one, "fitIntercept": bool(one.get("fitIntercept", True))}, leaves_out=k) for one in settings for k in range(folds)]
    packed = pack(folded.withColumns({c: F.lit(0.0) for c in features if c not in folded.columns}), features, label, None, [], "fold")
    fitted = fit_linear_together(packed, fits)
    if fitted is None:
        return None
    found = ranking_metrics(ordered_points(left_out_scores(packed, fits, fitted))).collect()  # a row per fit
    areas = {row["feature"]: row["pr_auc"] for row in found}
    return [[areas.get(i * folds + k) for k in range(folds)] for i in range(len(settings))]


def network_space(df: DataFrame, label: str, space: Mapping = NETWORK_SPACE) -> dict:
    """``space`` with the range of the positive weight that the classes suggest."""
    bounds = weight_bounds(class_balance(df, to_double(df, label))).first()
    return {**space, "pos_weight": (float(bounds["low"]), float(bounds["high"]), False)}


def tune_network(
    df: DataFrame, features: Sequence[str], label: str, id_column: str, space: Mapping | None = None,
    jobs: int = 20, folds: int = 5, parallelism: int = 4, seed: int = 42, max_iter: int = 100, few_rows: int = FEW_ROWS,
) -> DataFrame:
    """(job_name, objective, params) of networks; unless given, the space is that of ``network_space``.

    Means and scaling are learned on each fold's training rows, and a setting's
    positive weight repeats those rows. Of more than ``few_rows`` rows, all
    settings are fitted on all folds side by side.
    """
    with compiled(df.sparkSession):
        folded = settle(stratified_folds(df, id_column, label, folds, seed))
    settings = random_settings(network_space(df, label) if space is None else space, jobs, seed)
    if folded.count() > few_rows:
        return results_frame(df.sparkSession, _jobs(settings, _network_areas(folded, features, label, id_column, settings, folds, seed, max_iter)))
    areas: list[list[float | None]] = [[] for _ in settings]
    for k in range(folds):
        train, held = folded.where(F.col("fold") != k), folded.where(F.col("fold") == k)

        def one(setting: Mapping) -> Scorer:
            return fit_network(
                train, features, label, id_column, int(setting["hidden"]), int(setting["depth"]),  # noqa: B023
                "standard" if setting.get("standardize", 1) else "none", pos_weight=setting.get("pos_weight"), seed=seed,
                params={"blockSize": int(setting["blockSize"]), "stepSize": float(setting["stepSize"]), "solver": "gd", "maxIter": max_iter},
            )

        with ThreadPool(parallelism) as pool:
            scorers = pool.map(one, settings)
        scored = held.withColumn("label", to_double(held, label))
        for i, scorer in enumerate(scorers):
            scored = scorer.score(scored, f"p{i}")
        found = _held_areas(scored, [f"p{i}" for i in range(jobs)])
        for i, own in enumerate(areas):
            own.append(found.get(f"p{i}"))
    return results_frame(df.sparkSession, _jobs(settings, areas))


def _network_areas(
    folded: DataFrame, features: Sequence[str], label: str, id_column: str, settings: Sequence[Mapping], folds: int, seed: int, max_iter: int
) -> list[list[float | None]]:
    """Areas of each setting on each fold; as many networks as both side by side."""
    y = to_double(folded, label)
    balances = {r["fold"]: r for r in folded.groupBy("fold").agg(F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg")).collect()}  # a row per fold
    known = [k for k in balances if k is not None]
    fits = []
    for setting in settings:
        for k in range(folds):
            pos, neg = (sum(balances[f][c] for f in known if f != k) for c in ("pos", "neg"))
            weight = setting.get("pos_weight") or (neg / pos if pos else 1.0)
            fits.append(Fit(
                int(setting["hidden"]), int(setting["depth"]), "standard" if setting.get("standardize", 1) else "none", max(1.0, weight), k,
                int(setting["blockSize"]), float(setting["stepSize"]), "gd", max_iter,
            ))
    packed = pack(folded, features, label, id_column, fits, "fold", seed)
    found = ranking_metrics(ordered_points(left_out_tally(packed, fits, fit_together(packed, fits, seed)))).collect()  # a row per network
    areas = {row["feature"]: row["pr_auc"] for row in found}
    return [[areas.get(f"p{i * folds + k}") for k in range(folds)] for i in range(len(settings))]


def best_settings(results: DataFrame) -> dict:
    """Parameters of the job with the highest objective, as numbers again."""
    best = results.orderBy(F.desc_nulls_last("objective"), "job_name").first()
    out = {}
    for key, text in best["params"].items():
        number = float(text)
        out[key] = int(number) if "." not in text and "e" not in text else number
        if key == "fitIntercept":
            out[key] = bool(number)
    return out


def describe_fit(scorer: Scorer, metrics: Mapping[str, float], weights: Mapping | None = None) -> str:
    """The training artifacts of a fit as JSON text."""
    # The names of the artifacts' fields.
    scaling = {"type": "none"} if scorer.scaler is None else json.loads(scorer.scaler.to_json())
    return json.dumps(
        {
            "validation_auc": metrics.get("validation_auc"),
            "validation_aucpr": metrics.get("validation_aucpr"),
            "feature_names": scorer.features,
            "normalization": scaling,
            "imputation": {"columns": scorer.fill.columns, "means": scorer.fill.means} if scorer.fill else None,
            "class_weight": {str(k): float(v) for k, v in (weights or {}).items()},
            "hyperparams": {k: str(v) for k, v in scorer.params.items()},
        }
    )


#: Kinds of stored models, by the class that reads each.
_READERS = {"linear": LogisticRegressionModel, "network": MultilayerPerceptronClassificationModel}


def save_scorer(spark, scorer: Scorer, folder: str) -> str:
    """All that a scorer needs, under ``folder``: its description as JSON lines, and the model beside it."""
    kind = "boosted" if isinstance(scorer.model, BoostedModel) else next(k for k, c in _READERS.items() if isinstance(scorer.model, c))
    described = {
        "kind": kind, "name": scorer.name, "features": scorer.features, "params": scorer.params,
        "scaler": scorer.scaler.to_json() if scorer.scaler else None, "fill": asdict(scorer.fill) if scorer.fill else None,
        "boosted": scorer.model.to_json() if kind == "boosted" else None,
    }
    if kind != "boosted":
        scorer.model.write().overwrite().save(f"{folder}/model")
    spark.createDataFrame([(json.dumps(described),)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/scorer")
    return folder


def load_scorer(spark, folder: str) -> Scorer:
    """The scorer that ``save_scorer`` wrote, in any session that reaches the folder."""
    read = json.loads(spark.read.text(f"{folder}/scorer").first()["value"])
    model = BoostedModel.from_json(read["boosted"]) if read["kind"] == "boosted" else _READERS[read["kind"]].load(f"{folder}/model")
    return Scorer(
        read["name"], read["features"], model, Scaler.from_json(read["scaler"]) if read["scaler"] else None,
        read["params"], MeanFill(**read["fill"]) if read["fill"] else None,
    )
