"""Training, scoring and the whole experiment, composed of the operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortscore.functions.numeric import quoted
from cohortscore.operators.columns import apply_selected_features, select_ranked
from cohortscore.operators.models import (
    Scorer, best_settings, boosted_importance, boosted_importance_cv, fit_boosted, fit_network,
    forest_importance, score_models, tune_boosted, tune_network,
)
from cohortscore.operators.profile import correlations
from cohortscore.operators.select import (
    average_importances, backward_elimination, keep_share, moments, pca_scores, rank_features, select_features,
)
from cohortscore.operators.split import split_by_share, stratified_split
from cohortscore.plans.evaluation import Evaluation, Export, evaluate, export
from cohortscore.session import compiled, settle
from cohortscore.sources.tables import with_predictions

# Features the correlation study drops by hand.
NAMED_DROPS = [
    "diag_1_blooddis", "admission_source_id_6", "diag_1_metabolic",
    "admission_type_id_5", "diag_2_musculoskeletal",
]


@dataclass
class Prepared:
    train: DataFrame
    test: DataFrame
    features: list[str]
    ranking: DataFrame


def prepare_selected(
    table: DataFrame, label: str, id_column: str, k: int = 150, cumulative: float = 0.0, mode: str = "cv",
    params: Mapping | None = None, seed: int = 42,
) -> Prepared:
    """Split, rank on the training rows only, apply the list to both parts."""
    with compiled(table.sparkSession):
        tagged = settle(stratified_split(table, id_column, label, seed=seed))
    train, test = (tagged.where(F.col("split") == t).drop("split") for t in ("train", "test"))
    names = [c for c in table.columns if c not in (label, id_column)]
    if mode == "quick":
        gains = boosted_importance(train, names, label, params, seed).withColumnRenamed("gain", "gain_cv")
    else:
        gains = average_importances(boosted_importance_cv(train, names, label, id_column, params=params, seed=seed))
    ranking = rank_features(gains)
    chosen = select_features(ranking, k, cumulative).orderBy("position").collect()  # one row per column
    features = [r["selected_features"] for r in chosen]

    def aligned(part):
        return apply_selected_features(part, [id_column, *features], label)

    return Prepared(aligned(train), aligned(test), features, ranking)


@dataclass
class Tuned:
    scorer: Scorer
    results: DataFrame


def tune_and_fit_boosted(train, features, label, id_column, **search) -> Tuned:
    results = settle(tune_boosted(train, features, label, id_column, **search))
    # Rows of the training part decide where the final trees end.
    stopping = stratified_split(train, id_column, label, seed=43, out="__part").withColumn("__held", F.col("__part") == "test")
    scorer = fit_boosted(stopping, features, label, best_settings(results), validation="__held", id_column=id_column)
    return Tuned(scorer, results)


def tune_and_fit_network(train, features, label, id_column, **search) -> Tuned:
    max_iter = search.get("max_iter", 100)
    results = settle(tune_network(train, features, label, id_column, **search))
    best = best_settings(results)
    scorer = fit_network(
        train, features, label, id_column, best["hidden"], best["depth"],
        "standard" if best.get("standardize", 1) else "none", pos_weight=best.get("pos_weight"),
        params={"blockSize": best["blockSize"], "stepSize": best["stepSize"], "solver": "gd", "maxIter": max_iter},
    )
    return Tuned(scorer, results)


def full_train(
    train: DataFrame, features: Sequence[str], label: str, id_column: str,
    models: Sequence[str] = ("xgb", "nn"), searches: Mapping[str, Mapping] | None = None,
) -> dict[str, Scorer | None]:
    """Tune and fit the models named; one not named stays None."""
    searches = searches or {}
    steps = {"xgb": tune_and_fit_boosted, "nn": tune_and_fit_network}
    return {
        m: step(train, features, label, id_column, **dict(searches.get(m, {}))).scorer if m in models else None
        for m, step in steps.items()
    }


def score_holdout(test: DataFrame, scorers: Mapping[str, Scorer | None], mode: str = "both") -> DataFrame:
    return with_predictions(score_models(test, scorers, mode))


@dataclass
class Experiment:
    prepared: Prepared
    scorers: dict[str, Scorer | None]
    scored: DataFrame
    evaluation: Evaluation | None
    export: Export | None


def full_experiment(
    table: DataFrame, label: str, id_column: str, k: int = 150, ranking: Mapping | None = None,
    searches: Mapping[str, Mapping] | None = None, eval_mode: str = "both",
) -> Experiment:
    """Prepare, tune, fit, score the holdout and evaluate it.

    ``eval_mode`` is ``built_in``, ``export`` or ``both``.
    """
    prepared = prepare_selected(table, label, id_column, k, params=ranking)
    scorers = full_train(prepared.train, prepared.features, label, id_column, searches=searches)
    scored = settle(score_holdout(prepared.test, scorers))
    built_in = evaluate(scored, label) if eval_mode in ("built_in", "both") else None
    exported = export(scored, label) if eval_mode in ("export", "both") else None
    return Experiment(prepared, scorers, scored, built_in, exported)


@dataclass
class Study:
    features: list[str]
    tagged: DataFrame
    by_correlation: DataFrame
    by_forest: DataFrame
    steps: list[dict]
    bic_steps: list[dict]
    pca: list[tuple[str, float]]


def selection_study(
    table: DataFrame, label: str, id_column: str, forest: Mapping | None = None,
    drops: Sequence[str] = NAMED_DROPS, seed: int = 42,
) -> Study:
    """Correlation, forest, stepwise (by both criteria) and component checks, then an 85/15 split."""
    names = [c for c in table.columns if c not in (label, id_column)]
    corr = settle(correlations(table, quoted(label), names))
    kept = keep_share(corr, "correlation", int(0.80 * (len(names) + 1))).orderBy("position")
    first = [r["feature"] for r in kept.collect()]  # one row per column
    gains = settle(forest_importance(table, first, label, forest, seed))
    kept = keep_share(gains, "gain", int(0.85 * len(first))).orderBy("position")
    second = [r["feature"] for r in kept.collect()]
    cross = moments(table, second, label)
    steps, bic_steps = (backward_elimination(cross, criterion) for criterion in ("aic", "bic"))
    third = [c for c in second if c not in set(drops)]
    components = pca_scores(table, third)
    reduced = select_ranked(table, [id_column, label, *third])
    return Study(third, split_by_share(reduced, id_column, 0.85, seed), corr, gains, steps, bic_steps, components)


def smoke_scores(scorer: Scorer, rows: DataFrame) -> DataFrame:
    """Score all-zero rows of the serving schema, one per row of ``rows``."""
    zeros = rows.select(F.monotonically_increasing_id().alias("row"), *[F.lit(0.0).alias(c) for c in scorer.features])
    return scorer.score(zeros).select("row", "predicted_proba")
