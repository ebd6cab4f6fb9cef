"""Queries that fit, tune and apply models.

Every query takes all columns of the model table and the operators' default
settings, but for the size of searched networks and the number of some jobs.
Learners have no counterpart in SQL, so checks hold what does not depend on
them: which rows are scored and that scores are probabilities, counts per
split, closed forms. Rankings and searches have none; tests compare the
learner with a plain search.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortscore.catalog.inputs import encounters, with_encounters
from cohortscore.catalog.preparing import CLEAN, STRATIFIED
from cohortscore.catalog.registry import query, rounded
from cohortscore.operators.metrics import validation_metrics
from cohortscore.operators.models import (
    best_settings, boosted_importance, boosted_importance_cv, describe_fit, fit_boosted, fit_linear, fit_network,
    forest_importance, load_scorer, network_space, repeat_positives, save_scorer, score_models, tune_boosted, tune_linear,
    tune_network,
)
from cohortscore.operators.profile import best_jobs, class_balance, class_weights
from cohortscore.operators.scale import fit_mean_fill
from cohortscore.operators.select import (
    average_importances, backward_elimination, keep_share, moments, pca_scores, rank_features,
)
from cohortscore.operators.split import stratified_split
from cohortscore.operators.tally import ordered_points, tally
from cohortscore.plans.engineering import clean_encounters, engineer, fit_encoder
from cohortscore.plans.experiment import (
    full_experiment, full_train, prepare_selected, score_holdout, selection_study, smoke_scores,
)
from cohortscore.session import compiled, run_folder, settle
from cohortscore.sources.reports import write_artifacts
from cohortscore.sources.tables import COUNT_COLUMNS, compact_predictions
from cohortscore.streaming.score import arriving, score_stream, write_scores

ID, LABEL = "encounter_id", "readmitted"
#: Networks are fitted by full-batch descent here, so those of the searches are small; all else has its default settings.
SMALL_NETWORKS = {"hidden": (8, 16, True), "depth": (1, 2, True), "blockSize": [128, 256], "stepSize": (0.00001, 0.003, False), "standardize": [0, 1]}
NETWORK_SEARCH = {"jobs": 3, "folds": 3, "max_iter": 20}


# The encounters under the names that the SQL of the stratified split uses.
HOLDOUT = CLEAN + ", scored AS (SELECT encounter_id AS id, readmitted FROM cleaned)" + STRATIFIED + """
, tagged AS (SELECT id AS encounter_id, readmitted, CASE WHEN r <= q THEN 'test' ELSE 'train' END AS split
  FROM ranked JOIN full_quota ON g = readmitted)
"""
HELD_SCORES = HOLDOUT + "SELECT encounter_id, readmitted, true AS is_probability FROM tagged WHERE split = 'test'"


def judged(df, *scores):
    """Id, label, and whether all scores are probabilities."""
    good = F.lit(True)
    for c in scores:
        good = good & F.coalesce(F.col(c).between(0.0, 1.0), F.lit(False))
    return df.select(ID, LABEL, good.alias("is_probability"))


def engineered(spark, d):
    return engineer(encounters(spark, d), [ID])[0]


def frame(spark, d):
    """The whole model table and its features."""
    table = engineered(spark, d)
    return table, [c for c in table.columns if c not in (ID, LABEL)]


def holdout(spark, d):
    table, features = frame(spark, d)
    with compiled(spark):
        tagged = settle(stratified_split(table, ID, LABEL))
    return tagged.where("split = 'train'").drop("split"), tagged.where("split = 'test'").drop("split"), features


def with_stopping(train):
    """The training part with a mark on rows that decide where trees end."""
    return stratified_split(train, ID, LABEL, seed=43).withColumn("held", F.col("split") == "test").drop("split")


def settings_of(results):
    """A row per job and setting."""
    return results.select("job_name", F.round("objective", 6).alias("objective"), F.explode("params").alias("setting", "value"))


@query("M1_gain_importance")
def _(spark, d):
    table, features = frame(spark, d)
    return rounded(rank_features(boosted_importance(table, features, LABEL).withColumnRenamed("gain", "gain_cv")))


@query("M2_gain_importance_cv")
def _(spark, d):
    table, features = frame(spark, d)
    return rounded(rank_features(average_importances(boosted_importance_cv(table, features, LABEL, ID))))


@query("M4_forest_importance")
def _(spark, d):
    table, features = frame(spark, d)
    return rounded(forest_importance(table, features, LABEL))


@query("T5_keep_by_forest")
def _(spark, d):
    table, features = frame(spark, d)
    return rounded(keep_share(forest_importance(table, features, LABEL), "gain", int(0.85 * len(features))))


def eliminated(spark, d, criterion):
    table, features = frame(spark, d)
    steps = backward_elimination(moments(table, features, LABEL), criterion)
    return spark.createDataFrame([tuple(s.values()) for s in steps], "round int, removed string, criterion double, kept int")


@query("M5_aic_elimination")
def _(spark, d):
    return eliminated(spark, d, "aic")


@query("M6_bic_elimination")
def _(spark, d):
    return eliminated(spark, d, "bic")


@query("M7_pca_scores")
def _(spark, d):
    return spark.createDataFrame(pca_scores(*frame(spark, d)), "feature string, importance_value double")


@query("M7_pca_scores_scaled")
def _(spark, d):
    return spark.createDataFrame(pca_scores(*frame(spark, d), scaled=True), "feature string, importance_value double")


@query("M8_weighted_trees", with_encounters(HELD_SCORES))
def _(spark, d):
    train, test, features = holdout(spark, d)
    scorer = fit_boosted(with_stopping(train), features, LABEL, validation="held", id_column=ID)
    return judged(scorer.score(test, "xgb_prob"), "xgb_prob")


@query("M8_prefix_areas")
def _(spark, d):
    train, _, features = holdout(spark, d)
    model = fit_boosted(with_stopping(train), features, LABEL, validation="held", id_column=ID).model
    rows = [(n, area, n <= len(model.trees)) for n, area in enumerate(model.areas, 1)]
    return spark.createDataFrame(rows, "trees int, pr_auc double, kept boolean")


@query("M9_tune_trees")
def _(spark, d):
    table, features = frame(spark, d)
    return settings_of(tune_boosted(table, features, LABEL, ID))


@query("M10_network", with_encounters(HELD_SCORES))
def _(spark, d):
    train, test, features = holdout(spark, d)
    return judged(fit_network(train, features, LABEL, ID).score(test, "nn_prob"), "nn_prob")


@query("M10_repeat_positives", with_encounters(CLEAN + """
, w AS (SELECT sum(1 - readmitted) / greatest(sum(readmitted), 1)::DOUBLE AS w FROM cleaned)
, c AS (SELECT readmitted, CASE WHEN readmitted = 1 THEN greatest(1, floor(w)::BIGINT + CASE WHEN
    CAST('0x' || substr(md5('42:' || encounter_id), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE < w - floor(w) THEN 1 ELSE 0 END) ELSE 1 END AS n
  FROM cleaned, w)
, s AS (SELECT sum(CASE WHEN readmitted = 1 THEN n ELSE 0 END)::BIGINT AS pos, sum(CASE WHEN readmitted = 0 THEN n ELSE 0 END)::BIGINT AS neg FROM c)
SELECT pos, neg, round(neg / greatest(pos, 1)::DOUBLE, 6) AS scale_pos_weight FROM s"""))
def _(spark, d):
    rows, _ = frame(spark, d)
    weight = class_balance(rows, F.col(LABEL)).first()["scale_pos_weight"]
    return rounded(class_balance(repeat_positives(rows, LABEL, ID, weight), F.col(LABEL)))


@query("M11_tune_network")
def _(spark, d):
    table, features = frame(spark, d)
    space = network_space(table, LABEL, SMALL_NETWORKS)
    return settings_of(tune_network(table, features, LABEL, ID, space, **NETWORK_SEARCH))


@query("M12_tune_linear")
def _(spark, d):
    table, features = frame(spark, d)
    return settings_of(tune_linear(table, features, LABEL, ID, jobs=8))


@query("M13_refit_best", with_encounters(HELD_SCORES))
def _(spark, d):
    train, test, features = holdout(spark, d)
    best = best_jobs(tune_boosted(train, features, LABEL, ID, jobs=8))
    scorer = fit_boosted(train, features, LABEL, best_settings(best), id_column=ID)
    return judged(scorer.score(test, "xgb_prob"), "xgb_prob")


@query("M14_batch_score", with_encounters(HELD_SCORES))
def _(spark, d):
    train, test, features = holdout(spark, d)
    scorer = fit_boosted(train, features, LABEL, id_column=ID)
    again = load_scorer(spark, save_scorer(spark, scorer, run_folder(spark, "scorer")))
    return judged(again.score(test.drop("change")), "predicted_proba")


@query("M15_run_modes", with_encounters(HOLDOUT + """
SELECT mode, encounter_id, mode <> 'nn' AS xgb, mode <> 'xgb' AS nn FROM tagged, (VALUES ('both'), ('xgb'), ('nn')) m(mode) WHERE split = 'test'"""))
def _(spark, d):
    train, test, features = holdout(spark, d)
    scorers = {"xgb": fit_boosted(train, features, LABEL, id_column=ID), "nn": fit_network(train, features, LABEL, ID)}

    def run(mode):
        given = [F.coalesce(F.col(f"{m}_prob").between(0.0, 1.0), F.lit(False)).alias(m) for m in scorers]
        return score_models(test, scorers, mode).select(F.lit(mode).alias("mode"), ID, *given)

    return run("both").unionByName(run("xgb")).unionByName(run("nn"))


@query("S18_artifacts", with_encounters(HOLDOUT + """
, train AS (SELECT c.* FROM tagged t JOIN cleaned c ON c.encounter_id = t.encounter_id WHERE t.split = 'train')
, w AS (SELECT '0' AS label, count(*) / (2.0::DOUBLE * sum(1 - readmitted)) AS weight FROM train
  UNION ALL SELECT '1', count(*) / (2.0::DOUBLE * sum(readmitted)) FROM train)
SELECT 'class_weight' AS field, label AS name, round(weight, 6) AS value FROM w
""" + "".join(f"UNION ALL SELECT 'mean', '{c}', round(avg({c}), 6) FROM train " for c in COUNT_COLUMNS)))
def _(spark, d):
    train, test, features = holdout(spark, d)
    scorer = fit_linear(train, features, LABEL)
    scorer.fill = fit_mean_fill(train, features)
    with compiled(spark):
        metrics = validation_metrics(ordered_points(tally(scorer.score(test, "p"), LABEL, ["p"]))).first().asDict()
    weights = {int(r["label"]): r["weight"] for r in class_weights(train, F.col(LABEL)).collect()}  # two classes
    path = write_artifacts(spark, describe_fit(scorer, metrics, weights), scorer.model, run_folder(spark, "artifacts"))
    shape = "struct<class_weight: map<string, double>, imputation: struct<columns: array<string>, means: array<double>>>"
    read = spark.read.text(f"{path}").select(F.from_json("value", shape).alias("j"))
    means = read.select(F.explode(F.arrays_zip("j.imputation.columns", "j.imputation.means")).alias("m")).select(
        F.lit("mean").alias("field"), F.col("m.columns").alias("name"), F.round("m.means", 6).alias("value")
    )
    classes = read.select(F.explode("j.class_weight").alias("name", "weight")).select(
        F.lit("class_weight").alias("field"), "name", F.round("weight", 6).alias("value")
    )
    return classes.unionByName(means.where(F.col("name").isin(COUNT_COLUMNS)))


@query("L2_prepare_selected")
def _(spark, d):
    prepared = prepare_selected(frame(spark, d)[0], LABEL, ID, k=40)
    return rounded(prepared.ranking).withColumn("chosen", F.col("feature").isin(prepared.features))


@query("L3_full_train", with_encounters(HELD_SCORES))
def _(spark, d):
    train, test, features = holdout(spark, d)
    searches = {"xgb": {"jobs": 8}, "nn": {"space": network_space(train, LABEL, SMALL_NETWORKS), **NETWORK_SEARCH}}
    scorers = full_train(train, features, LABEL, ID, searches=searches)
    return judged(score_models(test, scorers), "xgb_prob", "nn_prob")


@query("L3_network_only", with_encounters(HELD_SCORES))
def _(spark, d):
    train, test, features = holdout(spark, d)
    searches = {"nn": {"space": network_space(train, LABEL, SMALL_NETWORKS), **NETWORK_SEARCH}}
    scorers = full_train(train, features, LABEL, ID, models=["nn"], searches=searches)
    alone = score_models(test, scorers).where("xgb_prob IS NULL")
    return judged(alone, "nn_prob")


@query("L4_score_holdout")
def _(spark, d):
    train, test, features = holdout(spark, d)
    scorers = {"xgb": fit_boosted(train, features, LABEL, id_column=ID), "nn": fit_network(train, features, LABEL, ID)}
    return compact_predictions(score_holdout(test, scorers))


@query("L5_full_experiment")
def _(spark, d):
    table, _ = frame(spark, d)
    searches = {"xgb": {"jobs": 8}, "nn": {"space": network_space(table, LABEL, SMALL_NETWORKS), **NETWORK_SEARCH}}
    done = full_experiment(table, LABEL, ID, 40, searches=searches)
    tops = done.export.tops["greatest_savings"].select("feature", "auc_roc", "net_per_patient_savings")
    return tops.unionByName(
        done.evaluation.summary.select(F.concat(F.lit("summary "), "model").alias("feature"), F.col("roc_auc").alias("auc_roc"), F.lit(None).cast("double").alias("net_per_patient_savings"))
    )


@query("L9_selection_study")
def _(spark, d):
    raw = encounters(spark, d)
    table, _ = engineer(raw, [ID], fit_encoder(clean_encounters(raw, [ID]), separate_diagnoses=True))
    study = selection_study(table, LABEL, ID)
    steps = [(k, s["round"], s["removed"], s["criterion"], s["kept"]) for k, found in (("aic", study.steps), ("bic", study.bic_steps)) for s in found]
    kept = [("kept", i, f, None, len(study.features)) for i, f in enumerate(study.features)]
    sizes = [(r["split"], None, None, None, r["count"]) for r in study.tagged.groupBy("split").count().collect()]
    return spark.createDataFrame([*steps, *kept, *sizes], "part string, round int, feature string, criterion double, n int")


@query("L10_smoke_scores", with_encounters(CLEAN + "SELECT count(*) AS n, true AS probabilities, 1::BIGINT AS different FROM cleaned"))
def _(spark, d):
    rows, features = frame(spark, d)
    scores = smoke_scores(fit_linear(rows, features, LABEL), rows)
    p = F.col("predicted_proba")
    return scores.agg(
        F.count("*").alias("n"), F.bool_and(p.between(0.0, 1.0)).alias("probabilities"), F.countDistinct(p).alias("different")
    )


@query("R1_score_stream", with_encounters(HOLDOUT + "SELECT encounter_id, readmitted, true AS equals_batch FROM tagged WHERE split = 'test'"))
def _(spark, d):
    train, test, features = holdout(spark, d)
    scorer = fit_boosted(train, features, LABEL, id_column=ID)
    arrivals = run_folder(spark, "arrivals")
    test.write.parquet(arrivals)
    out = run_folder(spark, "stream")
    stream = score_stream(arriving(spark, arrivals, test.schema), scorer, "xgb_prob")
    write_scores(stream, f"{out}/scores", f"{out}/progress").awaitTermination()
    batch = scorer.score(test, "batch_prob").select(F.col(ID).alias("id"), "batch_prob")
    both = spark.read.parquet(f"{out}/scores").join(batch, F.col(ID) == F.col("id"), "left")
    return both.select(ID, LABEL, (F.col("xgb_prob") == F.col("batch_prob")).alias("equals_batch"))
