import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortscore.catalog.inputs import encounters
from cohortscore.operators.columns import prepare_frame, schema_diff
from cohortscore.operators.encode import OneHot, fit_one_hot, require_int
from cohortscore.operators.models import best_settings, fit_linear, random_settings, results_frame, score_models
from cohortscore.operators.scale import Scaler, fit_scaler
from cohortscore.operators.select import (
    backward_elimination, fit_least_squares, moments, pca_scores, rank_features, select_cumulative, select_features,
)
from cohortscore.operators.split import (
    class_quotas, k_folds, seeded_positions, split_by_share, stratified_folds, stratified_split,
)
from cohortscore.plans.engineering import clean_encounters, engineer
from cohortscore.session import run_folder
from cohortscore.sources.features import names_of, read_list, resolve_files
from cohortscore.sources.tables import predictions_name, read_encounters, read_many
from cohortscore.streaming.score import arriving, score_stream, write_scores


def labelled(spark, n=203):
    return spark.range(n).select("id", (F.col("id") % 7 == 0).cast("int").alias("y"))


def test_folds_part_the_rows_evenly(spark):
    folds = stratified_folds(labelled(spark), "id", "y").collect()
    assert len({r["id"] for r in folds}) == 203
    sizes = [sum(r["fold"] == k for r in folds) for k in range(5)]
    positives = [sum(r["fold"] == k and r["y"] for r in folds) for k in range(5)]
    assert max(sizes) - min(sizes) <= 1 and max(positives) - min(positives) <= 1
    again = stratified_folds(labelled(spark).repartition(3), "id", "y").collect()
    assert {tuple(r) for r in folds} == {tuple(r) for r in again}
    plain = k_folds(labelled(spark), "id", 4).groupBy("fold").count().collect()
    assert sorted(r["count"] for r in plain) == [50, 51, 51, 51]


def test_splits(spark):
    df = labelled(spark)
    parts = {r["split"]: r["count"] for r in split_by_share(df, "id", 0.8).groupBy("split").count().collect()}
    assert parts == {"train": 162, "test": 41}
    held = stratified_split(df, "id", "y").where("split = 'test'").agg(F.count("*"), F.sum("y")).first()
    assert tuple(held) == (41, 6)
    missing = df.withColumn("y", F.when(F.col("id") > 9, F.col("y")))
    assert stratified_split(missing, "id", "y").count() == 193
    text = df.select(F.concat(F.lit("k"), "id").alias("id"), "y")
    assert split_by_share(text, "id", 0.5).where("split = 'train'").count() == 101
    assert split_by_share(df, "id", 0.001).where("split = 'train'").count() == 0


def test_positions_are_a_permutation(spark):
    rows = seeded_positions(labelled(spark), "id", "y").collect()
    for y in (0, 1):
        mine = sorted(r["pos"] for r in rows if r["y"] == y)
        assert mine == list(range(1, len(mine) + 1))


def test_quotas_share_out_everything(spark):
    sizes = spark.createDataFrame([("0", 174), ("1", 29)], "grp string, n long")
    for small in (0, 10):
        assert {r["grp"]: r["quota"] for r in class_quotas(sizes, 41, small).collect()} == {"0": 35, "1": 6}


def test_one_hot(spark):
    rows = [("a", "x", "y", 1), ("a", "y", None, 2), ("b", None, None, None), (None, "z", "x", 1)]
    df = spark.createDataFrame(rows, "c string, d1 string, d2 string, k int")
    model = fit_one_hot(df, ["c", "k"], {"d": ["d1", "d2"]})
    assert model.columns() == ["d_x", "d_y", "d_z", "c_b", "k_2"]
    got = [tuple(r) for r in OneHot.from_json(model.to_json()).transform(df).collect()]
    assert got == [(1, 1, 0, 0, 0), (0, 1, 0, 0, 1), (0, 0, 0, 1, 0), (1, 0, 1, 0, 0)]
    unseen = spark.createDataFrame([("new", "q", None, 9)], df.schema)
    assert tuple(model.transform(unseen).first()) == (0, 0, 0, 0, 0)
    with pytest.raises(ValueError):
        fit_one_hot(df, ["c", "d1"], max_categories=2)


def test_integers_are_required(spark):
    with pytest.raises(ValueError):
        require_int(spark.createDataFrame([("1",), ("x",)], "a string"))


def test_cleaning_keeps_unknown_outcomes_and_drops_deaths(spark, small):
    raw = encounters(spark, small)
    cleaned = clean_encounters(raw, ["encounter_id"])
    assert cleaned.where("discharge_disposition = 'died'").count() == 0
    unknown = raw.limit(1).withColumn("discharge_disposition_id", F.lit(None).cast("int"))
    assert clean_encounters(unknown).count() == 1
    none = clean_encounters(raw, none_as_null=True)
    assert none.where("A1Cresult IS NULL").count() > 0 and none.where("A1Cresult = 'NotTaken'").count() == 0
    table, encoder = engineer(raw, ["encounter_id"])
    assert table.columns[0] == "readmitted" and {t for _, t in table.drop("encounter_id").dtypes} == {"int"}
    again, _ = engineer(raw.limit(5), ["encounter_id"], encoder)
    assert again.columns == table.columns


def test_reading_encounters_by_name(spark, small):
    path = run_folder(spark, "names")
    raw = encounters(spark, small)
    raw.select("readmitted", F.col("`glyburide.metformin`"), "encounter_id").write.option("header", True).csv(path)
    back = read_encounters(spark, path)
    assert len(back.columns) == 50 and back.where("encounter_id IS NULL").count() == 0
    assert back.where(F.col("`glyburide.metformin`") == "Up").count() > 0 and back.where("weight IS NOT NULL").count() == 0


def test_read_many_skips_empty_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "b.csv").write_text("y,z\n3,4\n")
    (tmp_path / "c.csv").write_text("")
    (tmp_path / "d.txt").write_text("x\n9\n")
    got = sorted(tuple(map(str, r)) for r in read_many(spark, str(tmp_path)).collect())
    assert got == [("1", "2", "None"), ("None", "3", "4")]
    (tmp_path / "none").mkdir()
    with pytest.raises(FileNotFoundError):
        read_many(spark, str(tmp_path / "none"))


def test_feature_list_files(spark, tmp_path):
    (tmp_path / "l.csv").write_text("Selected_Features,gain\n a ,1\n\nb,2\n")
    (tmp_path / "l.txt").write_text("feature\n  c \n\n")
    (tmp_path / "p.pointer").write_text(str(tmp_path / "l.txt") + "\n")
    (tmp_path / "empty.txt").write_text("\n")
    assert names_of(read_list(spark, str(tmp_path / "l.csv"))) == ["a", "b"]
    names, source = resolve_files(
        spark, [str(tmp_path / "absent.txt"), str(tmp_path / "empty.txt"), str(tmp_path / "p.pointer"), str(tmp_path / "l.csv")]
    )
    assert names == ["feature", "c"] and source.endswith("p.pointer")
    with pytest.raises(FileNotFoundError):
        resolve_files(spark, [str(tmp_path / "absent.txt")])


def test_serving_frame(spark):
    df = spark.createDataFrame([("1.5", float("inf"), 1, 7), ("x", float("nan"), 0, 8)], "a string, b double, readmitted int, id int")
    rows = prepare_frame(df, ["b", "a", "unseen", "id"]).collect()
    assert [tuple(r) for r in rows] == [(0.0, 1.5, 0.0, 0.0), (0.0, 0.0, 0.0, 0.0)]
    assert schema_diff(df, ["a", "q"])["missing"] == ["q"]
    assert predictions_name("dir/test.CSV") == "test_with_predictions.csv"


def test_scalers(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, flat double")
    standard = Scaler.from_json(fit_scaler(df, ["a", "flat"]).to_json())
    assert [tuple(r) for r in standard.transform(df).collect()] == [(-1.0, 0.0), (1.0, 0.0)]
    assert [tuple(r) for r in fit_scaler(df, ["a", "flat"], "minmax").transform(df).collect()] == [(0.0, 0.0), (1.0, 0.0)]
    assert fit_scaler(df, ["a"], "none").transform(df) is df
    with pytest.raises(ValueError):
        fit_scaler(df, ["a"], "other")


def test_strict_prefix_may_be_empty(spark):
    ranking = rank_features(spark.createDataFrame([("a", 9.0), ("b", 1.0)], "feature string, gain_cv double"))
    assert select_cumulative(ranking, 0.5).count() == 0
    assert [r[0] for r in select_features(ranking, 1).collect()] == ["a"]
    useless = rank_features(spark.createDataFrame([("a", 0.0), ("b", 0.0)], "feature string, gain_cv double"))
    assert [r["cum_importance"] for r in useless.collect()] == [None, None]


def linear_sample(spark, n=400):
    draw = np.random.default_rng(0)
    x = draw.normal(size=(n, 4))
    y = 2 * x[:, 0] - x[:, 1] + draw.normal(size=n) * 0.5
    rows = [tuple(map(float, [*r, t])) for r, t in zip(x, y)]
    return x, y, spark.createDataFrame(rows, "a double, b double, c double, d double, y double")


def test_least_squares_matches_numpy(spark):
    x, y, df = linear_sample(spark)
    fit = fit_least_squares(moments(df, ["a", "b", "c", "d"], "y"), ["a", "b", "c"])
    design = np.column_stack([np.ones(len(y)), x[:, :3]])
    beta, rss, *_ = np.linalg.lstsq(design, y, rcond=None)
    assert fit.rss == pytest.approx(float(rss[0]), rel=1e-9)
    n, k = len(y), 4
    aic = n * (np.log(2 * np.pi) + np.log(rss[0] / n) + 1) + 2 * k
    assert fit.criterion == pytest.approx(aic, rel=1e-9)
    error = np.sqrt(rss[0] / (n - k) * np.linalg.inv(design.T @ design)[1, 1])
    assert fit.t_values["a"] == pytest.approx(abs(beta[1] / error), rel=1e-8)


def test_elimination_drops_noise_first(spark):
    _, _, df = linear_sample(spark)
    for criterion in ("aic", "bic"):
        steps = backward_elimination(moments(df, ["a", "b", "c", "d"], "y"), criterion)
        assert {s["removed"] for s in steps[:2]} == {"c", "d"}


def test_pca_scores(spark):
    x, _, df = linear_sample(spark)
    got = dict(pca_scores(df, ["a", "b", "c", "d"]))
    _, vectors = np.linalg.eigh(np.cov(x.T))
    assert list(got.values()) == sorted(got.values(), reverse=True)
    assert got["a"] == pytest.approx(np.abs(vectors).sum(axis=1)[0], rel=1e-6)


def test_settings(spark):
    space = {"a": (1, 5, True), "featureSubsetStrategy": (0.5, 1.0, False)}
    first = random_settings(space, 3)
    assert first == random_settings(space, 3) and all(1 <= s["a"] <= 5 for s in first)
    results = [{"job_name": f"j{i}", "objective": o, "params": {k: str(v) for k, v in s.items()}} for i, (o, s) in enumerate(zip([0.1, 0.9, 0.5], first))]
    assert best_settings(results_frame(spark, results))["a"] == first[1]["a"]


def test_stream_scores_like_batch(spark):
    rows = spark.range(300).select(
        F.col("id").alias("encounter_id"), (F.col("id") % 3 == 0).cast("int").alias("readmitted"),
        (F.col("id") % 3 + F.col("id") % 5).cast("double").alias("a"), F.when(F.col("id") % 4 > 0, F.col("id") % 11).cast("double").alias("b"),
    )
    scorer = fit_linear(rows, ["a", "b", "unseen"], "readmitted")
    folder, out = run_folder(spark, "in"), run_folder(spark, "out")
    rows.write.parquet(folder)
    stream = score_stream(arriving(spark, folder, rows.schema), scorer)
    write_scores(stream, f"{out}/s", f"{out}/c").awaitTermination()
    batch = {r["encounter_id"]: r["predicted_proba"] for r in scorer.score(rows).collect()}
    got = {r["encounter_id"]: r["predicted_proba"] for r in spark.read.parquet(f"{out}/s").collect()}
    assert got == pytest.approx(batch)
    write_scores(score_stream(arriving(spark, folder, rows.schema), scorer), f"{out}/s", f"{out}/c").awaitTermination()
    assert spark.read.parquet(f"{out}/s").count() == 300
    both = score_models(rows, {"linear": scorer, "nn": None})
    assert both.where("nn_prob IS NOT NULL").count() == 0 and both.where("linear_prob IS NULL").count() == 0


def test_missing_ids_and_classes_are_kept(spark):
    df = labelled(spark, 200).select(
        F.when(F.col("id") % 50 != 0, F.col("id")).alias("id"), F.when(F.col("id") % 40 != 1, F.col("y")).alias("y")
    )
    positions = seeded_positions(df, "id", "y")
    assert positions.count() == 200
    for y, n in df.groupBy("y").count().collect():
        mine = positions.where(F.col("y").eqNullSafe(F.lit(y)))
        assert sorted(r["pos"] for r in mine.collect()) == list(range(1, n + 1))
    known = df.where("y IS NOT NULL").count()
    folds = stratified_folds(df, "id", "y")
    assert folds.count() == known and folds.where("fold IS NULL").count() == 0
    sizes = [r["count"] for r in folds.groupBy("fold").count().collect()]
    assert max(sizes) - min(sizes) <= 4  # the four rows without id stay together
    assert k_folds(df, "id", 4).where("fold IS NULL").count() == 0
    train = split_by_share(df, "id", 0.8).where("split = 'train'").count()
    assert abs(train - 160) <= 4


def test_read_many_takes_few_jobs(spark, tmp_path):
    for k in range(500):
        (tmp_path / f"part {k:03d}.csv").write_text(f"x,{'y' if k % 2 else 'z'}\n{k},{k}\n")
    spark.sparkContext.setJobGroup("many", "read_many")
    table = read_many(spark, str(tmp_path))
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("many")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) <= 12 and table.columns[0] == "x" and table.count() == 500


def test_files_of_many_headers(spark, tmp_path):
    want = []
    for k in range(300):
        names = [f"n{k % 50}", "id", '"quoted, name"'] if k % 2 else ["id", f"n{k % 50}"]
        fields = [f'"v,{k}"', str(k), f"q{k}"] if k % 2 else [str(k), f"v{k}"]
        blank = "\n  \n" if k % 7 == 0 else ""
        (tmp_path / f"f{k:03d}.csv").write_text(f"{blank}{','.join(names)}\n{','.join(fields)}\n\n{','.join(fields)}\n")
        want += [(str(k), f"v,{k}" if k % 2 else f"v{k}", f"q{k}" if k % 2 else None)] * 2
    table = read_many(spark, str(tmp_path))
    assert len(table.columns) == 52 and table.columns[:2] == ["id", "n0"] and "quoted, name" in table.columns
    every = F.coalesce(*[F.col(c) for c in table.columns if c.startswith("n")])
    got = [tuple(r) for r in table.select("id", every, "`quoted, name`").collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_missing_responses_keep_a_row(spark):
    from cohortscore.functions.responses import parse_responses, require_complete

    raw = [(1, 1, '{"predictions": []}'), (2, 2, ""), (3, 1, None), (4, 1, "0.5"), (5, 0, "")]
    parsed = parse_responses(spark.createDataFrame(raw, "batch_id int, n_rows int, raw string"))
    assert sorted((r["batch_id"], r["complete"]) for r in parsed.collect()) == [(1, False), (2, False), (3, False), (4, True), (5, True)]
    with pytest.raises(ValueError):
        require_complete(parsed)
    assert require_complete(parsed.where("batch_id > 3")).count() == 1


def test_scratch_removes_stored_tables(spark):
    from pathlib import Path

    from cohortscore.session import scratch, settle

    with scratch(spark):
        stored = settle(spark.range(5))
        (file,) = {Path(f.removeprefix("file:")).parent for f in stored.inputFiles()}
        assert stored.count() == 5 and Path(str(file).replace("//", "")).exists()
    assert not Path(str(file).replace("//", "")).exists()
