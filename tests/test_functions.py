import pytest
from pyspark.sql import functions as F

from cohortscore.functions.diagnosis import diagnosis_group
from cohortscore.functions.labels import binary_label, complete_label, strict_label
from cohortscore.functions.numeric import clip_upper, ratio, round_half_even, text_to_double
from cohortscore.functions.recode import merge_admission_types, recode_int, recode_position
from cohortscore.functions.responses import log_metrics, parse_responses, require_complete
from cohortscore.functions.scores import (
    flag_thresholds, looks_like_probability, symmetric_thresholds, threshold_flags, to_probability,
)


def column(spark, values, kind):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")


def apply(spark, values, kind, make):
    rows = column(spark, values, kind).select("i", make(F.col("v")).alias("o")).orderBy("i").collect()
    return [r["o"] for r in rows]


def test_diagnosis_edges(spark):
    cases = {
        "139": "infection", "140": "neoplasm", "249": "metabolic", "250": "Nothing", "251": "metabolic",
        "339": "nervous", "340": "circulatory", "389": "circulatory", "390": "circulatory", "458": "circulatory",
        "459": "circulatory", "460": "respiratory", "250.83": "Nothing", "V57": "injury", "V45.81": "injury.81",
        "E849": "injury", "?": "?", "0": "Nothing", "760": "Nothing", "999": "injury", "1000": "Nothing",
        " 428 ": "circulatory", "-5": "Nothing", None: None, "1e2": "infection", "v57": "v57",
    }
    assert apply(spark, list(cases), "string", diagnosis_group) == list(cases.values())


def test_diagnosis_missing_as_nothing(spark):
    assert apply(spark, [None, "V1"], "string", lambda c: diagnosis_group(c, null_as_nothing=True)) == ["Nothing", "injury"]


def test_numbers_from_text(spark):
    texts = ["1", " 2.5 ", "1d", "nan", "inf", "", None, "1e3", "abc", "-.5", "5."]
    assert apply(spark, texts, "string", text_to_double) == [1.0, 2.5, None, None, None, None, None, 1000.0, None, -0.5, 5.0]


def test_rounding_is_half_even(spark):
    halves = apply(spark, [0.5, 1.5, 2.5, -0.5], "double", round_half_even)
    assert halves == [0.0, 2.0, 2.0, -0.0]
    assert apply(spark, [1, 3, 5], "int", lambda c: round_half_even(0.5 * c)) == [0.0, 2.0, 2.0]


def test_clip_keeps_null(spark):
    assert apply(spark, [None, 3, 9], "int", lambda c: clip_upper(c, 8)) == [None, 3, 8]


def test_ratio_without_denominator(spark):
    assert apply(spark, [0], "int", lambda c: ratio(F.lit(1), c)) == [0.0]
    assert apply(spark, [0], "int", lambda c: ratio(F.lit(1), c, None)) == [None]


def test_recodes(spark):
    assert apply(spark, ["NO", "<30", "what", None, "7"], "string", lambda c: recode_int(c, {"NO": 0, "<30": 1})) == [0, 1, None, None, 7]
    assert apply(spark, [1, 2, 9], "int", lambda c: recode_position(c, ["a", "b"])) == ["a", "b", "9"]
    assert apply(spark, [5, 6, 8, None], "int", merge_admission_types) == [5, 5, 5, None]
    assert apply(spark, [5, 6, 8], "int", lambda c: merge_admission_types(c, True)) == [5, 5, 6]


def test_labels(spark):
    df = column(spark, ["NO", ">30", "maybe", None], "string")
    assert [r["o"] for r in df.select(binary_label(df, "v").alias("o")).collect()] == [0, 1, None, None]
    nan = column(spark, [0.5, float("nan"), None, 0.2], "double")
    assert [r["o"] for r in nan.select(binary_label(nan, "v").alias("o")).collect()] == [1, None, None, 0]
    with pytest.raises(ValueError):
        strict_label(column(spark, [0.0, 2.0], "double"), "v")
    with pytest.raises(ValueError):
        complete_label(column(spark, ["yes", None], "string"), "v")
    assert complete_label(column(spark, ["0.0", "yes"], "string"), "v").select("label").collect()[0][0] == 0


def test_threshold_flags_treat_nan_as_missing(spark):
    df = column(spark, [float("nan"), 0.5, None], "double")
    kept = threshold_flags(df, ["v"], listed=[0.5]).orderBy("i").collect()
    assert [r["v_ge_050pct"] for r in kept] == [None, 1, None]
    plain = threshold_flags(df, ["v"], listed=[0.5], preserve_na=False).orderBy("i").collect()
    assert [r["v_ge_050pct"] for r in plain] == [0, 1, 0]
    with pytest.raises(ValueError):
        flag_thresholds(0, 0, 1, [0.01])


def test_grids():
    grid = symmetric_thresholds(0.11, 0.05, 0.0001, 5)
    assert len(grid) == 1001 and grid[0] == 0.16 and grid[-1] == 0.06 and grid == sorted(grid, reverse=True)
    flags = flag_thresholds(0.05, 0.95, 0.05)
    assert len(flags) == 19 and flags[6] == 0.35


def test_probability_detection(spark):
    df = spark.createDataFrame([(0.1, 3.0, None), (1.0, -1.0, None)], "p double, logit double, nothing double")
    found = {r["column"]: r["is_probability"] for r in looks_like_probability(df, df.columns).collect()}
    assert found == {"p": True, "logit": False, "nothing": False}
    squashed = to_probability(df, ["p", "logit"]).collect()
    assert squashed[0]["p"] == 0.1 and 0.95 < squashed[0]["logit"] < 0.96


def test_responses(spark):
    rows = [
        (1, 2, '{"predictions": [[0.5], [0.25]]}'), (2, 2, '{"predictions": [1, 2]}'), (3, 3, "0.1,0.2\n0.3\n"),
        (4, 2, "0.1"), (5, 2, "0.1\r\n0.2"), (6, 1, "oops"),
    ]
    parsed = parse_responses(spark.createDataFrame(rows, "batch_id int, n_rows int, raw string"))
    got = {}
    for r in parsed.orderBy("batch_id", "pos").collect():
        got.setdefault(r["batch_id"], []).append((r["score"], r["complete"]))
    assert got[1] == [(0.5, True), (0.25, True)] and got[2] == [(1.0, True), (2.0, True)]
    assert [s for s, _ in got[3]] == [0.1, 0.2, 0.3] and got[4] == [(0.1, False)]
    assert got[5] == [(0.1, True), (0.2, True)] and got[6] == [(None, False)]
    with pytest.raises(ValueError):
        require_complete(parsed)


def test_log_metrics(spark):
    lines = spark.createDataFrame([("x validation:auc=0.61 validation-aucpr:0.2",), ("none",)], "line string")
    assert sorted(tuple(r) for r in log_metrics(lines).collect()) == [("auc", 0.61), ("aucpr", 0.2)]
