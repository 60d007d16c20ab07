"""Values that earlier rounds rounded, overflowed or refused: sums, summaries, AUC, reasons, CSV types."""

import math

import pytest
from pyspark.sql import functions as F

from riskfeat.functions import exprs as X
from riskfeat.operators import evaluate, explain, profile
from riskfeat.sources import io as IO

INF, NAN = float("inf"), float("nan")


@pytest.mark.parametrize("values, total", [
    ([0.00004, 0.00004, 1.23456], 1.23464), ([1.25, 2.5, None], 3.75), ([6e14, 6e14], 1.2e15), ([1e300, 1.0], 1e300), ([INF, 1.0], INF),
    ([INF, -INF], NAN), ([NAN, 2.0], NAN), ([123456.123456, 0.000001], 123456.123457), ([2.0**39] * 3000, 3000 * 2.0**39), ([], 0.0),
])
def test_sums_keep_every_digit(spark, values, total):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = df.agg(X.sum0("x", 4).alias("s"), X.mean("x", 4).alias("m")).first()
    n = sum(v is not None for v in values)
    if math.isnan(total):
        assert math.isnan(got.s) and math.isnan(got.m)
    else:
        assert got.s == pytest.approx(total, rel=1e-15) and (got.m == pytest.approx(total / n, rel=1e-15) if n else got.m is None)


def test_money_sums_do_not_depend_on_order(spark):
    df = spark.range(20_000).select(((F.col("id") * 7919 % 100_003) / 100).alias("x"))
    sums = {df.orderBy(F.rand(seed)).repartition(seed + 1).agg(X.sum0("x", 4)).first()[0] for seed in range(4)}
    assert sums == {sum(i * 7919 % 100_003 for i in range(20_000)) / 100}


def test_summary_of_inf_and_of_small_values(spark):
    df = spark.createDataFrame([(1.0, INF, 4.9e-7), (2.0, 1.0, 4.9e-7), (4.0, None, None)], "a double, b double, c double")
    got = {r.column_name: r for r in profile.feature_summary(df).collect()}
    assert got["a"].mean == pytest.approx(7 / 3) and got["a"].std == pytest.approx(1.5275252316519465)
    assert got["b"].mean == INF and math.isnan(got["b"].std) and got["b"].max == INF and got["b"].null_count == 1
    assert got["c"].mean == pytest.approx(4.9e-7)
    assert profile.score_summary(df.select(F.col("c").alias("SCORE")), "SCORE").first().mean_score == pytest.approx(4.9e-7)


def test_auc_of_one_class_is_null(spark):
    df = spark.createDataFrame([(1, 0, 0.2), (1, 0, 0.4), (2, 0, 0.1), (2, 1, 0.3), (2, 1, 0.1)], "week int, TARGET int, SCORE double")
    by = {r.week: r.auc for r in evaluate.roc_auc_by(df, "week").collect()}
    assert by == {1: None, 2: 0.75}
    one = df.where("week = 1")
    assert evaluate.roc_auc(one).first().auc is None
    assert {(r.tpr, r.fpr is None) for r in evaluate.roc_points(one).collect()} == {(None, False)}


def test_rows_without_a_score_take_no_part(spark):
    df = spark.createDataFrame([(0, 0.1), (1, 0.9), (0, None), (1, None)], "TARGET int, SCORE double")
    assert evaluate.threshold_metrics(df, 0.35).first().approval_rate == 0.5
    sweep = {round(r.threshold, 2): r.approval_rate for r in evaluate.threshold_sweep(df).collect()}
    assert sweep[0.35] == 0.5
    assert evaluate.threshold_metrics(df.limit(0), 0.35).first().approval_rate is None


def test_reasons_with_an_infinite_feature(spark):
    reasons = (explain.Reason("r", "high", "ratio"), explain.Reason("a", "low", "age"))
    df = spark.createDataFrame([(1, INF, 30.0), (2, 2.0, 50.0), (3, 1.0, 40.0)], "SK_ID_CURR long, r double, a double")
    got = {(x.SK_ID_CURR, x.feature): x.strength for x in explain.top_reasons(df, reasons).collect()}
    assert got == {(1, "r"): 1.0, (2, "r"): 1.0, (3, "r"): 0.0, (1, "a"): 1.0, (2, "a"): 0.0, (3, "a"): 0.5}


def test_csv_types_of_undeclared_columns(spark, tmp_path):
    path = str(tmp_path / "app.csv")
    with open(path, "w") as f:
        f.write('SK_ID_CURR,TARGET,OWN_CAR_AGE,APARTMENTS_AVG,"NOTE, free",AMT_CREDIT\n1,0,3,0.1,x,10\n2,1,,0.25,"y, z",20.5\n')
    df = IO.read_application(spark, path)
    kinds = dict(df.dtypes)
    assert kinds["OWN_CAR_AGE"] in ("int", "bigint") and kinds["APARTMENTS_AVG"] == "double" and kinds["AMT_CREDIT"] == "double"
    assert "NOTE, free" in df.columns and df.where("SK_ID_CURR = 2").first()["NOTE, free"] == "y, z"
    declared = IO.read_application(spark, path, infer_rest=False)
    assert dict(declared.dtypes)["OWN_CAR_AGE"] == "string" and declared.columns == df.columns


def test_status_of_weeks(spark):
    from riskfeat.streaming import monitor as MON

    df = spark.createDataFrame([(None,), (0.5,), (0.73,), (0.9,)], "auc double")
    plain = {r.auc: r.s for r in df.select("auc", MON.auc_status(F.col("auc")).alias("s")).collect()}
    assert plain == {None: "NO_DATA", 0.5: "ALERT", 0.73: "WARN", 0.9: "OK"}
    drop = MON.DEFAULT_PLAN.retrain_auc_drop
    far = {r.auc: r.s for r in df.select("auc", MON.auc_status(F.col("auc"), 0.9 + drop / 2).alias("s")).collect()}
    assert far == {None: "NO_DATA", 0.5: "RETRAIN", 0.73: "RETRAIN", 0.9: "OK"}


def test_final_fit_follows_the_arms():
    from riskfeat.plans import modeling as ML

    draws = ML.draw_params(2, seed=3)
    cands = [ML.CVResult("candidate_0", [0.7, NAN, 0.7], draws[0]), ML.CVResult("candidate_1", [0.6, 0.65, 0.7], draws[1])]
    assert cands[0].mean == pytest.approx(0.7) and cands[0].std == pytest.approx(0.0)
    arm = lambda name, auc: ML.CVResult(name, [auc])
    make, weighted = ML.choose_final(cands, [arm("baseline", 0.7), arm("class_weights", 0.71)])
    assert weighted and make(10).getMaxIter() == draws[0]["n_estimators"]
    assert not ML.choose_final(cands, [arm("baseline", 0.7), arm("class_weights", 0.7)])[1]


def test_a_value_off_the_units_leaves_the_others_exact(spark):
    """Large values that cancel do not take the rest of the group with them, in any order."""
    rows = [(0.5,), (1e17,), (2.25,), (-1e17,)]
    for i in range(4):
        df = spark.createDataFrame(rows[i:] + rows[:i], "x double").coalesce(1)
        assert df.agg(X.sum0("x", 4)).first()[0] == 2.75
    odd = [([float("nan"), 1.0], "nan"), ([float("inf"), 1.0], "inf"), ([float("inf"), float("-inf")], "nan"), ([1e-7, None], "1e-07"), ([None], "0.0")]
    for values, want in odd:
        df = spark.createDataFrame([(v,) for v in values], "x double")
        assert str(df.agg(X.sum0("x", 4)).first()[0]) == want
