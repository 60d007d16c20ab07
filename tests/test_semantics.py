"""Edge-case semantics on frames of at most six rows (null / NaN / zero rules)."""

import math

import pytest
from pyspark.sql import functions as F

from riskfeat.functions import exprs as X
from riskfeat.operators import decide as D
from riskfeat.operators import encode as E
from riskfeat.operators import evaluate as V
from riskfeat.operators import features as FE
from riskfeat.operators import fit as FIT
from riskfeat.operators import history as H
from riskfeat.operators import quantiles as Q


def _vals(df, col):
    return [r[col] for r in df.orderBy("id").collect()]


def _same(a, b):
    if a is None or b is None:
        return a is b
    if isinstance(a, float) and math.isnan(a):
        return isinstance(b, float) and math.isnan(b)
    return a == b


def test_ratio_ieee(spark):
    rows = [(1, 1.0, 0.0), (2, -1.0, 0.0), (3, 0.0, 0.0), (4, None, 0.0), (5, 1.0, None), (6, 6.0, 3.0),
            (7, float("nan"), 0.0)]
    df = spark.createDataFrame(rows, "id int, a double, b double").select("id", X.ratio("a", "b").alias("r"))
    got = _vals(df, "r")
    want = [math.inf, -math.inf, math.nan, None, None, 2.0, math.nan]
    assert all(_same(g, w) for g, w in zip(got, want)), got


def test_ratio_other_rules(spark):
    df = spark.createDataFrame([(1, 1.0, 0.0), (2, None, 0.0), (3, 4.0, 2.0)], "id int, a double, b double")
    assert _vals(df.select("id", X.ratio("a", "b", "null").alias("r")), "r") == [None, None, 2.0]
    assert _vals(df.select("id", X.ratio("a", "b", "zero").alias("r")), "r") == [0.0, None, 2.0]


def test_sum_of_nulls_group(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, 1.5)], "k int, x double")
    out = {r["k"]: r for r in df.groupBy("k").agg(
        X.sum0("x", 4).alias("s"), F.max("x").alias("m"), X.mean("x", 4).alias("a"),
        X.count_if(F.col("x") > 0).alias("c")).collect()}
    assert out[1]["s"] == 0.0 and out[1]["m"] is None and out[1]["a"] is None and out[1]["c"] == 0
    assert out[2]["s"] == 1.5 and out[2]["a"] == 1.5


def test_distinct_counts_null(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (1, None)], "k int, v string")
    assert df.groupBy("k").agg(X.n_unique_with_null("v").alias("n")).first()["n"] == 3


def test_median_even_and_nulls(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,), (None,)], "x double")
    assert Q.exact_medians(df, ["x"]) == {"x": 2.5}


def test_quantiles_match_percentile(spark):
    df = spark.range(0, 5000).select(((F.col("id") * 7919) % 1013).cast("double").alias("x"),
                                     (F.col("id") % 7).cast("double").alias("y"))
    for q in (0.1, 0.25, 0.5, 0.9):
        got = Q.exact_quantiles(df, ["x", "y"], q, accuracy=100, max_exact=50, small_rows=0)
        want = df.agg(F.percentile("x", q).alias("x"), F.percentile("y", q).alias("y")).first()
        assert got["x"] == pytest.approx(want["x"], abs=1e-9) and got["y"] == pytest.approx(want["y"], abs=1e-9)


def test_mode_compete_and_ignore(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), (None,), (None,)], "v string")
    assert FIT.modes(df, ["v"], "compete") == {"v": None}
    assert FIT.modes(df, ["v"], "ignore") == {"v": "a"}


def test_missing_share_strict(spark):
    df = spark.createDataFrame([(1, None, None), (2, 5, None), (3, None, 1)], "id int, half int, most int")
    # half: 2 of 3 null -> dropped; most: 2 of 3 null -> dropped; id kept
    assert FIT.drop_high_missing(df).columns == ["id"]
    df2 = spark.createDataFrame([(1, None), (2, 5)], "id int, half int")
    assert FIT.drop_high_missing(df2).columns == ["id", "half"]


def test_sentinel(spark):
    df = spark.createDataFrame([(1, 15000), (2, 15001), (3, 365243), (4, -10), (5, None)],
                               "id int, DAYS_EMPLOYED int")
    out = FIT.fix_sentinel(df)
    assert _vals(out, "DAYS_EMPLOYED") == [15000, None, None, -10, None]
    assert _vals(out, "FLAG_UNEMPLOYED_UNKNOWN") == [0, 1, 1, 0, None]


def test_bins_null_falls_to_last(spark):
    days = [29.99, 30.0, 49.99, 50.0, None]
    df = spark.createDataFrame([(i, None if a is None else -a * 365.25) for i, a in enumerate(days)],
                               "id int, DAYS_BIRTH double")
    out = df.select("id", X.bucketize(X.years_from_days("DAYS_BIRTH"), FE.AGE_CUTS, FE.AGE_LABELS).alias("g"))
    assert _vals(out, "g") == ["Young", "Middle", "Middle", "Senior", "Senior"]


def test_fill_keeps_nan(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, None)], "id int, x double").select("id", X.fill("x", 0).alias("x"))
    got = _vals(df, "x")
    assert math.isnan(got[0]) and got[1] == 0.0


def test_no_history_gets_zero(spark):
    app = spark.createDataFrame([(1,), (2,)], "SK_ID_CURR long")
    inst = spark.createDataFrame([(1, -10.0, -12.0, 100.0, 90.0)],
                                 "SK_ID_CURR long, DAYS_ENTRY_PAYMENT double, DAYS_INSTALMENT double, "
                                 "AMT_PAYMENT double, AMT_INSTALMENT double")
    out = H.attach_histories(app, {"installments": H.rollup(inst, H.INSTALLMENTS)})
    row2 = out.where("SK_ID_CURR = 2").first().asDict()
    assert all(v == 0 for k, v in row2.items() if k != "SK_ID_CURR")
    row1 = out.where("SK_ID_CURR = 1").first()
    assert row1["INST_NUM_LATE_PAYMENTS"] == 1 and row1["INST_AVG_PAYMENT_DIFF"] == 10.0


def test_unfitted_plan_raises(spark):
    df = spark.createDataFrame([(1, 2.0)], "SK_ID_CURR long, x double")
    with pytest.raises(FIT.NotFittedError):
        FIT.clean(df, FIT.UNFITTED)


def test_auc_small(spark):
    df = spark.createDataFrame([(1, 0, 0.1), (2, 0, 0.4), (3, 1, 0.4), (4, 1, 0.8)], "SK_ID_CURR long, TARGET int, SCORE double")
    assert V.roc_auc(df).first()["auc"] == pytest.approx(0.875)


def test_auc_symmetry(spark):
    df = spark.range(0, 400).select(F.col("id").alias("SK_ID_CURR"), (F.col("id") % 3 == 0).cast("int").alias("TARGET"),
                                    ((F.col("id") * 37 % 101) / 101.0).alias("SCORE"))
    a = V.roc_auc(df).first()["auc"]
    b = V.roc_auc(df.withColumn("SCORE", 1 - F.col("SCORE"))).first()["auc"]
    assert a + b == pytest.approx(1.0)


def test_sweep_ends_and_monotone(spark):
    df = spark.createDataFrame([(i, i % 2, p) for i, p in enumerate([0.05, 0.2, 0.35, 0.5, 0.99])],
                               "SK_ID_CURR long, TARGET int, SCORE double")
    rows = V.threshold_sweep(df).orderBy("threshold").collect()
    assert len(rows) == 101
    assert rows[0]["approval_rate"] == 0.0 and rows[0]["expected_value"] == 0.0
    assert rows[-1]["approval_rate"] == 1.0
    rates = [r["approval_rate"] for r in rows]
    assert all(a <= b for a, b in zip(rates, rates[1:]))


def test_dummies_drop_first(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, c string")
    plan = E.fit_one_hot(df, ["c"])
    out = E.one_hot(df, plan)
    assert out.columns == ["id", "c_b"] and _vals(out, "c_b") == [0, 1, 0]


def test_sanitize_names_collision(spark):
    df = spark.createDataFrame([(1, 2)], "`a-b` int, `a b` int")
    with pytest.raises(ValueError):
        E.sanitize_names(df)
    assert E.sanitize_names(spark.createDataFrame([(1,)], "`x-1` int")).columns == ["x_1"]


def test_pilot_share(spark):
    df = spark.range(0, 20000).withColumnRenamed("id", "SK_ID_CURR")
    share = df.select(F.avg(D.pilot_flag().cast("double")).alias("s")).first()["s"]
    assert 0.18 < share < 0.22


def test_ratio_matches_ieee_division_property(spark):
    import numpy as np
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    special = st.sampled_from([0.0, -0.0, 1.0, -1.0, 2.5, float("nan"), float("inf"), float("-inf"), None])
    num = st.one_of(special, st.floats(allow_nan=True, allow_infinity=True, width=64))

    @settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(st.tuples(num, num), min_size=1, max_size=40))
    def check(pairs):
        rows = [(i, a, b) for i, (a, b) in enumerate(pairs)]
        df = spark.createDataFrame(rows, "id int, a double, b double").select("id", X.ratio("a", "b").alias("r"))
        got = _vals(df, "r")
        with np.errstate(all="ignore"):
            want = [None if (a is None or b is None) else float(np.float64(a) / np.float64(b)) for _, a, b in rows]
        assert all(_same(g, w) for g, w in zip(got, want)), list(zip(pairs, got, want))

    check()
