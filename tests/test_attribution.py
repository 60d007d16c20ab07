"""Linear attributions: they add up, and reasons follow from their signs."""

import math

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from riskfeat.operators import attribution as AT
from riskfeat.operators.explain import Reason, top_reasons
from riskfeat.plans import catalog_scoring as CS


@pytest.fixture(scope="module")
def fitted(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 4)) * [1.0, 50.0, 0.01, 1.0] + [0, 100, 1, -2]
    y = (rng.random(600) < 1 / (1 + np.exp(-(1.5 * x[:, 0] - 0.03 * (x[:, 1] - 100))))).astype(float)
    rows = [(i, float(t), [float(v) for v in r]) for i, (t, r) in enumerate(zip(y, x))]
    df = spark.createDataFrame(rows, "SK_ID_CURR long, TARGET double, x array<double>").repartition(4)
    df = df.withColumn("features", array_to_vector("x")).cache()
    model, scorer = CS.fit_linear(df, ["a", "b", "c", "d"], 1e-3)
    return df, model, scorer, x, y


def test_contributions_add_up_to_the_models_log_odds(fitted):
    df, model, scorer, x, _ = fitted
    rows = AT.attribute(df, scorer, ["SK_ID_CURR"], vector_to_array("features"))
    own = model.transform(df).select("SK_ID_CURR", vector_to_array("rawPrediction")[1].alias("raw"), vector_to_array("probability")[1].alias("p"))
    for r in rows.join(own, "SK_ID_CURR").collect():
        assert abs(r["logit"] - r["raw"]) < 1e-9 and abs(r["SCORE"] - r["p"]) < 1e-12
        assert abs(sum(r["contributions"]) + scorer.base - r["raw"]) < 1e-9
    assert np.allclose(scorer.means, x.mean(axis=0))


def test_fit_meets_the_optimality_conditions(fitted):
    """Gradient of the mean loss plus the penalty (on standardised coefficients) is zero."""
    _, model, scorer, x, y = fitted
    w, sd = np.array(scorer.coefficients), x.std(axis=0, ddof=1)
    p = 1 / (1 + np.exp(-(x @ w + scorer.intercept)))
    gradient = (x / sd).T @ (p - y) / len(y) + 1e-3 * w * sd
    assert np.abs(gradient).max() < 1e-5 and abs((p - y).mean()) < 1e-5


def test_ranking_is_the_mean_absolute_contribution(fitted):
    df, _, scorer, x, _ = fitted
    rows = AT.attribute(df, scorer, ["SK_ID_CURR"], vector_to_array("features"))
    out = AT.ranking(rows, scorer, 3).collect()
    want = np.abs((x - x.mean(axis=0)) * np.array(scorer.coefficients)).mean(axis=0)
    order = np.argsort(-want)[:3]
    assert [r["feature"] for r in out] == ["abcd"[i] for i in order] and [r["rank"] for r in out] == [1, 2, 3]
    assert np.allclose([r["mean_abs"] for r in out], want[order])
    plan = AT.ranking(rows, scorer)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate") < plan.index("HashAggregate")  # printed from the top: nothing is exploded below the aggregate


def test_missing_and_infinite_values_contribute_nothing(spark):
    df = spark.createDataFrame([(1, None, 1.0), (2, float("nan"), 3.0), (3, float("inf"), 2.0), (4, 5.0, None), (5, 7.0, 2.0)], "k int, u double, v double")
    scorer = AT.from_scorecard(df, {"u": 2.0, "v": -1.0}, 0.5)
    assert scorer.means == (6.0, 2.0) and scorer.base == 0.5 + 12 - 2
    got = {r["k"]: r["contributions"] for r in AT.attribute(df, scorer, ["k"]).collect()}
    assert got == {1: [0.0, 1.0], 2: [0.0, -1.0], 3: [0.0, 0.0], 4: [-2.0, 0.0], 5: [2.0, 0.0]}
    empty = AT.from_scorecard(df.limit(0), {"u": 2.0}, 0.5)
    assert empty.means == (0.0,) and AT.attribute(df.limit(0), empty, ["k"]).count() == 0


def test_reasons_follow_signs_and_sides(spark):
    df = spark.createDataFrame([(1, 0.0, 9.0, 1.0), (2, 9.0, 0.0, 1.0), (3, 0.0, 0.0, 1.0), (4, None, 9.0, 1.0), (5, 9.0, 9.0, 1.0)], "k int, low double, high double, flat double")
    scorer = AT.LinearScorer(("low", "high", "flat"), (-1.0, 2.0, 3.0), 0.0, (4.0, 5.0, 1.0))
    reasons = [Reason("low", "low", "too low"), Reason("high", "high", "too high"), Reason("flat", "high", "never")]
    rows = AT.attribute(df.withColumn("values", AT.values_of(scorer)), scorer, ["k", "values"], F.col("values"))
    got = sorted(tuple(r) for r in AT.signed_reasons(rows, scorer, ["k"], reasons).collect())
    assert got == [(1, 1, "primary", "high", "too high", 8.0), (1, 2, "secondary", "low", "too low", 4.0), (3, 1, "primary", "low", "too low", 4.0),
                   (4, 1, "primary", "high", "too high", 8.0), (5, 1, "primary", "high", "too high", 8.0)]
    assert len(AT.signed_reasons(rows, scorer, ["k"], reasons, k=1).collect()) == 4
    # a feature whose push contradicts the stated side gives no reason
    assert AT.signed_reasons(rows, scorer, ["k"], [Reason("low", "high", "contradiction")]).count() == 0
    with pytest.raises(ValueError):
        AT.signed_reasons(rows, scorer, ["k"], [Reason("absent", "low", "")])
    plan = AT.signed_reasons(rows, scorer, ["k"], reasons)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


def test_reason_strengths_without_a_window(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0), (2, 3.0, 5.0), (3, None, 7.0), (4, math.nan, 6.0)], "SK_ID_CURR int, x double, y double")
    out = top_reasons(df, [Reason("y", "high", "Y"), Reason("x", "low", "X")])
    got = {(r["SK_ID_CURR"], r["reason_rank"]): (r["feature"], r["strength"]) for r in out.collect()}
    assert got[1, 1] == ("x", 1.0) and got[1, 2] == ("y", 0.0)
    assert got[2, 1] == ("x", 0.0) and got[2, 2] == ("y", 0.0)  # a tie goes by name
    assert got[3, 1] == ("y", 1.0) and got[3, 2] == ("x", None)
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()
