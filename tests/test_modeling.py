"""Modelling layer on the smallest fixture with fast learners."""

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from conftest import SMALL_SF_DIR
from riskfeat.plans import catalog as C
from riskfeat.plans import modeling as ML


@pytest.fixture(scope="module")
def matrix(spark):
    frame = C.feature_frame(spark, SMALL_SF_DIR, "train")
    plan = ML.fit_matrix(frame)
    from riskfeat.session import checkpoint

    return checkpoint(ML.with_folds(ML.to_matrix(frame, plan))), plan, frame


def test_matrix_has_no_missing_and_all_features(matrix):
    m, plan, frame = matrix
    assert m.count() == frame.count()
    arr = m.select(F.size(vector_to_array("features")).alias("n")).distinct().collect()
    assert [r["n"] for r in arr] == [len(plan.features)]
    bad = m.select(F.explode(vector_to_array("features")).alias("v")).where(
        F.isnan("v") | F.col("v").isNull() | (F.abs("v") == float("inf"))).count()
    assert bad == 0


def test_cross_validation_and_arms(matrix):
    m, _, _ = matrix

    def make(n):
        return LogisticRegression(regParam=1.0 / n, maxIter=50)

    res = ML.run_grid(m, [("lr", make, ML.resample_none, False, {}),
                          ("lr_weighted", make, ML.resample_none, True, {}),
                          ("lr_under", make, ML.resample_undersample, False, {})], k=3, parallelism=3)
    for r in res:
        assert len(r.fold_aucs) == 3 and all(0.0 <= a <= 1.0 for a in r.fold_aucs)
        assert r.std >= 0.0
    frame = ML.results_frame(m.sparkSession, res, baseline=res[0].mean)
    assert frame.where("model = 'lr'").first()["delta_vs_baseline"] == 0.0


def test_search_draws_follow_the_space():
    draws = ML.draw_params(50, seed=7)
    assert all(100 <= d["n_estimators"] < 500 and 3 <= d["max_depth"] < 10 for d in draws)
    assert all(0.01 <= d["learning_rate"] < 0.21 and 0.6 <= d["subsample"] < 1.0 for d in draws)
    assert ML.draw_params(3, seed=7) == draws[:3]


def test_final_fit_scores_test_frame(spark, matrix):
    m, plan, _ = matrix
    model = ML.fit_final(m, lambda n: LogisticRegression(regParam=1.0 / n, maxIter=50), weighted=True)
    test = ML.to_matrix(C.feature_frame(spark, SMALL_SF_DIR, "test"), plan)
    scored = ML.score(model, test)
    assert scored.count() == test.count()
    assert scored.where("SCORE < 0 OR SCORE > 1 OR SCORE IS NULL").count() == 0


def test_learners_get_one_partition_per_core_at_most(spark):
    """Tree counts are shuffled per partition: their number must not grow with the table, nor exceed a sample's need."""
    rows = spark.range(0, 2000, 1, 60)
    cores = spark.sparkContext.defaultParallelism
    for n, want in ((None, 1), (10 * ML.ROWS_PER_TASK, min(cores, 10)), (10**9, cores)):
        got = ML.for_learning(rows, n)
        assert got.rdd.getNumPartitions() == want and got.agg(F.sum("id")).first()[0] == 1999000
    odd = spark.range(0, 300, 1, 40).select(F.col("id").alias("SK_ID_CURR"), (F.col("id") % 7 == 0).cast("double").alias("TARGET"), F.array(F.lit(1.0)).alias("features"))
    assert C.tuning_sample(odd.withColumn("fold", F.lit(0)), 100).rdd.getNumPartitions() == 1
