"""Chosen, fitted, written, loaded: the same scores; and a fit that stops early."""

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from conftest import SMALL_SF_DIR
from riskfeat.plans import catalog as C
from riskfeat.plans import lifecycle as LC
from riskfeat.plans import modeling as ML
from riskfeat.session import checkpoint


@pytest.fixture(scope="module")
def frame(spark):
    return checkpoint(C.feature_frame(spark, SMALL_SF_DIR, "train"))


def test_the_sql_stage_prepares_the_same_matrix(spark, frame):
    from pyspark.ml import Pipeline

    odd = frame.withColumn("OCCUPATION_TYPE", F.when(F.col("SK_ID_CURR") % 7 == 0, r"it's a \ x").otherwise(F.col("OCCUPATION_TYPE")))
    plan = ML.fit_matrix(odd)
    ours = Pipeline(stages=LC.matrix_stages(plan)).fit(odd).transform(odd)
    both = ours.select("SK_ID_CURR", F.col("features").alias("a")).join(ML.to_matrix(odd, plan).select("SK_ID_CURR", F.col("features").alias("b")), "SK_ID_CURR").collect()
    assert len(both) == odd.count() and all(r["a"].toArray().tolist() == r["b"].toArray().tolist() for r in both)


def test_a_loaded_model_scores_the_same(spark, frame, tmp_path):
    plan = ML.fit_matrix(frame)
    model = LC.fit_pipeline(frame, plan, lambda n: LogisticRegression(regParam=1.0 / n, maxIter=20), weighted=True)
    path = LC.save(model, str(tmp_path / "model"))
    test = C.feature_frame(spark, SMALL_SF_DIR, "test")
    want = {r[0]: r[1] for r in LC.score(model, test).collect()}
    other = spark.newSession()
    frame2 = other.read.parquet(_written(test, tmp_path))
    assert {r[0]: r[1] for r in LC.score(LC.load(path), frame2).collect()} == want and len(want) > 0
    assert all(0 < p < 1 for p in want.values())


def _written(df, tmp_path):
    df.write.parquet(str(tmp_path / "test"))
    return str(tmp_path / "test")


def test_choice_follows_the_folds(spark, frame, monkeypatch):
    """The better candidate is fitted, with weights only if they won."""
    plan = ML.fit_matrix(frame)
    matrix = checkpoint(ML.with_folds(ML.to_matrix(frame, plan)))
    settings = [{"n_estimators": r, "max_depth": 2, "learning_rate": 0.1, "subsample": 1.0, "colsample_bytree": 1.0, "min_child_samples": 1} for r in (2, 3)]
    for gain in (0.1, -0.1):
        monkeypatch.setattr(ML, "fit_fold", lambda m, f, make, resample=None, weighted=False, n=None: make(9).getMaxIter() / 10 + gain * weighted)
        model, params, weighted = LC.choose_and_fit(frame, matrix, plan, settings)
        assert params["n_estimators"] == 3 and weighted == (gain > 0)
        assert model.stages[-1].getNumTrees == 3 and model.stages[-1].isSet("weightCol") == weighted


def test_early_stopping_ends_before_the_last_round(spark):
    df = spark.range(3000).select(
        F.col("id").alias("SK_ID_CURR"), (F.pmod(F.hash("id"), F.lit(10)) < F.when(F.col("id") % 2 == 0, 2).otherwise(7)).cast("double").alias("TARGET"),
        F.array((F.col("id") % 2).cast("double"), F.pmod(F.hash("id", F.lit(3)), F.lit(50)).cast("double")).alias("x"))
    from pyspark.ml.functions import array_to_vector

    m = checkpoint(df.select("SK_ID_CURR", "TARGET", array_to_vector("x").alias("features")).coalesce(1))
    model = LC.fit_early_stopping(m, 30, depth=2, learning_rate=0.3)
    curve = LC.validation_curve(model, m).orderBy("round").collect()
    assert [r["round"] for r in curve] == list(range(1, model.getNumTrees + 1)) and model.getNumTrees < 30
    losses = [r["validation_loss"] for r in curve]
    assert min(losses) == losses[-1]  # the kept rounds end at the best one
    whole = ML._configure(ML.gbt(model.getNumTrees + 3, 2, 0.3), "TARGET", None).fit(LC.split_validation(m).where(~F.col("_valid")))
    longer = whole.evaluateEachIteration(LC.split_validation(m).where("_valid"))
    gain = losses[-1] - longer[model.getNumTrees]
    assert gain <= 0.01 * max(longer[model.getNumTrees], 0.01)  # the next round helps by less than the tolerance
