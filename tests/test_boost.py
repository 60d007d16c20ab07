"""Boosting by one task against MLlib's, and the fits that go there."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector

from riskfeat.operators import boost as B
from riskfeat.plans import modeling as ML


def table(n: int, f: int = 7, seed: int = 3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, f))
    x[:, 0], x[:, 1], x[:, 2] = np.round(x[:, 0]), (x[:, 1] > 0.4), 0.0
    y = (x[:, 0] + x[:, 3] + rng.normal(size=n) > 1).astype(float)
    return x, y


def frame(spark, x, y):
    rows = [(i, float(t), 2.5 if t else 0.75, v) for i, (v, t) in enumerate(zip(x.tolist(), y))]
    df = spark.createDataFrame(rows, "SK_ID_CURR long, TARGET double, w double, a array<double>").coalesce(1)
    return df.select("SK_ID_CURR", "TARGET", "w", array_to_vector("a").alias("features")).cache()


@pytest.mark.parametrize(("setting", "weight"), [((5, 4, 0.2), None), ((6, 3, 0.1, 0.7, 0.6, 12), None), ((4, 3, 0.3), "w")])
def test_scores_are_those_of_the_distributed_learner(spark, setting, weight):
    df = frame(spark, *table(500))
    est = ML._configure(ML.gbt(*setting), "TARGET", weight)
    want = {r[0]: r[1] for r in ML.score(est.fit(df), df).select("SK_ID_CURR", "SCORE").collect()}
    model = B.fit(df, B.settings_of(est), "TARGET", weight)
    got = {r[0]: r[1] for r in ML.score(model, df.repartition(3)).select("SK_ID_CURR", "SCORE").collect()}
    assert got.keys() == want.keys() and max(abs(got[k] - want[k]) for k in got) < 1e-9 and len(set(want.values())) > 10
    # and the distributed learner's trees as they are read from its description
    read = {r[0]: r[1] for r in ML.score(B.of_mllib(est.fit(df)), df).select("SK_ID_CURR", "SCORE").collect()}
    assert max(abs(read[k] - want[k]) for k in read) < 1e-12


def test_random_numbers_are_the_jvms(spark):
    rng = spark._jvm.org.apache.spark.util.random.XORShiftRandom(-7)
    assert B.doubles(-7, 50).tolist() == [rng.nextDouble() for _ in range(50)]
    long, mine = spark._jvm.java.util.Random(5), B._Longs(5)
    assert [mine() for _ in range(5)] == [long.nextLong() & (2**64 - 1) for _ in range(5)]


def test_one_class_and_groups_of_nodes_beyond_the_memory(spark):
    x, y = table(300)
    s = B.settings_of(ML.gbt(3, 5, 0.1, 1.0, 0.7))
    whole = B.Model(list(B.learn(x, y, np.ones(300), s)), s.weights(), s.depth).margin(x)
    assert len(set(whole.tolist())) > 10
    flat = B.Model(list(B.learn(x, y * 0, np.ones(300), s)), s.weights(), s.depth).margin(x)
    assert len(set(flat.tolist())) == 1 and flat[0] < 0
    df = frame(spark, x, y)
    est = ML._configure(ML.gbt(3, 5, 0.1, 1.0, 1.0).setMaxMemoryInMB(0), "TARGET", None)  # one node at a time
    want = {r[0]: r[1] for r in ML.score(est.fit(df), df).select("SK_ID_CURR", "SCORE").collect()}
    got = {r[0]: r[1] for r in ML.score(B.fit(df, B.settings_of(est), "TARGET"), df).select("SK_ID_CURR", "SCORE").collect()}
    assert max(abs(got[k] - want[k]) for k in got) < 1e-9
    with pytest.raises(ValueError):
        list(B.learn(x, y + 1, np.ones(300), s))


def test_the_search_fits_few_rows_without_a_job_per_level(spark, monkeypatch):
    def no(*_a, **_k):
        raise AssertionError("a job per level")

    monkeypatch.setattr(ML.GBTClassifier, "fit", no)
    m = ML.with_folds(frame(spark, *table(240))).drop("w").coalesce(1).cache()
    space = dict(ML.SEARCH_SPACE, n_estimators=("randint", 3, 6), max_depth=("randint", 2, 4))
    found = ML.random_search(m, n_iter=3, space=space, parallelism=3)
    assert len(found) == 3 and all(0.5 < a <= 1 for r in found for a in r.fold_aucs)
    monkeypatch.setattr(B, "MAX_ROWS", 100)
    with pytest.raises(AssertionError):  # more rows are left to the distributed learner
        ML.random_search(m, n_iter=1, space=space, parallelism=1)
