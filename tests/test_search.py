"""The search ledger: a stopped search goes on where it was."""

import math

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from riskfeat.plans import modeling as ML
from riskfeat.plans import search


@pytest.fixture(scope="module")
def matrix(spark):
    df = spark.range(240).select(
        F.col("id").alias("SK_ID_CURR"), (F.col("id") % 5 == 0).cast("double").alias("TARGET"), (F.col("id") % 3).cast("int").alias("fold"),
        array_to_vector(F.array((F.col("id") % 5).cast("double"), F.pmod(F.hash("id"), F.lit(7)).cast("double"))).alias("features"))
    return df.cache()


def quick(p):
    return lambda n: LogisticRegression(regParam=p["learning_rate"], elasticNetParam=p["reg_alpha"], maxIter=3)


def test_a_stopped_search_fits_only_the_rest(matrix, tmp_path, monkeypatch):
    whole = ML.random_search(matrix, n_iter=6, parallelism=2, make_of=quick)
    real, calls = ML.fit_fold, []

    def stops_after_five(*a, **k):
        if len(calls) == 5:
            raise KeyboardInterrupt
        calls.append(1)
        return real(*a, **k)

    root = str(tmp_path / "ledger")
    monkeypatch.setattr(ML, "fit_fold", stops_after_five)
    with pytest.raises(KeyboardInterrupt):
        ML.random_search(matrix, n_iter=6, parallelism=1, make_of=quick, ledger_root=root)
    monkeypatch.setattr(ML, "fit_fold", lambda *a, **k: calls.append(1) or real(*a, **k))
    again = ML.random_search(matrix, n_iter=6, parallelism=3, make_of=quick, ledger_root=root)
    assert len(calls) == 18  # 5 before, 13 after: no fit twice
    assert [(r.name, r.fold_aucs) for r in again] == [(r.name, r.fold_aucs) for r in whole]
    ledger = ML.search_ledger(matrix, ML.draw_params(6), 3, root)
    ranked = {r["candidate"]: (r["rank"], r["mean_auc"]) for r in search.rank_fits(ledger.table()).collect()}
    want = {r["model"]: r["rank"] for r in ML.ranked_candidates(matrix.sparkSession, whole).collect()}
    assert {f"candidate_{c}": r for c, (r, _) in ranked.items()} == want
    third = ML.random_search(matrix, n_iter=6, parallelism=3, make_of=quick, ledger_root=root)
    assert len(calls) == 18 and [r.fold_aucs for r in third] == [r.fold_aucs for r in whole]


def test_other_data_or_draws_do_not_share_a_ledger(matrix, tmp_path):
    draws = ML.draw_params(2)
    names = {ML.search_ledger(m, d, k, str(tmp_path)).folder for m, d, k in (
        (matrix, draws, 3), (matrix.where("SK_ID_CURR > 0"), draws, 3), (matrix, ML.draw_params(3), 3), (matrix, draws, 2),
        (matrix.withColumn("TARGET", 1 - F.col("TARGET")), draws, 3))}
    assert len(names) == 5
    assert ML.search_ledger(matrix.repartition(7), draws, 3, str(tmp_path)).folder in names


def test_ranks_and_folds_without_an_auc(spark, tmp_path):
    ledger = search.Ledger(spark, str(tmp_path), "x")
    assert ledger.finished() == {}
    for c, f, auc in [(0, 0, 0.5), (0, 1, 0.7), (1, 0, 0.6), (1, 1, 0.6), (2, 0, math.nan), (2, 1, 0.9), (3, 0, 0.1), (3, 1, 0.1)]:
        ledger.record(c, f, auc, {"p": c})
    done = ledger.finished()
    assert len(done) == 8 and math.isnan(done[2, 0])
    got = {r["candidate"]: (r["folds"], round(r["mean_auc"], 12), round(r["std_auc"], 12), r["rank"]) for r in search.rank_fits(ledger.table()).collect()}
    assert got == {2: (1, 0.9, 0.0, 1), 0: (2, 0.6, 0.1, 2), 1: (2, 0.6, 0.0, 2), 3: (2, 0.1, 0.0, 4)}
