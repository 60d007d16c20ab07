"""Toxicity: held-out accuracy, scores by hand, edge rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskfeat.llm import queries, toxicity

D = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    out = queries.op8_toxicity(spark, D)
    assert out.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    rows = out.join(spark.read.parquet(f"{D}/labels.parquet"), "doc_id").where("held_out").toPandas()
    # junk rows (quality 0) keep a toxic label after their words are gone
    hit = rows[(rows.toxic == 1) & (rows.quality == 1)].predicted.mean()
    false = rows[rows.toxic == 0].predicted.mean()
    assert hit >= 0.75 and false <= 0.02, (hit, false)
    assert out.count() == spark.read.parquet(f"{D}/documents.parquet").count()
    assert rows.score.between(0, 1).all()


def test_score_is_the_sum_over_present_grams(spark):
    g = toxicity._FOLD[np.frombuffer(b"abc", np.uint8)].astype(np.uint64)
    bucket = toxicity.gram_buckets(g, 3)
    model = toxicity.Model(-1.0, bucket, np.array([3.0]))
    rows = [(1, "xABCabc"), (2, "ab"), (3, "ab\nc"), (4, None), (5, ""), (6, "x" * 100_000 + "abc"), (6, "a"), (None, "abc")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("mine")).withColumn("doc", F.lit(0))
    got = sorted(((r.doc_id, round(r.score, 6)) for r in toxicity.score(df, model).collect()), key=repr)
    low, high = round(1 / (1 + np.exp(1)), 6), round(1 / (1 + np.exp(-2)), 6)
    assert got == sorted([(1, high), (2, low), (3, low), (4, low), (5, low), (6, high), (6, low), (None, high)], key=repr)


@pytest.mark.parametrize("toxic, expect", [([], 0.0), ([0, 0], 0.0), ([1, 1], 1.0)])
def test_one_class_or_no_labels(spark, toxic, expect):
    docs = spark.createDataFrame([(0, "a b c"), (1, None), (None, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, t) for i, t in enumerate(toxic)] + [(None, 1), (1, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, F.lit(True))
    assert [round(r.score, 9) for r in toxicity.score(docs, model).collect()] == [expect] * 3
    assert toxicity.score(docs.limit(0), model).collect() == []


def test_learns_a_planted_word(spark):
    rng = np.random.default_rng(1)
    words = ["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(200)]
    rows, lab = [], []
    for i in range(300):
        t = " ".join(rng.choice(words, int(rng.integers(5, 200))))
        if i % 5 == 0:
            t += " zzqk" + words[i % 7]
        rows.append((i, t))
        lab.append((i, int(i % 5 == 0)))
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(lab, "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, F.col("doc_id") < 200)
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert all((got[i] >= 0.7) == bool(y) for i, y in lab if i >= 200)


def test_many_informative_buckets_all_get_a_weight(spark):
    rng = np.random.default_rng(2)
    words = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 12)) for _ in range(700)]
    rows = [(i, " ".join(rng.permutation(words[350 * (i % 2) :][:350]))) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, F.lit(True))
    assert len(model.bucket) > 1 << 13, len(model.bucket)
