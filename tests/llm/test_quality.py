"""Text measures against plain counts; the additive model's accuracy, form and edge rows."""

import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskfeat.llm import measures, quality, queries
from riskfeat.llm.textops import byte_view

D = "/root/testdata/sf0.1"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    """n_words, n_lines, repeated lines, words in repeated 3-word windows, distinct words, words after themselves, symbols."""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    wins = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    covered = {i + j for i, x in enumerate(wins) if wins.count(x) > 1 for j in range(3)}
    return (len(w), text.count("\n") + 1, len(lines) - len(set(lines)), len(covered), len(set(w)),
            sum(a == b for a, b in zip(w, w[1:])), sum(c in "#*$%&|<>" for c in text))


@given(st.lists(st.text(alphabet=st.sampled_from(list("ab \n\t#é\x1c")), max_size=30), min_size=1, max_size=6))
@settings(max_examples=300, deadline=None)
def test_measures_match_plain_counts(texts):
    t = measures.Texts(*byte_view(pa.array(texts)))
    dup = np.bincount(t.line_row[t.repeated_lines()], minlength=t.rows)
    again = np.bincount(t.row[t.after_itself()], minlength=t.rows)
    got = zip(t.n_words, t.n_lines, dup, t.repeated_words(3), t.distinct_words(), again, t.kinds()[:, measures.SYMBOL])
    assert [tuple(map(int, g)) for g in got] == [plain(x) for x in texts]
    lines = [x for text in texts for x in text.split("\n")]
    assert t.line_words.tolist() == [len(WORD.findall(x)) for x in lines]
    assert t.kinds(by_line=True).sum(axis=1).tolist() == [len(x.encode()) for x in lines]


def test_held_out_accuracy(spark):
    out = queries.op6_quality(spark, D)
    assert out.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    rows = out.join(spark.read.parquet(f"{D}/labels.parquet"), "doc_id").where("held_out").toPandas()
    assert rows[rows.quality == 1].predicted.mean() >= 0.99 and rows[rows.quality == 0].predicted.mean() <= 0.05
    assert rows.score.between(0, 1).all()
    assert out.count() == spark.read.parquet(f"{D}/documents.parquet").count()


def test_score_is_a_sum_of_table_entries_and_learns_a_pair():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)  # no single feature tells
    m = quality.train(x, y, rounds=20, pairs=1)
    assert {m.pairs[0][0], m.pairs[0][1]} == {0, 1}
    assert ((m.score(x) > 0.5) == y).mean() > 0.95
    one = x[:1]
    by_hand = m.bias + sum(t[np.searchsorted(e, one[0, f], side="right")] for f, (e, t) in enumerate(zip(m.edges, m.tables)))
    by_hand += sum(t[np.searchsorted(m.coarse[i], one[0, i], side="right"), np.searchsorted(m.coarse[j], one[0, j], side="right")] for i, j, t in m.pairs)
    assert m.logit(one)[0] == pytest.approx(by_hand)


@pytest.mark.parametrize("marks, expect", [([], 1.0), ([0, 0], 0.0), ([1, 1], 1.0)])
def test_edge_rows(spark, marks, expect):
    docs = spark.createDataFrame([(0, "a b c"), (1, None), (1, ""), (None, "x\n" * 30_000), (2, "y" * 200_000)], "doc_id long, text string").withColumn("score", F.lit("mine"))
    labels = spark.createDataFrame([(i, t) for i, t in enumerate(marks)] + [(None, 1), (1, None)], "doc_id long, quality int")
    model = quality.fit(docs, labels, F.lit(True))
    assert [round(r.score, 9) for r in quality.score(docs, model).collect()] == [expect] * 5
    assert quality.score(docs.limit(0), model).collect() == []
    both = spark.createDataFrame([(0, 0), (1, 1)], "doc_id long, quality int")
    got = quality.score(docs, quality.fit(docs, both, F.lit(True))).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
