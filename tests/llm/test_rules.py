"""Line marks: base counts against plain counts, Viterbi and marginals against enumeration, edge rows."""

import itertools
import re

import numpy as np
from pyspark.sql import functions as F

from riskfeat.llm import queries, rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    seen = {}
    for i in range(len(w) - 7):
        seen.setdefault(tuple(w[i : i + 8]), []).append(i)
    covered = {i + j for p in seen.values() if len(p) > 1 for i in p for j in range(8)}
    n = len(w)
    return (n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), n < 20 or 100 * len(covered) > 30 * n)


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_query_counts_match_plain_counts_and_keep_good_texts(spark):
    d = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    out = queries.op7_quality_rules(spark, d)
    got = out.toPandas().set_index("doc_id")
    assert len(got) == len(texts)
    for i, t in texts.items():
        assert tuple(got.loc[i, COUNTS]) == base(t), i
    assert not (got.kept & got.base_failed).any()
    both = got.join(spark.read.parquet(f"{d}/labels.parquet").toPandas().set_index("doc_id"), how="inner")
    both = both[~both.base_failed]
    assert both[both.quality == 1].kept.mean() >= 0.98 and both[both.quality == 0].kept.mean() <= 0.05


def random_field(rng):
    return rules.Field(rng.normal(size=(rules.SIZE, 2)), rng.normal(size=(2, 2)), rng.normal(size=2))


def test_viterbi_and_marginals_match_enumeration():
    rng = np.random.default_rng(7)
    field = random_field(rng)
    lengths = [3, 1, 6, 2, 6, 4]
    row = np.repeat(np.arange(len(lengths)), lengths)
    emission = rng.normal(size=(len(row), 2))
    mark = rules.viterbi(emission, row, field)
    log_z, line, pair, start = rules.expectations(emission, row, field)
    z_sum, pair_sum, start_sum = 0.0, np.zeros((2, 2)), np.zeros(2)
    for r in range(len(lengths)):
        e = emission[row == r]
        score = lambda p: field.start[p[0]] + sum(e[i, s] for i, s in enumerate(p)) + sum(field.move[a, b] for a, b in zip(p, p[1:]))  # noqa: B023, E731
        paths = list(itertools.product((0, 1), repeat=len(e)))
        w = np.array([score(p) for p in paths])
        assert tuple(mark[row == r]) == paths[int(w.argmax())]
        prob = np.exp(w - np.logaddexp.reduce(w))
        z_sum += np.logaddexp.reduce(w)
        np.testing.assert_allclose(line[row == r][:, 1], [sum(q for p, q in zip(paths, prob) if p[i] == 1) for i in range(len(e))])
        for p, q in zip(paths, prob):
            start_sum[p[0]] += q
            for a, b in zip(p, p[1:]):
                pair_sum[a, b] += q
    assert np.isclose(log_z, z_sum)
    np.testing.assert_allclose(pair, pair_sum)
    np.testing.assert_allclose(start, start_sum)


def test_training_learns_runs():
    rng = np.random.default_rng(1)
    active, row, mark = [], [], []
    for r in range(200):
        state = int(rng.integers(2))
        for _ in range(8):
            state = state if rng.random() < 0.9 else 1 - state
            hint = state if rng.random() < 0.7 else 1 - state  # a weak sign in one measure
            active.append([b + (hint if i == 0 else 0) for i, b in enumerate(rules.BASE)])
            row.append(r)
            mark.append(state)
    active, row, mark = map(np.array, (active, row, mark))
    field = rules.train(active, row, mark)
    best = rules.viterbi(field.emit[active].sum(axis=1), row, field)
    alone = active[:, 0] - rules.BASE[0]
    assert (best == mark).mean() > (alone == mark).mean() + 0.03
    assert field.move[0, 0] > field.move[0, 1] and field.move[1, 1] > field.move[1, 0]


def test_edge_rows(spark):
    good = "A plain line of words that goes on for a while, as prose does.\n" + "And another one that says some more about the same thing, calmly.\n\n" + "The end of it comes here."
    junk = "\n".join(["BUY$$$ NOW$$$ ### &&& %%%", "*** | *** | ***"] * 6)
    texts = [None, "", " \n\t\n", good, junk, "w" * 300_000, "word " * 40_000, "\n" * 50_000 + "a b", good]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, good), (3, good)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_words", F.lit("mine")).withColumn("marks", F.lit(0))
    field = rules.fit(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    out = rules.judge(df, field).toPandas()
    assert len(out) == len(rows)
    by_id = out.set_index(out.doc_id.fillna(-1).astype(int))
    for i, t in enumerate(texts):
        r = by_id.loc[[i]].iloc[0]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base(t)[:5]
        assert r.n_lines == (t or "").count("\n") + 1 == len(r.marks)
    assert not by_id.loc[0].content and not by_id.loc[1].content and not by_id.loc[4].content
    assert by_id.loc[[3]].content.all() and by_id.loc[8].content and by_id.loc[-1].content
    assert rules.judge(df.limit(0), rules.fit(df.limit(0))).collect() == []


def test_copies_are_drawn_once(spark):
    hot = "A line that very many documents share, word for word.\nAnd its second line."
    df = spark.range(6000).select(F.when(F.col("id") % 3 == 0, hot).otherwise(F.concat(F.lit("text "), F.col("id") % 50, F.lit("\n\nof its own"))).alias("text"))
    got = rules.draw(df.repartition(8), max_rows=1000).toPandas()
    assert len(got) == got["key"].nunique() == 51  # all different texts, though there are more rows than max_rows
    assert set(got["n"]) == {2} and all(len(s) == 2 for s in got["seed"])
    assert 10 <= len(rules.draw(df, max_rows=25).toPandas()) <= 40
    assert len(rules.draw(df, max_lines=1).toPandas()) == 0  # texts longer than the line bound
    a, b = rules.fit(df), rules.fit(df.dropDuplicates())
    assert np.array_equal(a.emit, b.emit) and np.array_equal(a.move, b.move)
    assert rules.fit(df, max_lines=1).emit.shape == a.emit.shape
