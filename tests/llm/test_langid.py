"""Language identification: gradients by difference, a plain forward pass, held-out accuracy, edge rows."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from riskfeat.llm import langid, queries
from riskfeat.llm.textops import byte_view

D = "/root/testdata/sf0.01"


def wide(net):
    return langid.Net(*(w.astype(np.float64) for w in net.weights), net.langs)


def test_gradient_matches_differences():
    rng = np.random.default_rng(0)
    net = wide(langid.Net.fresh(3, ["a", "b", "c"]))
    x = rng.integers(97, 100, (5, 4)).astype(np.uint8)
    y = np.array([0, 2, 1, 1])
    real = np.ones((5, 4))
    real[3:, 1] = 0
    _, grads = net.gradient(x, y, real)
    for w, g in zip(net.weights, grads):
        for _ in range(12):
            at = tuple(rng.integers(0, s) for s in w.shape)
            if w.ndim == 3 and w.shape[1] == 256:
                at = (at[0], int(rng.integers(97, 100)), at[2])
            keep, eps = w[at], 1e-6
            w[at] = keep + eps
            up = net.gradient(x, y, real)[0]
            w[at] = keep - eps
            down = net.gradient(x, y, real)[0]
            w[at] = keep
            assert abs((up - down) / (2 * eps) - g[at]) < 1e-6


def test_states_match_a_plain_loop():
    net = wide(langid.Net.fresh(4, ["a", "b"]))
    text = b"some bytes"
    x = np.frombuffer(text, np.uint8)[:, None]
    got = net.label(net.states(x))[:, 0]
    sig = lambda v: 1 / (1 + np.exp(-v))
    both = []
    for d, seq in enumerate((text, text[::-1])):
        h, out = np.zeros(4), []
        for c in seq:
            a, g = net.e[d, c], h @ net.u[d]
            z, r = sig(a[:4] + g[:4]), sig(a[4:8] + g[4:8])
            n = np.tanh(a[8:] + r * g[8:])
            h = (1 - z) * n + z * h
            out.append(h)
        both.append(out if d == 0 else out[::-1])
    z = np.array([f @ net.v[0] + b @ net.v[1] + net.c for f, b in zip(*both)])
    p = np.exp(z - z.max(axis=1, keepdims=True))
    np.testing.assert_allclose(got, p / p.sum(axis=1, keepdims=True))


def test_held_out_accuracy(spark):
    out = queries.op1_language_id(spark, D)
    assert out.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("lang_pred", "string"), ("score", "double")]
    docs = spark.read.parquet(f"{D}/documents.parquet")
    rows = out.join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    held = rows[rows.held_out]
    assert (held.lang == held.lang_pred).mean() >= 0.98 and held.score.between(0, 1).all()
    assert len(rows) == docs.count()


def test_edge_rows(spark):
    de, en = "der ein und die schön nicht ist das wird auch über ", "the and that of with this is from are which "
    train = spark.createDataFrame([(i, (de if i % 2 else en) * 3, "de" if i % 2 else "en") for i in range(80)] + [(None, en, "de"), (90, en, None), (91, None, "xx")],
                                  "doc_id long, text string, lang string")
    net = langid.fit(train, F.lit(True), hidden=6, steps=120, batch=32)
    assert net.langs == ["de", "en"]
    rows = [(1, None), (2, ""), (3, "12 34 !!"), (4, de), (4, de), (None, en.upper()), (5, de * 4000), (6, "中"), (7, "ÄÖÜ"), (8, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("mine")).withColumn("lang_pred", F.lit("en"))
    got = langid.predict(df, net).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert [by[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and [by[i].score for i in (1, 2, 3)] == [0.0] * 3
    assert by[4].lang_pred == by[5].lang_pred == "de" and by[None].lang_pred == "en"
    assert all(by[i].lang_pred in net.langs and 0 < by[i].score <= 1 for i in (4, 5, 6, 7, 8))
    assert langid.predict(df.limit(0), net).collect() == []
    none = langid.fit(train.limit(0), F.lit(True))
    assert none is None and {r.lang_pred for r in langid.predict(df, none).collect()} == {"und"}


def test_segments_hold_every_byte_once():
    texts = ["", "abc", "x" * 10, "Ünd" * 7]
    data, offs = byte_view(pa.array(texts))
    row, seg, size = langid.cut(data, offs, 4)
    for i, t in enumerate(texts):
        assert b"".join(s[:n].tobytes() for r, s, n in zip(row, seg, size) if r == i) == t.encode()
    assert bytes(langid.fold_case(np.frombuffer("ÀÉÞ×ßÿZ".encode(), np.uint8))).decode() == "àéþ×ßÿz"
