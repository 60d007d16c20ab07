"""Language model against a plain re-computation, normalisation, long and edge rows."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskfeat.llm import lm, queries
from riskfeat.llm import textops as tx


def tokens(text):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (text or ""))
    for c in "\t\n\x0b\x0c\r":
        t = t.replace(c, " ")
    return [w for w in t.split(" ") if w] + [None]  # None: the end


def brute(rows):
    """rows: (doc, text, held)."""
    uni, bi, left = Counter(), Counter(), Counter()
    for _, t, held in rows:
        if not held:
            w = tokens(t)
            uni.update(w)
            pairs = list(zip(["<s>", *w], w))
            bi.update(pairs)
            left.update(h for h, _ in pairs)
    n, v = sum(uni.values()), len(uni)
    d = n + 0.5 * (v + 1)

    def p(h, w, k, minus=0):
        base = (max(uni[w] - minus, 0) + 0.5) / (max(n - minus, 0) + 0.5 * (v + 1))
        if left[h] == 0:
            return base
        return (max(bi[h, w] - minus, 0) + k * base) / (max(left[h] - minus, 0) + k)

    def loo(k):
        return sum(math.log10(p(h, w, k, 1)) for _, t, held in rows if not held for h, w in zip(["<s>", *tokens(t)], tokens(t)))

    k = max(lm.PRIORS, key=loo) if n else None
    out = []
    for doc, t, held in rows:
        w = tokens(t)
        base = sum(math.log10((uni[x] + 0.5) / d) for x in w)
        s = sum(math.log10(p(h, x, k)) for h, x in zip(["<s>", *w], w)) if n else base
        out.append((doc, held, len(w), sum(uni[x] > 0 for x in w), n, base, s))
    return out


def same(got, expect):
    key = lambda r: (repr(r[0]), r[2], round(r[5], 3), round(r[6], 3))
    got, expect = sorted(got, key=key), sorted(expect, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in expect]
    np.testing.assert_allclose([r[5:] for r in got], [r[5:] for r in expect], rtol=1e-9, atol=1e-9)


COLS = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]


def run(df, held):
    return [tuple(r) for r in lm.score(df, held).select(COLS).collect()]


def test_query_matches_plain_computation(spark):
    d = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text, zlib.crc32(str(r.doc_id).encode()) % 5 == 1) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    out = queries.op2_language_model(spark, d)
    got = [tuple(r) for r in out.select(COLS).collect()]
    same(got, brute(rows))
    # better than the base on texts it has not seen
    held = [r for r in got if r[1]]
    assert sum(r[6] for r in held) > sum(r[5] for r in held)


@pytest.mark.parametrize("block, step", [(1 << 19, 1 << 18), (7, 3)])
def test_blocks_and_edge_rows(spark, monkeypatch, block, step):
    monkeypatch.setattr(lm, "BLOCK_TOKENS", block)
    monkeypatch.setattr(lm, "STEP", step)
    monkeypatch.setattr(lm, "BUCKET_KEYS", 16)
    rows = [(1, "The cat sat on the mat", False), (2, "the cat SAT on a dog\n\nthe end", False), (3, None, False), (3, "", True), (4, "the cat zzz sat on", True),
            (None, "the cat", False), (5, "the cat", True), (5, "the cat", True), (6, "word " * 60 + "ä\x1cö", False), (7, "y" * 50_000, True)]
    df = spark.createDataFrame(rows, "doc_id long, text string, out boolean").withColumn("uid", F.lit("mine")).withColumn("n", F.lit(0))
    same(run(df, F.col("out")), brute(rows))
    assert run(df.limit(0), F.col("out")) == []
    none = [(d, t, True) for d, t, _ in rows]
    same(run(df, F.lit(True)), brute(none))


def test_counts_beyond_32_bits():
    """Two blocks that hold a word three thousand million times each."""
    import pyarrow as pa

    keys = np.array([5, 1 << 60], np.uint64)
    ask = lambda block, counts: {"kind": 1, "bucket": 0, "block": block, "keys": lm._pack_keys(keys), "counts": tx.pack(np.array(counts, "<u4"))}
    got = lm._add_up(pa.Table.from_pylist([ask(0, [3_000_000_000, 1]), ask(1, [3_000_000_000, 0])], schema=lm._ASK)).to_pylist()
    assert [lm._unpack_totals(r["counts"]).tolist() for r in got] == [[6_000_000_000, 1]] * 2
    assert got[0]["total"] == 6_000_000_001 and got[0]["kinds"] == 2
    assert lm._unpack_totals(lm._pack_totals(np.zeros(0, np.int64))).tolist() == []
