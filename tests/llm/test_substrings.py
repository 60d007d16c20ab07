"""Repeated substrings against brute force; longest previous factors against their definition."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskfeat.llm import lpf, queries, substrings


def brute(docs, length=200, keep="none"):
    """docs: (doc, text) rows, in order of id."""
    starts = {}
    raws = [(t or "").encode() for _, t in docs]
    for i, raw in enumerate(raws):
        for p in range(len(raw) - length + 1):
            starts.setdefault(raw[p : p + length], []).append((i, p))
    out = []
    mask = [bytearray(len(r)) for r in raws]
    for places in starts.values():
        if len(places) > 1:
            for i, p in places if keep == "none" else places[1:]:
                mask[i][p : p + length] = b"\x01" * length
    for (d, _), raw, m in zip(docs, raws, mask):
        kept = bytes(b for b, x in zip(raw, m) if not x)
        spans = sum(1 for j in range(len(m)) if m[j] and (j == 0 or not m[j - 1]))
        out.append((d, len(raw), sum(m), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in queries.repeats_digest(df).collect()), key=repr)


def test_query_matches_brute_force(spark):
    d = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    found = sorted((tuple(r) for r in queries.op10_substrings(spark, d).collect()), key=repr)
    assert found == brute(rows) and sum(r[2] for r in found)


def planted():
    rng = random.Random(11)
    prose = lambda n: " ".join("".join(rng.choices("abcdeé", k=rng.randrange(2, 8))) for _ in range(n))
    shared = [prose(60), prose(400), prose(45)]
    docs = []
    for i in range(40):
        parts = [prose(rng.choice([1, 30, 300]))]
        for s in rng.sample(shared, rng.randrange(0, 3)):
            cut = rng.randrange(len(s) // 2)
            parts += [s[cut : cut + rng.randrange(150, 900)], prose(20)]
        docs.append((i, " ".join(parts)))
    docs += [(40, docs[3][1]), (41, docs[3][1][:-1]), (42, "x" * 900), (43, "x" * 450 + "y"), (44, "ab" * 300), (45, shared[1] * 3), (46, "q" * 199), (47, None), (48, "")]
    return docs


@pytest.mark.parametrize("keep", ["none", "first"])
@pytest.mark.parametrize("hot, bits", [(1000, 1 << 20), (2, 1 << 20), (1000, 1 << 8)])
def test_planted_repeats(spark, monkeypatch, keep, hot, bits):
    monkeypatch.setattr(substrings, "HOT", hot)
    docs = planted()
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("h", F.lit("mine")).withColumn("id", F.lit(0))
    assert got(substrings.remove_repeats(df.repartition(3), keep=keep, filter_bits=bits)) == brute(docs, keep=keep)


def test_edge_rows(spark):
    a, b = "long text " * 40, "".join(chr(97 + i * i % 26) for i in range(500))
    docs = [(None, b), (None, b), (3, b), (3, b), (4, "short"), (5, a), (6, None), (-1, b[:250])]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert got(substrings.remove_repeats(df, keep="none", filter_bits=1 << 16)) == brute(docs)
    assert substrings.remove_repeats(df.limit(0), filter_bits=1 << 16).collect() == []
    # a text longer than what is looked at at once
    big = "".join(random.Random(2).choices("abcdefgh ", k=90_000))
    docs = [(1, big + "z" + big[1000:1900]), (2, "k" + big[80_000:80_300])]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert got(substrings.remove_repeats(df, keep="first", filter_bits=1 << 16)) == brute(docs, keep="first")


def test_anchors_agree_across_chunks(monkeypatch):
    data = np.frombuffer(bytes(random.Random(4).choices(b"abc", k=5000)), np.uint8)
    whole = substrings.anchors(data, 200)
    monkeypatch.setattr(substrings, "CHUNK", 300)
    parts = substrings.anchors(data, 200)
    assert all((x == y).all() for x, y in zip(whole, parts))
    # every window holds one of its anchors
    pos, _, first, last = whole
    # every window has one anchor, and holds it
    assert first[0] == 0 and last[-1] == len(data) - 200 and (first[1:] == last[:-1] + 1).all()
    assert (pos >= last).all() and (pos <= first + 200 - substrings.GRAM).all()


@given(st.lists(st.integers(0, 3), max_size=60), st.sampled_from([8, 11, 16, 20]), st.randoms())
@settings(max_examples=300, deadline=None)
def test_previous_factors(codes, length, rnd):
    data = np.array(codes, np.uint8)
    starts = np.array([i for i in range(max(0, len(data) - length + 1)) if rnd.random() < 0.8], np.int64)
    back = lpf.previous_factor(data, starts, length)
    for i, b in zip(starts.tolist(), back.tolist()):
        same = [j for j in starts.tolist() if j < i and (data[j : j + length] == data[i : i + length]).all()]
        assert b in same if same else b == -1
