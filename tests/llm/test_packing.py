"""Packing: exact round trip, capacity, gapless offsets, near-equal windows, edge rows."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from riskfeat.llm import packing, queries

PATH = public_tokenizers.path("word_bpe_49k.json")
TOK = Tokenizer.from_file(PATH)


def check(rows, expect, capacity=2048):
    """rows: pieces with ids_crc32; expect: doc_id to whole texts."""
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_seq.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(expect)
    for d, text in expect.items():
        ids = TOK.encode(text or "", add_special_tokens=False).ids + [1]
        at = 0
        for p in sorted(by_doc[d], key=lambda p: p["start"]):
            assert p["start"] == at and p["length"] > 0 and p["doc_tokens"] == len(ids)
            got = np.array(ids[at : at + p["length"]], "<u4").tobytes()
            assert p["ids_crc32"] == zlib.crc32(got)
            at += p["length"]
        assert at == len(ids)
    for seq in by_seq.values():
        at = 0
        for p in sorted(seq, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= capacity
    sizes = [sum(p["length"] for p in s) for s in by_seq.values()]
    return sum(0 if s & (s - 1) == 0 else capacity - s for s in sizes) / max(1, sum(sizes))


def test_query_round_trip(spark):
    d = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    rows = [r.asDict() for r in queries.op9_packing(spark, d).collect()]
    assert check(rows, docs) == 0


def test_edge_rows(spark):
    texts = [None, "", " \n", "a", "x" * 50_000, "word " * 30_000, "<|endoftext|> and <|startoftext|>x", "É é    b ΑΣ. İ", "'s't i've 12 3.4!!"]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as row", "2 as start", "'x' as ids")
    out = queries.pack_digest(packing.pack(df, PATH, 1))
    assert check([r.asDict() for r in out.collect()], dict(rows)) == 0
    assert queries.pack_digest(packing.pack(df.limit(0), PATH, 1)).collect() == []
    again = spark.createDataFrame([(None, "one two"), (None, "one two"), (3, "one two"), (3, "one two")], "doc_id long, text string")
    got = queries.pack_digest(packing.pack(again, PATH, 1)).collect()
    assert sum(r.length for r in got) == 4 * 3 and {r.doc_id for r in got} == {None, 3}


@given(st.text(alphabet=st.sampled_from(list("aZ é́'sS\n\t \x1c1٣ß<|>Σςẛ̣한")), max_size=60))
@settings(max_examples=300, deadline=None)
def test_chunks_equal_whole_text(text):
    data = np.frombuffer(text.encode(), np.uint8)
    got, n = packing.encoder(PATH).encode(data, np.array([0, len(data)]), 1)
    assert n.tolist() == [len(got)]
    assert got.tolist() == TOK.encode(text, add_special_tokens=False).ids + [1]


@given(st.lists(st.integers(1, 64), min_size=1, max_size=60), st.integers(1, 9))
@settings(max_examples=200, deadline=None)
def test_differencing_is_a_partition(sizes, windows):
    part = packing.differencing(np.array(sizes), windows)
    assert len(part) == len(sizes) and part.min() >= 0 and part.max() < windows
    load = np.bincount(part, weights=sizes, minlength=windows)
    assert load.max() - load.min() <= max(sizes)


@pytest.mark.parametrize("cut", [True, False])
def test_group_keeps_every_token(cut):
    rng = np.random.default_rng(3)
    pieces = [(i, 0, int(n)) for i, n in enumerate(rng.integers(1, 2048, 400))]
    out = packing.pack_group(pieces, 2048, cut)
    assert max(sum(p[2] for p in s) for s in out) <= 2048
    seen = sorted(p for s in out for p in s)
    for i, _, n in pieces:
        own = [(a, b) for r, a, b in seen if r == i]
        assert own[0][0] == 0 and own[-1][0] + own[-1][1] == n
        assert all(a + b == c for (a, b), (c, _) in zip(own, own[1:]))
        assert cut or len(own) == 1
