"""Periodic runs against a search of every lag of every text."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskfeat.llm import periodic, queries
from riskfeat.llm import textops as tx

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words, least=12):
    out = []
    n = len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            s = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i - s + q
            if length >= max(least, 2 * q) and not any(all(words[x] == words[x + p] for x in range(s, s + length - p)) for p in _divisors(q)):
                out.append((s, length, q))
            i += i == s
    return sorted(out, key=lambda r: (r[0], r[2]))


def _divisors(q):
    return [p for p in range(1, q) if q % p == 0]


def collapsed(words, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def strings(rnd):
    """Word lists rich in runs: random, nested, Fibonacci, Thue-Morse, two runs of one period side by side."""
    u = [rnd.randrange(3) for _ in range(rnd.randrange(1, 90))]
    a = [rnd.randrange(2) for _ in range(rnd.randrange(1, 6))] * rnd.randrange(1, 15) + [7] * rnd.randrange(3)
    x, y = [0], [0, 1]
    while len(y) < 350:
        x, y = y, y + x
    t = [0]
    while len(t) < 64:
        t += [1 - z for z in t]
    p = [rnd.randrange(3) for _ in range(rnd.randrange(1, 4))]
    yield [rnd.randrange(2) for _ in range(rnd.randrange(200))]
    yield [5] * rnd.randrange(10) + u * rnd.randrange(1, 6) + u[: rnd.randrange(len(u))] + [6, 5]
    yield (a * rnd.randrange(1, 6))[:400]
    yield y[: rnd.randrange(100, 350)]
    yield t * rnd.randrange(1, 5)
    yield (p * rnd.randrange(1, 60) + p[: rnd.randrange(len(p))] + p * rnd.randrange(1, 60))[:350]
    yield [0] * rnd.randrange(1, 90) + [1] * rnd.randrange(3) + [0] * rnd.randrange(1, 90) + [1]
    yield []


@pytest.mark.parametrize("scale", [2, 3, 5])
def test_all_runs_at_every_scale(monkeypatch, scale):
    monkeypatch.setattr(periodic, "FIRST_SCALE", scale)
    monkeypatch.setattr(periodic, "SHORT", 1 << scale)
    rnd = random.Random(scale)
    for _ in range(12):
        docs = list(strings(rnd))
        rnd.shuffle(docs)
        row = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
        w = periodic.Words(tx.mix64(np.array([z for d in docs for z in d], np.uint64) + np.uint64(1)), row, len(docs))
        got = [[] for _ in docs]
        for s, n, q in zip(*periodic.runs(w), strict=True):
            got[row[s]].append((int(s - w.first[row[s]]), int(n), int(q)))
        assert got == [brute(d) for d in docs]


def test_long_periods_and_few_seeds():
    """A period of 3,000 words is found; a long run of one word does not make pairs of all its places."""
    rnd = np.random.default_rng(3)
    u = rnd.integers(0, 1 << 60, 3000).astype(np.uint64)
    words = np.concatenate([rnd.integers(0, 9, 50).astype(np.uint64), u, u, u[:700], np.zeros(30_000, np.uint64), [np.uint64(4)], np.zeros(20_000, np.uint64)])
    w = periodic.Words(tx.mix64(words), np.zeros(len(words), np.int64), 1)
    found = {(int(n), int(q)) for _, n, q in zip(*periodic.runs(w), strict=True)}
    assert {(6700, 3000), (30_000, 1), (20_000, 1)} <= found
    # zeros, a four, zeros: 20,001 words apart the zeros of both sides are equal
    assert all(len(periodic.seeds(w, j)[0]) < 4 * len(words) for j in range(5, 16))


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def result(df):
    return sorted(((r["id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in df.collect()), key=str)


def test_edges(spark):
    line = "la le li lo lu ma me mi mo mu na ne ni\n"
    texts = [(1, line * 3), (1, line * 3), (2, None), (None, "ha " * 20), (3, ""), (4, " \t\n"), (5, "ha " * 11), (6, "\x0bha\x0c" * 12), (7, "é x " * 12 + "y"), (8, line * 9000)]
    docs = frame(spark, texts)
    for c in ("id", "runs", "collapsed", "n_words", "row"):
        docs = docs.withColumn(c, F.lit("x"))
    want = []
    for i, t in texts:
        words = WORD.findall(t or "")
        found = brute(words) if len(words) < 1000 else [(0, len(words), 13)]
        want.append((i, len(words), found, collapsed(words, found)))
    assert result(periodic.collapse_runs(docs.repartition(3))) == sorted(want, key=str)
    assert result(periodic.collapse_runs(frame(spark, []))) == []


def test_query_against_brute_force(spark):
    """The registered query, the contract's planted repeats included, on whole small texts."""
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()
    want, planted = [], 0
    for i, text in docs:
        words = WORD.findall(text or "")
        h = zlib.crc32(str(i).encode())
        if len(words) > 3000:
            continue
        if h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]
            planted += 1
        found = brute(words)
        best = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=None)
        want.append((
            i, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()).hexdigest(), hashlib.sha256(collapsed(words, found).encode()).hexdigest(),
        ))
    got = {tuple(r) for r in queries.QUERIES["op11_periodic_runs"](spark, d).collect()}
    assert planted > 5 and set(want) <= got and len(got) == len(docs)
    assert sum(r[1] for r in want) > planted / 2
