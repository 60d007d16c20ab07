"""Ranked search against scores of all documents."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskfeat.llm import ranked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    bags = [(i, Counter(words(t))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n, total = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scored = []
        for i, b in bags:
            m = 25 + 75 * sum(b.values()) * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * b[t] // (1000 * b[t] + 8 * m)) for t in words(text) if t in b)
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def tables(spark, docs, items):
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")


def corpus(seed, n=300):
    rnd = random.Random(seed)
    vocab = ["the", "a", "É", "x1", "Über", "and"] + [f"w{i}" for i in range(40)]
    some = lambda m: " ".join(rnd.choice(vocab[: rnd.choice([6, 46])]) for _ in range(rnd.randrange(m)))
    docs = [(rnd.choice([i, i, i, 7, None]), some(30)) for i in range(n)] + [(i, "the same text, x1") for i in range(40)] + [(90, None), (91, ""), (92, "--- ..")]
    items = [(i, some(12)) for i in range(25)] + [(3, "x1 X1 the"), (3, "same Text"), (None, "über"), (5, None), (6, ""), (7, "absent"), (8, "-"), (9, "x1-x1_x1\x7fx1")]
    rnd.shuffle(docs)
    return docs, items


@pytest.mark.parametrize("sizes", [(1, 1, 1), (200, 30, 7), (1 << 20, 1 << 16, 1 << 12)])
def test_equals_brute_force_whatever_the_blocks(spark, sizes):
    docs, items = corpus(sum(sizes))
    if sizes[1] == 1:
        items = items[-10:]  # an item at a time
    d, q = tables(spark, docs, items)
    out = ranked.search(d.repartition(4), q, block_postings=sizes[0], block_terms=sizes[1], block_items=sizes[2])
    assert rows(out) == brute(docs, items)


def test_ties_go_to_the_smaller_id_and_null_ids_come_last(spark):
    docs = [(i, "alpha beta") for i in range(30, 0, -1)] + [(None, "alpha beta")] * 3 + [(0, "gamma delta")] * 60
    d, q = tables(spark, docs, [(1, "alpha")])
    assert [r[2] for r in sorted(ranked.search(d.repartition(9), q).collect(), key=lambda r: r["rank"])] == list(range(1, 11))
    few = [(None, "alpha beta")] * 3 + [(4, "alpha beta"), (4, "alpha beta")] + [(0, "gamma delta")] * 9
    d, q = tables(spark, few, [(1, "alpha")])
    assert [r[2] for r in sorted(ranked.search(d, q).collect(), key=lambda r: r["rank"])] == [4, 4, None, None, None]


def test_no_rows_where_nothing_can_match(spark):
    docs, items = corpus(1, 5)
    d, q = tables(spark, docs, items)
    none_d, none_q = tables(spark, [], [])
    silent, _ = tables(spark, [(1, None), (2, " .")], [])
    for a, b in ((none_d, q), (d, none_q), (silent, q)):
        assert rows(ranked.search(a, b)) == []


def test_clashing_columns_and_long_texts(spark):
    docs = [(1, "needle " + "hay " * 200_000), (2, "needle"), (3, "hay " * 50)] + [(i, "straw") for i in range(4, 20)]
    items = [(1, "needle hay"), (2, "hay")]
    d, q = tables(spark, docs, items)
    for c in ("doc", "item", "seq", "score", "rank", "way", "r", "k", "n"):
        d, q = d.withColumn(c, F.lit("x")), q.withColumn(c, F.lit("x"))
    assert rows(ranked.search(d, q)) == brute(docs, items)


def test_reading_stops_early_and_only_strictly_below_the_kth():
    """Rare term first: few documents are looked up; with all scores equal every place must be seen."""
    rng = np.random.default_rng(2)
    n = 20_000
    ids, no_id = np.arange(n), np.zeros(n, bool)
    doc, term = np.repeat(np.arange(n), 2), np.tile([0, 1], n)
    block = ranked.Block(n, doc, term, rng.integers(1, 1 << 30, 2 * n), 2)
    top = ranked.Top(10)
    looked = block.best(np.array([0, 1]), np.array([1, 3]), (ids, no_id), top)
    total = block.impact[0::2] + 3 * block.impact[1::2]
    assert top.score.tolist() == sorted(total.tolist(), reverse=True)[:10]
    assert looked < n / 4
    # equal impacts: the most an unseen document can score never falls below the k-th
    flat = ranked.Block(n, doc, term, np.full(2 * n, 5), 2)
    top = ranked.Top(10)
    assert flat.best(np.array([0, 1]), np.array([1, 1]), (ids[::-1].copy(), no_id), top) == n
    assert top.id.tolist() == list(range(10))


def test_norms_beyond_64_bits():
    n = np.array([10, 4 * 10**9])
    assert ranked.lengths_norm(n, 10**9, 10**12).tolist() == [25, 25 + 75 * 4 * 10**9 * 10**9 // 10**12]
