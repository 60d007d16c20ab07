"""Decontamination against brute force, planted passages, edge rows."""

import random

import pytest
from pyspark.sql import functions as F

from riskfeat.llm import decontaminate, queries


def shingles(text, k=5):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (text or ""))
    for c in "\t\n\x0b\x0c\r":
        t = t.replace(c, " ")
    w = [x for x in t.split(" ") if x]
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def brute(docs, items):
    sets = [(i, shingles(t)) for i, t in sorted(set(items), key=repr)]
    out = []
    for d, t in docs:
        own = shingles(t)
        for i, s in sets:
            if s and len(s & own) >= 0.8 * len(s):
                out.append((d, i, len(s), len(s & own)))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_query_matches_brute_force(spark):
    d = "/root/testdata/sf0.001"
    read = lambda t, c: [tuple(r) for r in spark.read.parquet(f"{d}/{t}.parquet").select(c, "text").collect()]
    out = queries.op5_decontamination(spark, d)
    assert out.columns == ["doc_id", "item_id", "n_shingles", "n_shared"]
    found = got(out)
    assert found == brute(read("documents", "doc_id"), read("benchmark", "item_id")) and found


@pytest.mark.parametrize("block", [1 << 20, 300])
def test_planted_passages_of_all_sizes(spark, block):
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefgh", k=4))
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([5, 6, 9, 14, 20, 21, 37, 59, 70, 150, 400])]
    docs = []
    for j in range(120):
        i, text = items[j % len(items)]
        w = text.split()
        if j % 3 == 1 and len(w) > 30:
            w[rng.randrange(len(w))] = "changed"
        if j % 3 == 2:
            w = w[: int(len(w) * 0.9)] if len(w) > 30 else w[: len(w) // 2]
        pad = [word() for _ in range(rng.choice([0, 3, 40, 900, 9000]))]
        at = rng.randrange(len(pad) + 1)
        docs.append((j, "\n".join(pad[:at]) + " " + " \t".join(w).upper() + "  " + " ".join(pad[at:])))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    it = spark.createDataFrame(items, "item_id long, text string")
    assert got(decontaminate.contaminated(df, it, block_shingles=block)) == brute(docs, items)


def test_edge_rows(spark):
    items = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (3, "too short"), (4, None), (5, ""), (None, "p q r s t")]
    docs = [(1, None), (2, ""), (3, "a b c"), (4, "x A B C D E F y"), (4, "x A B C D E F y"), (None, "p q r s t"), (5, "w " * 50_000), (6, "z" * 300_000)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit(1)).withColumn("doc", F.lit("x"))
    it = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(9))
    assert got(decontaminate.contaminated(df, it)) == brute(docs, items)
    assert decontaminate.contaminated(df.limit(0), it).collect() == []
    assert decontaminate.contaminated(df, it.limit(0)).collect() == []


def test_short_items_in_many_documents(spark):
    rng = random.Random(11)
    word = lambda: "".join(rng.choices("abcdefgh", k=4))
    items = [(i, " ".join(word() for _ in range(5 + i % 6))) for i in range(60)]
    docs = [(j, " ".join(x for i in rng.sample(range(60), 40) for x in [*(word() for _ in range(30)), items[i][1]])) for j in range(400)]
    df, it = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    expect = brute(docs, items)
    assert len(expect) >= 16_000
    assert got(decontaminate.contaminated(df, it)) == expect
    assert decontaminate.keep_clean(df, it).count() == 0
