"""SimHash groups against brute force over all pairs."""

import pytest
import xxhash
from pyspark.sql import functions as F

from riskfeat.llm import queries, simhash


def brute_fp(text, k=4):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (text or ""))
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    sh = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hs = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute(rows, dist=4):
    fps = [(d, brute_fp(t)) for d, t in rows]
    up = list(range(len(fps)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i][1] ^ fps[j][1]).bit_count() <= dist:
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    groups = {}
    for i, (d, _) in enumerate(fps):
        groups.setdefault(root(i), []).append(d)
    out = []
    for i, (d, f) in enumerate(fps):
        ids = [x for x in groups[root(i)] if x is not None]
        out.append((d, f"{f:016x}", min(ids) if ids else None))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in df.collect()), key=repr)


@pytest.mark.parametrize("cell", [1024, 3])
def test_query_matches_brute_force(spark, monkeypatch, cell):
    d = "/root/testdata/sf0.001"
    monkeypatch.setattr(simhash, "CELL", cell)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    assert got(queries.op3_simhash(spark, d)) == brute(rows)


@pytest.mark.parametrize("n", [2, 10**4, 10**5, 3 * 10**5, 10**10])
def test_segments_find_every_distance(n):
    segs = simhash.segments(n, 4)
    assert sum(w for _, w, _ in segs) == 64
    # any spread of 4 differing bits over the segments has one inside its radius
    def spread(k, left):
        if k == 0:
            return [[left]] if True else []
        return [[i, *r] for i in range(left + 1) for r in spread(k - 1, left - i)]
    for counts in spread(len(segs) - 1, 4):
        assert any(c <= r for c, (_, _, r) in zip(counts, segs)), (counts, segs)


def test_edge_rows(spark):
    base = " ".join(f"w{i}" for i in range(300))
    rows = [(5, None), (2, ""), (9, " \n\t"), (7, "One two"), (7, "One two"), (None, "one  TWO"), (1, base), (3, base + " tail"),
            (4, "x" * 200_000), (11, "ä ö ü " * 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fingerprint", F.lit("mine")).withColumn("node", F.lit(1))
    out = simhash.simhash_groups(df).select("doc_id", simhash.hex16(F.col("fingerprint")).alias("fingerprint"), F.col("component").alias("component_id"))
    assert got(out) == brute(rows)
    empty = simhash.simhash_groups(df.limit(0))
    assert empty.collect() == [] and empty.columns == ["doc_id", "fingerprint", "component"]


def test_large_group_of_near_copies(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CELL", 8)
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[:100] + [f"edit{i}"] + words[100:])) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = simhash.simhash_groups(df).select("doc_id", simhash.hex16(F.col("fingerprint")).alias("fingerprint"), F.col("component").alias("component_id"))
    assert got(out) == brute(rows)


def test_repeated_ids_with_unrelated_texts(spark):
    text = lambda k: " ".join(f"{k}{i}" for i in range(200))
    rows = [(1, text("a")), (1, text("b")), (1, text("b")), (2, text("a")), (2, text("c")), (3, text("b")), (4, text("c")), (5, text("d")), (None, text("a"))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = sorted(((r.doc_id, r.text) for r in simhash.keep_first(df.repartition(3)).collect()), key=repr)
    assert out == sorted([(1, text("a")), (1, text("b")), (2, text("c")), (5, text("d")), (None, text("a"))], key=repr)
    groups = {(r.doc_id, r.fingerprint): r.component for r in simhash.simhash_groups(df).collect()}
    assert groups[(2, simhash_long(text("c")))] == 2 and groups[(4, simhash_long(text("c")))] == 2


def simhash_long(text):
    f = simhash.fingerprint(text, 4)
    return f - (1 << 64) if f >> 63 else f
