"""Line deduplication against brute force over all pairs of lines."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from riskfeat.llm import linededup, queries


def words(line):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line)
    for c in "\t\x0b\x0c\r":
        t = t.replace(c, " ")
    return frozenset(w for w in t.split(" ") if w)


def brute(spark, rows, threshold=0.8, least=1):
    """rows: (doc, text); places are ordered by id (null first), text hash, line."""
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "i long, text string")
    hashes = {r.i: r.h for r in df.select("i", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()}
    places = {}
    for i, (d, t) in enumerate(rows):
        for k, line in enumerate((t or "").split("\n") if t is not None else []):
            s = words(line)
            if len(s) >= least:
                places[(d is not None, d or 0, hashes[i], k)] = s
    order = sorted(places)
    by_word, gone = {}, set()
    for p in order:
        s = places[p]
        near = {q for w in s for q in by_word.get(w, ())}
        if any(len(s & t) * (1 + threshold) >= threshold * (len(s) + len(t)) - 1e-9 for t in (places[q] for q in near)):
            gone.add(p)
        for w in s:
            by_word.setdefault(w, []).append(p)
    out = []
    for i, (d, t) in enumerate(rows):
        lines = t.split("\n") if t is not None else []
        off = [k for k in range(len(lines)) if (d is not None, d or 0, hashes[i], k) in gone]
        kept = None if t is None else "\n".join(x for k, x in enumerate(lines) if k not in off)
        out.append((d, len(lines), len(off), off, None if kept is None else hashlib.md5(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    out = df.select("row.doc_id", "n_lines", F.size("removed").alias("n"), "removed", F.md5("kept_text"))
    return sorted((tuple(r) for r in out.collect()), key=repr)


def test_query_matches_brute_force(spark):
    d = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    out = queries.op4_line_dedup(spark, d)
    assert out.columns == ["doc_id", "n_lines", "n_removed", "removed", "kept_md5"]
    found = sorted((tuple(r) for r in out.collect()), key=repr)
    expect = [(*r[:3], ",".join(map(str, r[3])), r[4]) for r in brute(spark, rows)]
    assert found == sorted(expect, key=repr) and sum(r[2] for r in found)


def planted():
    rng = random.Random(3)
    vocab = ["".join(rng.choices("abcdef", k=rng.randrange(1, 6))) for _ in range(300)]
    base = [rng.choices(vocab, k=rng.randrange(4, 40)) for _ in range(12)]
    rows = []
    for i in range(90):
        lines = []
        for _ in range(rng.randrange(0, 6)):
            w = list(rng.choice(base)) if rng.random() < 0.6 else rng.choices(vocab, k=rng.randrange(1, 30))
            for _ in range(rng.randrange(0, 4)):
                if rng.random() < 0.5:
                    w[rng.randrange(len(w))] = rng.choice(vocab)
                else:
                    w.insert(rng.randrange(len(w) + 1), rng.choice(vocab))
            rng.shuffle(w) if rng.random() < 0.2 else None
            lines.append((" " if rng.random() < 0.8 else "\t ").join(x.upper() if rng.random() < 0.1 else x for x in w))
        rows.append((i, "\n".join(lines)))
    return rows


@pytest.mark.parametrize("block, best, pairs", [(2048, 2, 1 << 20), (4, 1, 50)])
def test_planted_near_copies(spark, monkeypatch, block, best, pairs):
    monkeypatch.setattr(linededup, "BLOCK", block)
    monkeypatch.setattr(linededup, "BEST", best)
    monkeypatch.setattr(linededup, "PAIRS_AT_ONCE", pairs)
    monkeypatch.setattr(linededup, "CELL_ROWS", 200)
    rows = planted()
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("h", F.lit("x")).withColumn("line", F.lit(1)).withColumn("id", F.lit(0))
    for name in ("row", "lines", "sets", "chunk", "emptied"):
        df = df.withColumn(name, F.lit(2))
    assert got(linededup.dedup_lines(df.repartition(4))) == brute(spark, rows)


@pytest.mark.parametrize("threshold", [0.5, 0.65, 0.8, 0.9, 1.0])
def test_similar_sizes_are_in_neighbouring_classes(threshold):
    for n in range(1, 2000):
        m = np.arange(n, int(n / threshold + 1e-9) + 1)
        kind = linededup._size_class(np.r_[n, m], threshold)
        assert np.abs(kind[1:] - kind[0]).max() <= 1


def test_edge_rows(spark):
    line = "one two three four five six"
    rows = [(1, None), (2, ""), (3, "\n\n"), (4, line), (4, line), (5, line + "\nshort line\n" + line.upper()), (None, line + " seven"), (None, "a b\na b"),
            (6, " ".join(f"w{i}" for i in range(30_000))), (7, " ".join(f"w{i}" for i in range(29_000))), (8, "z" * 200_000), (9, "a b c d\na b c d")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(linededup.dedup_lines(df)) == brute(spark, rows)
    assert linededup.dedup_lines(df.limit(0)).collect() == []
    assert got(linededup.dedup_lines(df, min_tokens=5)) == brute(spark, rows, least=5)
    # the smallest sets that can be similar to another one have four words
    least = [(1, "a b\na b"), (2, "b a"), (3, "a b c\na b c d\nA"), (4, "e d c b a\na"), (5, "c b a"), (6, "x y z w\nx y z w v"), (7, "x y z\n...\n...")]
    assert got(linededup.dedup_lines(spark.createDataFrame(least, "doc_id long, text string"))) == brute(spark, least)


def test_sets_survive_packing():
    rng = random.Random(5)
    texts = ["", None, "\n\n \n", "a A a", *("\n".join(" ".join(rng.choices("abcdefgh", k=rng.randrange(0, 9))) for _ in range(rng.randrange(0, 5))) for _ in range(40))]
    b = pa.RecordBatch.from_arrays([pa.array([None, *range(1, len(texts))], pa.int64()), pa.array([rng.getrandbits(64) - 2**63 for _ in texts], pa.int64()), pa.array(texts)], ["doc", "h", "text"])
    for batch in (b, b.slice(0, 3), b.slice(0, 0)):
        s = linededup.Sets.read(batch)
        again = linededup.Sets.unpacked(s.packed())
        assert all((getattr(s, c) == getattr(again, c)).all() for c in ("doc", "h", "place", "size", "first", "owner"))
        lines = lambda x: [sorted(x.word[f : f + n].tolist()) for f, n in zip(x.first.tolist(), x.size.tolist())]
        assert lines(s) == lines(again) and all((a == z).all() for a, z in zip(s.ids(), again.ids()))
        expect = [(d, k, len(words(x))) for d, t in zip(batch.column("doc").to_pylist(), batch.column("text").to_pylist()) for k, x in enumerate((t or "").split("\n")) if words(x)]
        assert [(d, k, n) for d, k, n in zip(s.doc.tolist(), s.place.tolist(), s.size.tolist())] == [(-(1 << 62) if d is None else d, k, n) for d, k, n in expect]


def test_copies_are_emptied(spark):
    long, other = "one two three four five six", "seven eight nine ten eleven twelve"
    rows = [(1, f"Title here\n{long}\n\nBye"), (2, f"Title here\n{long}\n\nBye"), (3, f"title HERE\n{long}\nnew words"), (4, "Title here\nBye"),
            (5, f"Title here\n{other}"), (6, f"bye\n{other}\nhere title"), (7, f"own line\n{long}\nown line"), (None, f"Bye\n{long}"), (None, f"Bye\n{long}")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = linededup.dedup_lines(df.repartition(3))
    assert got(out) == brute(spark, rows)
    # rows without an id are first; 3, 5 and 7 hold a line of their own
    assert sorted(r.row.doc_id for r in out.where("emptied").collect()) == [2, 4, 6]
    assert linededup.dedup_lines(df, columns=["doc_id"]).schema["row"].dataType.names == ["doc_id"]


def test_pipeline_drops_copies_with_short_lines(spark):
    import corpus_pipeline

    text = "A Title\none two three four five six\nthe end"
    docs = spark.createDataFrame([(1, text, "en", "s", len(text)), (2, text, "en", "s", len(text))], "doc_id long, text string, lang string, source string, n_chars long")
    assert [(r.doc_id, r.text) for r in corpus_pipeline.drop_repeated_lines(spark, docs, "").collect()] == [(1, text)]


def test_only_documents_that_lose_lines_are_marked(spark):
    """The mark misses no document of the list and lets few others through, null and repeated ids included."""
    docs = spark.range(20000).selectExpr("IF(id % 1000 = 0, NULL, id) AS doc", "id * 7919 AS h").unionByName(spark.range(3).selectExpr("id AS doc", "id * 7919 AS h"))
    docs = docs.fillna(-(1 << 62), ["doc"])
    per = docs.where("h % 4 = 0").distinct()
    out = linededup._with_mark(docs, per)
    assert out.columns == ["doc", "h", "marked"] and out.count() == 20003
    assert out.where("h % 4 = 0 AND NOT marked").count() == 0
    assert out.where("h % 4 <> 0 AND marked").count() < 40
    assert linededup._with_mark(docs, per.limit(0)).where("marked").count() == 0


def test_texts_without_lines_to_lose_are_not_shuffled(spark):
    """Texts that keep all their lines reach the removal without an exchange."""
    rows = [(i, f"only{i} words{i} of{i} text{i} here{i}") for i in range(50)] + [(100, "a b c\nd e f"), (101, "a b c\ng h i")]
    out = linededup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and "NOT coalesce" in plan
    assert {(r.row.doc_id, tuple(r.removed)) for r in out.collect() if r.removed} == {(101, (0,))}
    assert out.count() == 52


def test_planes_and_entries_come_back():
    import numpy as np

    from riskfeat.llm import linededup as L

    rng = np.random.default_rng(3)
    for n in (0, 1, 1000):
        e = {c: rng.integers(0, 2 ** (8 * L._ENTRY[c].itemsize) - 1, n, dtype=f"<u{L._ENTRY[c].itemsize}").view(L._ENTRY[c]) for c in L._ENTRY.names}
        back = L._unpack_entries(L._pack_entries(e))
        assert all(np.array_equal(e[c], back[c]) and back[c].dtype == L._ENTRY[c] for c in e)


def test_a_later_line_of_a_known_set_is_not_filed_again():
    """What a task knows is held in a table of fixed size; an earlier place is always filed."""
    import numpy as np

    from riskfeat.llm import linededup as L

    def sets(docs):
        one = np.array([5, 9], np.uint64)
        k = len(docs)
        return L.Sets(np.array(docs), np.zeros(k, np.int64), np.zeros(k, np.int64), np.full(k, 2), np.tile(one, k))

    seen = L._Seen()
    assert seen.firsts(sets([7, 4, 9])).tolist() == [False, True, False]
    assert seen.firsts(sets([8, 4, 6])).tolist() == [False, False, False]
    assert seen.firsts(sets([3, 2, 5])).tolist() == [False, True, False]
    assert seen.firsts(sets([])).tolist() == []


def test_the_order_of_cells_is_by_all_fields():
    import numpy as np

    from riskfeat.llm import linededup as L

    rng = np.random.default_rng(4)
    for top in (4, 1 << 25):  # sizes beyond 24 bits are sorted field by field
        e = {c: rng.integers(0, 3, 500).astype(L._ENTRY[c]) for c in L._ENTRY.names}
        e["key"] <<= np.uint64(64 - L.KEY_BITS)
        e["size"][0] = top
        want = np.lexsort(tuple(e[c] for c in ("line", "h", "doc", "b2", "b1", "id1", "size", "key")))
        got = L._cell_order(e)
        assert all(np.array_equal(e[c][got], e[c][want]) for c in ("line", "h", "doc", "b2", "b1", "id1", "size", "key"))


def test_second_look_lists_the_words_of_its_lines():
    import numpy as np

    from riskfeat.llm import linededup as L

    s = L.Sets(np.array([1, 2, 3]), np.zeros(3, np.int64), np.zeros(3, np.int64), np.array([2, 1, 3]), np.arange(6, dtype=np.uint64))
    assert L._word_lists(s, np.array([2, 0, 2])).to_pylist() == [[3, 4, 5], [0, 1], [3, 4, 5]]
    assert L._word_lists(s, np.zeros(0, np.int64)).to_pylist() == []


def test_entries_carry_text_hashes_only_of_ids_with_several_texts():
    from types import SimpleNamespace as Shared

    from riskfeat.llm import linededup as L

    rows = [(i, 1000 + i, f"one{i} two three four five six\nseven{i} eight nine ten eleven twelve") for i in (1, 2, 3)] + [(2, 77, "a b c d e f g")]
    b = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["doc", "h", "text"])
    slots = [x for x in L._write_sets([b]) if x.column("sets").null_count == 0]
    found = [tuple(r.values()) for x in slots for t in L._texts([x]) for r in t.to_pylist()]
    assert found == [(1, 1001), (2, 1002), (3, 1003), (2, 77)]
    bits = np.zeros(1 << L.PLACE_BITS, bool)
    bits[L._doc_slot(np.array([2]))] = True
    doubled = Shared(value=np.packbits(bits, bitorder="little").tobytes())
    table = Shared(value=np.ones(1 << L.TABLE_BITS, np.int64))
    rare = Shared(value=L._rarity(table.value))
    e = [L._unpack_entries(x.as_py()) for y in L._entries(1, 0.8, rare, table, doubled, 1)(slots) for x in y.column("entries")]
    assert {(d, h) for x in e for d, h in zip(x["doc"].tolist(), x["h"].tolist())} == {(1, 0), (2, 1002), (3, 0), (2, 77)}


@pytest.mark.parametrize("best", [4, 1])
def test_repeated_and_null_ids_keep_their_texts_apart(spark, monkeypatch, best):
    monkeypatch.setattr(linededup, "BEST", best)
    rows = [(None if i % 7 == 0 else i % 20, t) for i, t in planted()]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(linededup.dedup_lines(df.repartition(3))) == brute(spark, rows)


def test_shuffle_files_go_with_their_step(spark):
    """Only the last step's shuffles, those of the result, are there when the result has been read."""
    import time

    from riskfeat.session import CLEANUP_CONF

    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def left():
        return {x for x in disk.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in x and x.endswith(".data")}

    df = spark.createDataFrame(planted(), "doc_id long, text string").repartition(4)
    setting = spark.conf.get(CLEANUP_CONF, None)
    before = left()
    linededup.dedup_lines(df)
    assert spark.conf.get(CLEANUP_CONF, None) == setting
    for _ in range(20):  # files are removed beside the job
        if not left() - before:
            break
        time.sleep(0.5)
    assert not left() - before
