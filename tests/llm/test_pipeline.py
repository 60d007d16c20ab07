"""The pipeline's stages against brute force, each on its own input; edge rows through all stages."""

import zlib

import corpus_pipeline
import public_tokenizers
from test_decontaminate import brute as leaks
from test_linededup import brute as lines
from test_packing import check as packed
from test_simhash import brute as groups

from riskfeat.llm import packing

D = "/root/testdata/sf0.001"


def texts(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_stages_match_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{D}/documents.parquet")
    benchmark = texts(spark.read.parquet(f"{D}/benchmark.parquet").withColumnRenamed("item_id", "doc_id"))
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line dedup", "near-dedup", "decontamination", "packing"]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = texts(docs)
        out = stage(spark, docs, D)
        out.write.parquet(f"{tmp_path}/{k}")
        again = spark.read.parquet(f"{tmp_path}/{k}")
        if name != "packing":
            assert again.columns == docs.columns and again.dtypes == docs.dtypes
            after = texts(again)
        if name == "toxicity":
            labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{D}/labels.parquet").collect()}
            kept = {d for d, _ in after}
            assert set(after) <= set(before)
            assert sum(labels.get(d) == 0 for d, _ in before if d not in kept) == 0
        elif name == "line dedup":
            import hashlib

            md5 = lambda t: hashlib.md5(t.encode()).hexdigest()
            expect = {(r[0], r[4]) for r in lines(spark, before)}
            assert {(d, md5(t)) for d, t in after} <= expect
            gone = {d for d, _ in before} - {d for d, _ in after}
            assert all(r[0] not in gone or r[2] for r in lines(spark, before))
            assert all(t.split() or not dict(before)[d].split() for d, t in after)
            assert all(r.n_chars == len(r.text) for r in again.collect())
        elif name == "near-dedup":
            assert sorted(after) == sorted((d, t) for d, t in before if d in {r[0] for r in groups(before) if r[0] == r[2]})
        elif name == "decontamination":
            bad = {r[0] for r in leaks(before, [(i, t) for i, t in benchmark])}
            assert sorted(after) == sorted((d, t) for d, t in before if d not in bad) and bad
        else:
            assert packed([r.asDict() for r in again.collect()], dict(before)) == 0
        docs = again


def test_run_gives_the_last_stage(spark):
    out = corpus_pipeline.run(spark, D)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert out.count() > 0


def test_edge_rows_through_all_stages(spark, tmp_path):
    base = spark.read.parquet(f"{D}/documents.parquet").schema
    long = " ".join(f"w{zlib.crc32(str(i).encode())}" for i in range(40_000))
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "", "en", "s", 0), (None, None, None, None, None), (None, "a few words", None, None, None),
            (4, long, "en", None, None), (5, long, "en", "s", 9), (6, "some plain words of a text that stays", "en", "s", 1), (6, "some plain words of a text that stays", "en", "s", 1),
            (7, "ok", None, "s", 2)]
    docs = spark.createDataFrame(rows, base)
    empty = docs.limit(0)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, D)
        out.write.parquet(f"{tmp_path}/e{k}")
        docs = spark.read.parquet(f"{tmp_path}/e{k}")
        none = stage(spark, empty, D)
        assert none.collect() == []
    kept = sorted({r.doc_id for r in docs.collect()}, key=repr)
    # 2 and 3 are empty like 1, 5 repeats 4, one row of 6 stays, rows without an id stay
    assert kept == sorted([None, 1, 4, 6, 7], key=repr)
    assert sum(r.length for r in docs.where("doc_id = 6").collect()) == len(packing.encoder(public_tokenizers.path("word_bpe_49k.json")).tok.encode(rows[7][1], add_special_tokens=False).ids) + 1
