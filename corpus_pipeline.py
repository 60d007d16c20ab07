"""Cleaning and packing of a document corpus, stage by stage.

Each stage takes the documents that the one before kept and returns documents
with the same columns; the last one packs them into training sequences.

1. toxicity: documents scored 0.7 or more go;
2. line dedup: lines similar to an earlier line go; a document that lost lines
   and has no word left is a copy of earlier ones and goes;
3. near-dedup: of each SimHash group the document with the smallest id stays;
4. decontamination: documents that hold a benchmark item go;
5. packing: what is left becomes sequences of at most 2048 tokens.

Rows with a null id, null or empty text pass every filter on their own merits:
an empty text is not toxic, has no lines and no item; of the empty texts with
an id the first stays.  An empty table gives no pieces.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskfeat.llm import decontaminate, linededup, packing, queries, simhash, toxicity
from riskfeat.session import ensure_checkpoint_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, queries.fit_toxicity(spark, docs, sf_dir), queries.TOXIC_AT)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    new = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    others = [c for c in docs.columns if c not in new]
    out = linededup.dedup_lines(docs, threshold=0.8, min_tokens=1, columns=others).where(~F.col("emptied"))
    return out.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_first(docs, shingle=4, max_distance=4)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.keep_clean(docs, queries.table(spark, sf_dir, "benchmark"), shingle=5, threshold=0.8)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    pieces = packing.pack(docs, queries.tokenizer_path("word_bpe_49k.json"), end_id=1, capacity=2048)
    return queries.pack_digest(pieces)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("near-dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

#: the stages are not expressible in SQL; they are tested against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written as Parquet for the next."""
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{k}")
            docs = spark.read.parquet(f"{folder}/{k}")
    return docs
