"""Training rows: documents joined with their labels, one row per document id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskfeat.session import checkpoint


BROADCAST_ROWS = 1 << 20  # label rows (16 bytes each) that are sent to every executor


def marks(labels: DataFrame, label: str, fold: Column, id_col: str = "doc_id") -> DataFrame:
    """``(doc, y)`` per labelled id for which ``fold`` holds.

    Rows without an id or label take no part; an id that is labelled more than
    once counts as 1 if any of its labels does.
    """
    return labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull() & fold).groupBy(F.col(id_col).cast("long").alias("doc")).agg(
        F.max(F.when(F.col(label) > 0, 1).otherwise(0)).alias("y")
    )


def with_texts(docs: DataFrame, marked: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc, text, y)`` of the marked documents.

    Few marks go to the documents; more of them are joined by a shuffle, written once.
    """
    d = docs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("doc"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )
    if marked.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return d.join(F.broadcast(marked), "doc")
    return checkpoint(d.join(marked, "doc"))


def bounded(rows: DataFrame, key: str, n: int, limit: int) -> DataFrame:
    """About ``limit`` of ``n`` rows, by a hash of ``key`` (all, if they fit); spread over tasks."""
    if n <= limit:
        return rows
    share = int(limit / n * (1 << 30))
    return rows.where(F.pmod(F.xxhash64(F.col(key), F.lit(11)), F.lit(1 << 30)) < share)
