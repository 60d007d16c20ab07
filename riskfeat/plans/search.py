"""A search that survives being stopped: finished fits go into a ledger table.

Every (candidate, fold) fit writes one row into a folder of its own as soon as
it ends; a folder appears whole or not at all. A later run of the same search
reads the ledger, fits only what is missing and ranks the same numbers. The
ledger's folder name is a digest of the draws, the folds and the data, so that
another search, or other data, never finds these rows.
"""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SCHEMA = "candidate int, fold int, auc double, params string"


def data_signature(matrix: DataFrame, key: str, label: str) -> str:
    """Row count and an order-free hash of key, label, fold and features; one pass."""
    row = matrix.agg(F.count(F.lit(1)).alias("n"),
                     F.bit_xor(F.xxhash64(F.col(key), F.col(label), F.col("fold"), vector_to_array("features"))).alias("h")).first()
    return f"{row['n']}:{row['h']}"


def fingerprint(params: Sequence[dict], k: int, signature: str) -> str:
    text = json.dumps([list(params), k, signature], sort_keys=True, default=str)
    return hashlib.sha256(text.encode()).hexdigest()[:24]


class Ledger:
    """Finished fits of one search under ``root/<fingerprint>``."""

    def __init__(self, spark: SparkSession, root: str, name: str):
        self.spark, self.folder = spark, f"{root.rstrip('/')}/{name}"

    def table(self) -> DataFrame:
        """``(candidate, fold, auc, params)``; empty before the first fit ends."""
        try:
            return self.spark.read.schema(SCHEMA).option("recursiveFileLookup", True).parquet(self.folder)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], SCHEMA)

    def finished(self) -> dict[tuple[int, int], float]:
        """AUC by (candidate, fold); a fold of one class has NaN."""
        return {(r["candidate"], r["fold"]): math.nan if r["auc"] is None else r["auc"] for r in self.table().collect()}

    def record(self, candidate: int, fold: int, auc: float, params: dict) -> None:
        row = [(candidate, fold, None if math.isnan(auc) else float(auc), json.dumps(params, sort_keys=True))]
        self.spark.createDataFrame(row, SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/fit-{candidate}-{fold}")


def rank_fits(fits: DataFrame, by: str = "candidate") -> DataFrame:
    """``(by, folds, mean_auc, std_auc, rank)`` from one row per (candidate, fold).

    Folds are added in their order, so the mean does not depend on the plan; the
    spread is that of the population; equal means share a rank (1, 2, 2, 4). A
    fold without an AUC takes no part. One row per candidate reaches the window.
    """
    some = fits.where(F.col("auc").isNotNull()).groupBy(by).agg(F.sort_array(F.collect_list(F.struct("fold", "auc"))).alias("f"))
    n = F.size("f").cast("double")
    mean = F.aggregate("f", F.lit(0.0), lambda a, x: a + x["auc"]) / n
    with_mean = some.withColumn("mean_auc", mean)
    spread = F.aggregate("f", F.lit(0.0), lambda a, x: a + (x["auc"] - F.col("mean_auc")) * (x["auc"] - F.col("mean_auc")))
    rows = with_mean.withColumn("std_auc", F.sqrt(spread / n))
    return rows.select(by, F.size("f").alias("folds"), "mean_auc", "std_auc",
                       F.rank().over(Window.orderBy(F.col("mean_auc").desc())).alias("rank"))
