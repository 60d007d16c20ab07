"""Tables cut into buckets of a key once, so that later jobs group and join by
that key without an exchange.

A bucket is read by one task, which must not meet a key that holds a large
share of the rows.  Rows of heavy keys (``heavy_rows`` rows or more) and rows
without a key are therefore written to a plain table beside the buckets; there
are at most ``rows / heavy_rows`` such keys.  Every row is in exactly one of the
two.  The folder describes itself (``layout``, written last), so any later
session can open it.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from hashlib import md5

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

HEAVY_ROWS = 1_000_000
BROADCAST_KEYS = 100_000  # heavy keys sent to every executor; more of them are joined by a shuffle


@dataclass(frozen=True)
class Bucketed:
    rows: DataFrame  # one bucket per task, sorted by key
    heavy: DataFrame | None  # rows of heavy keys and of no key
    key: str
    buckets: int


def _name(folder: str) -> str:
    return f"bucketed_{md5(folder.rstrip('/').encode()).hexdigest()}"


def _heavy_keys(df: DataFrame, folder: str, key: str, heavy_rows: int) -> DataFrame | None:
    """Heavy keys (null is one of them, however few rows it has), written as a table."""
    path = f"{folder}/heavy_keys"
    n = df.groupBy(F.col(key).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    n.where((F.col("n") >= heavy_rows) | F.col("k").isNull()).write.mode("overwrite").parquet(path)
    keys = df.sparkSession.read.schema(T.StructType([T.StructField("k", df.schema[key].dataType)])).parquet(path)
    found = keys.limit(BROADCAST_KEYS + 1).count()
    if not found:
        return None
    return F.broadcast(keys) if found <= BROADCAST_KEYS else keys


def write_bucketed(df: DataFrame, folder: str, key: str, buckets: int, heavy_rows: int = HEAVY_ROWS) -> Bucketed:
    """Write ``df`` as ``buckets`` files by ``key`` (one exchange), heavy keys apart, and open it.

    Tables that shall meet without an exchange need the same number of buckets
    and the same type of key.  An empty table gives empty buckets.
    """
    folder = folder.rstrip("/")
    keys = _heavy_keys(df, folder, key, heavy_rows)
    rows = df
    if keys is not None:
        same = df[key].eqNullSafe(keys["k"])
        rows = df.join(keys, same, "left_anti")
        df.join(keys, same, "left_semi").write.mode("overwrite").parquet(f"{folder}/heavy")
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {_name(folder)}")
    writer = rows.repartition(buckets, key).write.format("parquet").mode("overwrite").option("path", f"{folder}/rows")
    writer.bucketBy(buckets, key).sortBy(key).saveAsTable(_name(folder))
    layout = spark.range(1).select(
        F.lit(key).alias("key"), F.lit(buckets).alias("buckets"), F.lit(keys is not None).alias("heavy"), F.lit(df.schema.json()).alias("schema")
    )
    layout.coalesce(1).write.mode("overwrite").parquet(f"{folder}/layout")
    return open_bucketed(spark, folder)


def open_bucketed(spark: SparkSession, folder: str) -> Bucketed:
    """A written layout, as tables of this session."""
    folder = folder.rstrip("/")
    layout = spark.read.parquet(f"{folder}/layout").first()
    schema = T.StructType.fromJson(json.loads(layout["schema"]))
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    by = f"(`{layout['key']}`)"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {_name(folder)} ({columns}) USING parquet "
        f"CLUSTERED BY {by} SORTED BY {by} INTO {layout['buckets']} BUCKETS LOCATION '{folder}/rows'"
    )
    heavy = spark.read.schema(schema).parquet(f"{folder}/heavy") if layout["heavy"] else None
    return Bucketed(spark.table(_name(folder)), heavy, layout["key"], layout["buckets"])
