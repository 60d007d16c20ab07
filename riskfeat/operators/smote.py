"""SMOTE: synthetic minority rows on segments between a row and one of its k
nearest minority neighbours.

Neighbours are exact. A minority set of up to ``max_minority`` rows (counted
first) is broadcast and every task compares its own rows with it; a larger one
is cut into blocks of bounded rows, each pair of blocks is compared in a task of
its own, and a row's best k of all blocks are merged. Either way distances are
computed in numpy tiles and only the k best leave a task: no pair is ever a row.
Generation is plain Spark: repeat counts, a seeded neighbour pick, a key join,
``zip_with``; a row that is the neighbour of very many is spread over tasks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint
from . import ranks

MAX_MINORITY = 50_000
BLOCK_ROWS = 8_192
TILE = 1 << 22  # distances held at once, whatever the number of rows
HUB_ROWS = 100_000


def nearest(own: np.ndarray, x: np.ndarray, keys: np.ndarray, mat: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per row of ``x`` the (squared distance, key) of its k nearest rows of ``mat``
    other than itself, by distance, then key; fewer if there are fewer."""
    sq = (mat * mat).sum(axis=1)
    step = max(1, TILE // max(1, len(keys)))
    for s in range(0, len(x), step):
        xb = x[s:s + step]
        d = np.maximum((xb * xb).sum(axis=1)[:, None] + sq[None, :] - 2.0 * xb @ mat.T, 0.0)
        d[keys[None, :] == own[s:s + step, None]] = np.inf  # a row is not its own neighbour
        kk = min(k, len(keys))
        kth = np.partition(d, kk - 1, axis=1)[:, kk - 1] if kk else np.zeros(len(xb))
        for r in range(len(xb)):
            # every candidate up to the k-th distance (ties included), in a fixed order
            cand = np.nonzero((d[r] <= kth[r]) & (d[r] < np.inf))[0]
            order = cand[np.lexsort((keys[cand], d[r, cand]))][:kk]
            yield d[r, order], keys[order]


def _against_broadcast(bc, k: int):
    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, mat = bc.value
        for pdf in batches:
            if len(pdf):
                x = np.stack(pdf["x"].to_numpy()).astype("float64")
                found = [n.tolist() for _, n in nearest(pdf["k"].to_numpy(), x, keys, mat, k)]
                yield pd.DataFrame({"k": pdf["k"].to_numpy(), "nbrs": found})

    return run


def _rows(table: pa.Table, column: str) -> tuple[np.ndarray, np.ndarray]:
    """Keys and vectors of a packed block."""
    packed = table.column(column).combine_chunks().flatten()
    keys = packed.field("k").to_numpy(zero_copy_only=False)
    return keys, packed.field("x").flatten().to_numpy(zero_copy_only=False).reshape(len(keys), -1)


def nearest_in_blocks(mino: DataFrame, k: int, n: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``(k, nbrs)`` of ``mino (k, x)`` by comparing every pair of blocks of about ``block_rows`` rows."""
    blocks = -(-n // block_rows)
    block = F.pmod(F.xxhash64("k", F.lit(17)), F.lit(blocks))
    packed = checkpoint(mino.withColumn("b", block).groupBy("b").agg(F.collect_list(F.struct("k", "x")).alias("rows")))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))
    left = packed.select(F.col("b").alias("i"), every.alias("j"), F.col("rows").alias("own"))
    right = packed.select(every.alias("i"), F.col("b").alias("j"), F.col("rows").alias("other"))

    def cell(a: pa.Table, b: pa.Table) -> pa.Table:
        found: list[tuple[np.ndarray, np.ndarray]] = []
        own = np.zeros(0, np.int64)
        if a.num_rows and b.num_rows:
            own, x = _rows(a, "own")
            found = list(nearest(own, x, *_rows(b, "other"), k))
        at = np.cumsum([0] + [len(d) for d, _ in found])
        flat = [np.concatenate([f[c] for f in found]) if found else np.zeros(0, t) for c, t in ((0, np.float64), (1, np.int64))]
        pairs = pa.StructArray.from_arrays([pa.array(flat[0]), pa.array(flat[1])], names=["d", "n"])
        return pa.table({"k": pa.array(own, pa.int64()), "best": pa.ListArray.from_arrays(pa.array(at, pa.int32()), pairs)})

    best = left.groupBy("i", "j").cogroup(right.groupBy("i", "j")).applyInArrow(cell, "k long, best array<struct<d: double, n: long>>")
    merged = best.groupBy("k").agg(F.sort_array(F.flatten(F.collect_list("best"))).alias("best"))
    return merged.select("k", F.transform(F.slice("best", 1, k), lambda p: p["n"]).alias("nbrs"))


def smote(df: DataFrame, label: str = "TARGET", key: str = "SK_ID_CURR", features: str = "features",
          k: int = 5, seed: int = 42, max_minority: int = MAX_MINORITY, block_rows: int = BLOCK_ROWS,
          hub_rows: int = HUB_ROWS) -> DataFrame:
    """Return ``df`` plus synthetic minority rows (key null) up to class balance.

    Up to ``max_minority`` rows the minority set is broadcast, beyond it is
    compared in blocks; the neighbours are the same.
    """
    counts = ranks.class_counts(df, label)
    if len(counts) < 2:
        return df
    minority = min(counts, key=lambda c: (counts[c], c))
    n_min = counts[minority]
    need = max(counts.values()) - n_min
    if need <= 0 or n_min < 2:
        return df
    spark = df.sparkSession
    mino = df.where(F.col(label) == minority).select(F.col(key).cast("long").alias("k"), vector_to_array(features).alias("x"))
    if n_min <= max_minority:
        rows = mino.collect()  # bounded by max_minority
        bc = spark.sparkContext.broadcast((np.array([r["k"] for r in rows], dtype="int64"), np.array([r["x"] for r in rows], dtype="float64")))
        nbrs = mino.mapInPandas(_against_broadcast(bc, k), "k long, nbrs array<long>")
    else:
        nbrs = nearest_in_blocks(mino, k, n_min, block_rows)
    nbrs = checkpoint(nbrs)  # read for the hubs and for the rows

    base, extra = divmod(need, n_min)
    ranked = ranks.rank_within(mino.withColumn("_all", F.lit(0)), ["_all"], "k", seed).drop("_all")
    reps = ranked.select("k", "x", (F.lit(base) + (F.col("_rank") <= extra).cast("long")).alias("reps"))
    gen = (
        reps.where(F.col("reps") > 0)
        .join(nbrs, "k")
        .select("k", "x", "nbrs", F.explode(F.sequence(F.lit(1), F.col("reps").cast("int"))).alias("s"))
        .withColumn("pick", F.pmod(F.xxhash64("k", "s", F.lit(seed)), F.size("nbrs")))
        .withColumn("nk", F.element_at("nbrs", (F.col("pick") + 1).cast("int")))
        .withColumn("u", F.pmod(F.xxhash64("k", "s", F.lit(seed + 1)), F.lit(1 << 30)) / float(1 << 30))
    )
    # a neighbour of more than hub_rows new rows meets them in several tasks; there are at most need / hub_rows such
    share = max(hub_rows, need >> 20)
    hubs = gen.groupBy("nk").agg(F.ceil(F.count(F.lit(1)) / share).cast("int").alias("ways")).where("ways > 1")
    ways = F.coalesce("ways", F.lit(1))
    gen = gen.join(F.broadcast(hubs), "nk", "left").withColumn("way", F.pmod(F.xxhash64("k", "s"), ways).cast("int"))
    other = mino.select(F.col("k").alias("nk"), F.col("x").alias("xn")).join(F.broadcast(hubs), "nk", "left")
    other = other.select("nk", "xn", F.explode(F.sequence(F.lit(0), ways - 1)).alias("way"))
    synth = gen.join(other, ["nk", "way"]).select(
        F.lit(None).cast(df.schema[key].dataType).alias(key),
        F.lit(minority).cast(df.schema[label].dataType).alias(label),
        array_to_vector(F.zip_with("x", "xn", lambda a, b: a + F.col("u") * (b - a))).alias(features),
    )
    keep = [key, label, features]
    return df.select(*keep).unionByName(synth)
