"""Neighbours beyond one broadcast: blocks, ties, hubs."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from riskfeat.operators import smote as SM


def brute(keys, x, k):
    out = {}
    for i, a in enumerate(keys):
        d = ((x - x[i]) ** 2).sum(axis=1)
        out[int(a)] = [int(keys[j]) for j in sorted((j for j in range(len(keys)) if j != i), key=lambda j: (d[j], keys[j]))[:k]]
    return out


@pytest.mark.parametrize("block_rows", [7, 60, 10_000])
def test_blocks_give_the_exact_neighbours(spark, block_rows):
    """Whole-number coordinates, so that equal distances are equal in any order of additions."""
    rng = np.random.default_rng(block_rows)
    keys, x = np.arange(150) * 3 + 1, rng.integers(0, 6, (150, 3)).astype(float)
    df = spark.createDataFrame([(int(a), [float(v) for v in r]) for a, r in zip(keys, x)], "k long, x array<double>").repartition(3)
    got = {r["k"]: list(r["nbrs"]) for r in SM.nearest_in_blocks(df, 4, 150, block_rows).collect()}
    assert got == brute(keys, x, 4)


def test_fewer_rows_than_neighbours(spark):
    df = spark.createDataFrame([(1, [0.0]), (2, [1.0]), (3, [5.0])], "k long, x array<double>")
    got = {r["k"]: list(r["nbrs"]) for r in SM.nearest_in_blocks(df, 5, 3, 1).collect()}
    assert got == {1: [2, 3], 2: [1, 3], 3: [2, 1]}


def test_both_ways_make_the_same_rows_hubs_included(spark):
    """One row in the middle is everyone's nearest neighbour."""
    ring = [(i, 1, [float(np.cos(i)), float(np.sin(i))]) for i in range(1, 40)]
    df = spark.createDataFrame([(0, 1, [0.0, 0.0])] + ring + [(1000 + i, 0, [9.0, 9.0]) for i in range(400)], "SK_ID_CURR long, TARGET int, x array<double>")
    df = df.select("SK_ID_CURR", "TARGET", array_to_vector("x").alias("features"))

    def rows(**kw):
        out = SM.smote(df, k=3, seed=5, **kw).where("SK_ID_CURR IS NULL").select("TARGET", vector_to_array("features").alias("x"))
        return sorted((r["TARGET"], *np.round(r["x"], 9)) for r in out.collect())

    want = rows()
    assert len(want) == 360
    assert rows(max_minority=1, block_rows=9) == want
    assert rows(hub_rows=3) == want
    assert rows(max_minority=1, block_rows=40, hub_rows=1) == want
