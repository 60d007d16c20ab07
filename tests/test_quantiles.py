"""Exact quantiles from sketches taken side by side."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskfeat.operators import quantiles as Q

QS = (0.0, 0.25, 0.5, 0.9, 1.0)


def want(x, q):
    x = sorted(v for v in x if v is not None and not math.isnan(v))
    if not x:
        return None
    pos = (len(x) - 1) * q
    lo, hi = x[math.floor(pos)], x[math.ceil(pos)]
    return lo if lo == hi else lo + (hi - lo) * (pos - math.floor(pos))


@pytest.mark.parametrize("size", [dict(accuracy=100, max_exact=40, small_rows=0), dict(accuracy=1000, max_exact=500, small_rows=0), dict(small_rows=10), dict()])
def test_every_shape_of_column(spark, size):
    rng = np.random.default_rng(1)
    n = 6000
    cols = {
        "normal": rng.normal(size=n), "spread": np.exp(rng.normal(size=n) * 6), "few": rng.integers(0, 3, n).astype(float), "one": np.full(n, 7.0),
        "mostly_zero": np.where(rng.random(n) < 0.7, 0.0, rng.normal(size=n)), "sorted": np.arange(n, dtype=float),
        "ends": np.where(rng.random(n) < 0.4, np.inf, np.where(rng.random(n) < 0.5, -np.inf, 1.0)),
        "holes": np.where(rng.random(n) < 0.9, np.nan, rng.normal(size=n)), "nothing": np.full(n, np.nan),
    }
    rows = [[None if math.isnan(v) and i % 2 else float(v) for v in r] for i, r in enumerate(zip(*cols.values()))]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols)).repartition(9).cache()
    got = Q.exact_quantiles_multi(df, list(cols), QS, **size)
    for c, x in cols.items():
        for q in QS:
            assert got[c, q] == want(x.tolist(), q), (c, q)


def test_small_and_empty_tables(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (3.0, 5.0), (10.0, None)], "x double, y double")
    for size in ({}, {"small_rows": 0}):
        assert Q.exact_medians(df, ["x", "y"], **size) == {"x": 2.5, "y": 5.0}
        assert Q.exact_medians(df.limit(0), ["x"], **size) == {"x": None}
    assert Q.exact_quantiles_multi(df, [], [0.5]) == {}


def test_two_hundred_columns_without_an_explode_before_the_sketch(spark, monkeypatch):
    """The only rows that are exploded lie inside a bracket."""
    df = spark.range(0, 20_000, 1, 8).select(*[((F.col("id") * (7919 + 2 * i)) % 10_007).cast("double").alias(f"c{i}") for i in range(200)])
    seen = []
    real = Q._sketches

    def spy(frame, values, shares, k):
        plan = frame.groupBy().agg(*[F.kll_sketch_agg_double(v, F.lit(k)) for v in values])._jdf.queryExecution().optimizedPlan().toString()
        seen.append("Generate" in plan)
        return real(frame, values, shares, k)

    monkeypatch.setattr(Q, "_sketches", spy)
    kept = []
    real_resolve = Q._resolve
    monkeypatch.setattr(Q, "_resolve", lambda d, v, t: kept.append(sum(x.inside for x in t)) or real_resolve(d, v, t))
    got = Q.exact_medians(df, [f"c{i}" for i in range(200)], small_rows=1000)
    assert seen == [False] and len(got) == 200
    assert kept[0] < 0.03 * 200 * 20_000
    check = df.agg(*[F.percentile(f"c{i}", 0.5).alias(f"c{i}") for i in (0, 99, 199)]).first()
    assert all(got[c] == check[c] for c in ("c0", "c99", "c199"))
