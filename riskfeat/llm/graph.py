"""Connected components of an edge table by alternating stars.

Large-star and small-star steps (Kiveris et al., 2014) over ``(u, v)`` rows;
no edge or label ever reaches the driver, and each round is cut with a
reliable checkpoint.  The minima are written before they are joined back, so
that a vertex with very many neighbours is one pre-aggregated row on one side
and a partition that adaptive execution can split on the other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskfeat.session import checkpoint


def _state(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """``(u, v)`` long edges to ``(u, root)``: root is the least id reachable.

    Vertices that are their own root may be missing.  Raises if it does not
    settle within ``max_rounds`` (rounds grow with the log of the diameter).
    """
    e = checkpoint(
        edges.where(F.col("u") != F.col("v"))
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    state = _state(e)
    for _ in range(max_rounds):
        sym = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        m = checkpoint(sym.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = checkpoint(
            sym.where(F.col("v") > F.col("u")).join(m, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        m2 = checkpoint(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(m2, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = checkpoint(small.unionByName(m2.select("u", F.col("m").alias("v"))).distinct())
        new = _state(e)
        if new == state:
            return e.groupBy("u").agg(F.min("v").alias("root"))
        state = new
    raise RuntimeError("components did not settle")
