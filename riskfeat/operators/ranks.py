"""Distributed ranks and running totals without a single-task window.

A window ordered over a whole table (or over one class) runs in one task.
Instead rows are cut into ordered buckets; bucket totals (a few thousand
rows) give each bucket its offset, and the running total is finished by a
window *inside* each bucket. Used by stratified folds / samples (order =
seeded hash of the key) and by exact ROC-AUC (order = score).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HASH_BITS = 60
HASH_BUCKET_BITS = 16  # 65,536 ordered buckets of the hash space


def seeded_hash(key: str, seed: int) -> Column:
    """60 bits of ``md5(key:seed)``: the same number in any SQL engine, so that
    who is in a fold or sample can be checked elsewhere."""
    text = F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("long")


def hash_bucket(h: Column, bits: int = HASH_BUCKET_BITS) -> Column:
    """Ordered bucket of a seeded hash."""
    return F.shiftright(h, HASH_BITS - bits)


def value_bucket(df: DataFrame, col: str, buckets: int = 1024, accuracy: int = 10_000) -> DataFrame:
    """Add ``_b``: an ordered bucket of ``col`` from approximate quantiles.

    The boundaries come from a bounded sketch (``buckets`` values at most), so
    what reaches the driver does not grow with the data.
    """
    probs = [i / buckets for i in range(1, buckets)]
    bounds = df.agg(F.percentile_approx(col, probs, accuracy).alias("q")).first()["q"] or []
    splits = [float("-inf")] + sorted({float(b) for b in bounds if b is not None}) + [float("inf")]
    if len(splits) < 3:
        return df.withColumn("_b", F.lit(0.0))
    return Bucketizer(splits=splits, inputCol=col, outputCol="_b", handleInvalid="keep").transform(df)


def running_totals(
    df: DataFrame,
    order: Sequence[str],
    sums: Sequence[str],
    partition: Sequence[str] = (),
    bucket: str = "_b",
    inclusive: bool = False,
    bounded_partitions: bool = True,
    totals: bool = False,
) -> DataFrame:
    """Add ``cum_<s>`` = sum of ``s`` over earlier rows (same partition).

    ``bucket`` must be non-decreasing in ``order``. The offset table has one
    row per (partition, bucket): with few partition values (a label, a week)
    its size is bounded by the bucket count and it is broadcast; pass
    ``bounded_partitions=False`` for many partition values and the join is
    left to the planner (AQE broadcasts it only if it turns out small).
    ``totals`` also adds ``tot_<s>``, the partition total, from the same table.
    """
    part = list(partition)
    tot = df.groupBy(*part, bucket).agg(*[F.sum(s).alias(s) for s in sums])
    w_off = Window.partitionBy(*part).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    w_all = Window.partitionBy(*part)
    off = tot.select(*part, bucket,
                     *[F.coalesce(F.sum(s).over(w_off), F.lit(0)).alias(f"_off_{s}") for s in sums],
                     *([F.sum(s).over(w_all).alias(f"tot_{s}") for s in sums] if totals else []))
    frame_end = Window.currentRow if inclusive else -1
    w_in = Window.partitionBy(*part, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, frame_end)
    joined = df.join(F.broadcast(off) if bounded_partitions else off, [*part, bucket])
    return joined.select(
        *df.columns,
        *[(F.coalesce(F.sum(s).over(w_in), F.lit(0)) + F.col(f"_off_{s}")).alias(f"cum_{s}") for s in sums],
        *([F.col(f"tot_{s}") for s in sums] if totals else []),
    )


def rank_within(df: DataFrame, partition: Sequence[str], key: str, seed: int) -> DataFrame:
    """Add ``_rank`` (1-based) = position of the row in its partition when
    ordered by a seeded hash of ``key`` (key breaks hash ties).

    ``key`` is expected to be unique (one row per applicant): hash buckets
    then hold ~n / 65,536 rows each whatever the class skew.
    """
    h = seeded_hash(key, seed)
    tagged = df.withColumn("_h", h).withColumn("_hb", hash_bucket(F.col("_h"))).withColumn("_one", F.lit(1))
    out = running_totals(tagged, ["_h", key], ["_one"], partition, bucket="_hb", inclusive=True)
    return out.withColumnRenamed("cum__one", "_rank").drop("_h", "_hb", "_one")


def stratified_folds(df: DataFrame, label: str, key: str, k: int = 3, seed: int = 42) -> DataFrame:
    """Add ``fold`` in [0, k): within each class, rows ordered by a seeded
    hash are dealt round-robin, so per-class fold sizes differ by at most 1."""
    ranked = rank_within(df, [label], key, seed)
    return ranked.withColumn("fold", ((F.col("_rank") - 1) % k).cast("int")).drop("_rank")


def class_counts(df: DataFrame, label: str) -> dict:
    return {r[label]: r["n"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}


def stratified_sample(df: DataFrame, label: str, key: str, n: int, seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows (or all), each class kept in proportion.

    Quotas follow the largest-remainder rule on ``n * share``; the rows kept
    in a class are the first ones in seeded-hash order.
    """
    counts = class_counts(df, label)
    total = sum(counts.values())
    if n >= total:
        return df
    quotas = _largest_remainder(counts, n, total)
    q = df.sparkSession.createDataFrame([(c, int(v)) for c, v in quotas.items()], [label, "_quota"])
    ranked = rank_within(_first_buckets(df, label, key, q, seed), [label], key, seed)
    return ranked.join(F.broadcast(q), label).where(F.col("_rank") <= F.col("_quota")).drop("_rank", "_quota")


def _first_buckets(df: DataFrame, label: str, key: str, quotas: DataFrame, seed: int) -> DataFrame:
    """Of each class, the buckets of the hash order that hold its first ``_quota`` rows.

    These rows lie before all others, so ranks among them are ranks among all,
    and only they are shuffled.
    """
    bucket = hash_bucket(seeded_hash(key, seed))
    before = Window.partitionBy(label).orderBy("_hb").rowsBetween(Window.unboundedPreceding, -1)
    some = df.groupBy(label, bucket.alias("_hb")).agg(F.count(F.lit(1)).alias("_n"))
    some = some.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    last = some.join(F.broadcast(quotas), label).where(F.col("_before") < F.col("_quota")).groupBy(label).agg(F.max("_hb").alias("_last"))
    return df.join(F.broadcast(last), label).where(bucket <= F.col("_last")).select(*df.columns)


def _largest_remainder(counts: dict, n: int, total: int) -> dict:
    exact = {c: n * v / total for c, v in counts.items()}
    base = {c: int(x) for c, x in exact.items()}
    left = n - sum(base.values())
    order = sorted(counts, key=lambda c: (-(exact[c] - base[c]), str(c)))
    for c in order[:left]:
        base[c] += 1
    return base


def undersample(df: DataFrame, label: str, key: str, seed: int = 42) -> DataFrame:
    """Every class cut to the minority count (first rows in seeded-hash order)."""
    counts = class_counts(df, label)
    n_min = min(counts.values())
    return rank_within(df, [label], key, seed).where(F.col("_rank") <= n_min).drop("_rank")


def seeded_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows chosen by smallest seeded hash (a top-k, not a scan)."""
    return df.withColumn("_h", seeded_hash(key, seed)).orderBy("_h", key).limit(n).drop("_h")
