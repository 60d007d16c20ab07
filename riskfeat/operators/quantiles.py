"""Exact quantiles of many columns, side by side, with no column in one task.

Spark's exact ``percentile`` keeps a value->count map per column; the final
merge holds every distinct value of a column in a single task. Here sketches
bracket the answer and only values inside the bracket are looked at one by one:

1. one plain aggregate takes a KLL sketch and a count of every column (bounded
   state, nothing is exploded). Sketches merge in two steps, first within a
   bounded number of groups of tasks, so that no task merges those of all tasks;
2. one plain aggregate counts, for every target, the rows below and inside its
   bracket: exact ranks. A bracket that missed opens up again; one that still
   holds too many rows is sketched again, inside;
3. the values inside the brackets, a small share of the rows, become rows
   ``(target, value)``, are counted per distinct value and ranked.

A small table goes straight to step 3: its distinct values are counted at once.
The result is always exact; a sketch only decides how much work step 3 has.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NEG, POS = float("-inf"), float("inf")
MERGE_WAYS = 64
SMALL_ROWS = 100_000


@dataclass
class Target:
    """A rank pair of one column, and the bracket [lo, hi] that shall hold it."""

    column: int
    q: float
    n: int
    lo: float = NEG
    hi: float = POS
    below: int = 0
    inside: int = 0
    stuck: bool = False
    value: float | None = None

    def __post_init__(self):
        self.inside = self.n
        pos = (self.n - 1) * self.q
        self.k1, self.k2, self.w = math.floor(pos) + 1, math.ceil(pos) + 1, pos - math.floor(pos)

    def between(self, v1: float, v2: float) -> float:
        return v1 if self.w == 0 or v1 == v2 else v1 + (v2 - v1) * self.w


def _rank_error(k: int) -> float:
    """Twice the rank error that a KLL sketch of parameter k keeps with 99 % confidence."""
    return 2 * 2.296 / k**0.9723


def _sketches(df: DataFrame, values: Sequence[Column], shares: Sequence[Sequence[float]], k: int) -> list[tuple[int, list[float]]]:
    """Count and the values at ``shares`` of each expression (nulls and NaN ignored), in one pass over ``df``."""
    wide = df.select(F.pmod(F.spark_partition_id(), F.lit(MERGE_WAYS)).alias("_way"),
                     *[F.when(~F.isnan(v), v).alias(f"v{i}") for i, v in enumerate(values)])
    some = wide.groupBy("_way").agg(*[x for i in range(len(values)) for x in (
        F.count(f"v{i}").alias(f"n{i}"), F.kll_sketch_agg_double(f"v{i}", F.lit(k)).alias(f"s{i}"))])
    whole = some.agg(*[x for i in range(len(values)) for x in (
        F.sum(f"n{i}").alias(f"n{i}"), F.kll_merge_agg_double(f"s{i}").alias(f"s{i}"))])
    row = whole.select(*[x for i in range(len(values)) for x in (f"n{i}", F.when(F.col(f"n{i}") > 0, F.kll_sketch_get_quantile_double(
        f"s{i}", F.array(*[F.lit(float(p)) for p in shares[i]]))).alias(f"g{i}"))]).first()
    return [(row[f"n{i}"] or 0, list(row[f"g{i}"] or [])) for i in range(len(values))]


def _bracket(lo_share: float, hi_share: float, got: Sequence[float]) -> tuple[float, float]:
    return (got[0] if lo_share > 0 else NEG), (got[1] if hi_share < 1 else POS)


def _inside(v: Column, t: Target) -> Column:
    return (v >= F.lit(t.lo)) & (v <= F.lit(t.hi))


def _count(df: DataFrame, values: Sequence[Column], targets: Sequence[Target]) -> None:
    """Rows below and inside every bracket; a bracket without its ranks opens up."""
    row = df.agg(*[x for i, t in enumerate(targets) for x in (
        F.count_if(values[t.column] < F.lit(t.lo)).alias(f"b{i}"), F.count_if(_inside(values[t.column], t)).alias(f"m{i}"))]).first()
    for i, t in enumerate(targets):
        t.below, t.inside = row[f"b{i}"], row[f"m{i}"]
        if not (t.below < t.k1 and t.k2 <= t.below + t.inside):
            t.lo, t.hi, t.below, t.inside = NEG, POS, 0, t.n
        elif t.lo == t.hi:
            t.value = t.lo


def _narrow(df: DataFrame, values: Sequence[Column], targets: Sequence[Target], k: int) -> None:
    """A sketch of the rows inside each bracket cuts it down."""
    eps = _rank_error(k)
    shares = [(max(0.0, (t.k1 - t.below - 1) / t.inside - eps), min(1.0, (t.k2 - t.below + 1) / t.inside + eps)) for t in targets]
    got = _sketches(df, [F.when(_inside(values[t.column], t), values[t.column]) for t in targets], shares, k)
    for t, s, (_, g) in zip(targets, shares, got):
        lo, hi = _bracket(*s, g) if g else (NEG, POS)
        lo, hi = max(t.lo, lo), min(t.hi, hi)
        t.stuck = (lo, hi) == (t.lo, t.hi)  # few distinct values: nothing to gain
        t.lo, t.hi = lo, hi


def _resolve(df: DataFrame, values: Sequence[Column], targets: Sequence[Target]) -> None:
    """Exact values at the ranks, from the distinct values inside the brackets."""
    found = F.filter(F.array(*[F.when(_inside(values[t.column], t), F.struct(F.lit(i).alias("t"), values[t.column].alias("u"))) for i, t in enumerate(targets)]),
                     lambda x: x.isNotNull())
    counted = df.select(F.explode(found).alias("x")).groupBy("x.t", "x.u").agg(F.count(F.lit(1)).alias("c"))
    ranks = df.sparkSession.createDataFrame([(i, t.k1 - t.below, t.k2 - t.below) for i, t in enumerate(targets)], "t int, k1 long, k2 long")
    w = Window.partitionBy("t").orderBy("u").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counted.withColumn("cum", F.sum("c").over(w)).join(F.broadcast(ranks), "t")  # a row per target
    holds = lambda k: (F.col("cum") >= F.col(k)) & (F.col("cum") - F.col("c") < F.col(k))
    rows = ranked.groupBy("t").agg(F.max(F.when(holds("k1"), F.col("u"))).alias("v1"), F.max(F.when(holds("k2"), F.col("u"))).alias("v2")).collect()
    for r in rows:
        if r["v1"] is not None and r["v2"] is not None:
            targets[r["t"]].value = targets[r["t"]].between(r["v1"], r["v2"])


def _of_small(df: DataFrame, values: Sequence[Column], qs: Sequence[float]) -> dict[tuple[int, int], float]:
    """``{(column, place in qs): value}`` from the counts of all distinct values, in one job."""
    pairs = F.filter(F.array(*[F.when(v.isNotNull() & ~F.isnan(v), F.struct(F.lit(i).alias("c"), v.alias("u"))) for i, v in enumerate(values)]), lambda x: x.isNotNull())
    counted = df.select(F.explode(pairs).alias("x")).groupBy("x.c", "x.u").agg(F.count(F.lit(1)).alias("k"))
    w = Window.partitionBy("c").orderBy("u")
    ranked = counted.select("c", "u", F.sum("k").over(w).alias("cum"), "k", F.sum("k").over(Window.partitionBy("c")).alias("n"))
    hits = []
    for j, q in enumerate(qs):
        pos = (F.col("n") - 1) * F.lit(float(q))
        for end, rank in (("a", F.floor(pos) + 1), ("b", F.ceil(pos) + 1)):
            hits.append(F.max(F.when((F.col("cum") >= rank) & (F.col("cum") - F.col("k") < rank), F.col("u"))).alias(f"{end}{j}"))
    out = {}
    for r in ranked.groupBy("c").agg(F.first("n").alias("n"), *hits).collect():
        for j, q in enumerate(qs):
            out[r["c"], j] = Target(r["c"], q, r["n"]).between(r[f"a{j}"], r[f"b{j}"])
    return out


def exact_quantiles_multi(
    df: DataFrame,
    cols: Sequence[str],
    qs: Sequence[float],
    accuracy: int = 10_000,
    max_exact: int = 2_000_000,
    max_rounds: int = 8,
    small_rows: int = SMALL_ROWS,
) -> dict[tuple[str, float], float | None]:
    """``{(column, q): value}`` with linear interpolation at position (n-1)*q,
    the definition of ``percentile`` / ``median``; nulls and NaN ignored, None
    for a column without values.

    ``accuracy`` sets the size of the sketches, ``max_exact`` the rows up to
    which a bracket is not sketched again, ``small_rows`` those up to which no
    sketch is taken.
    """
    cols, qs = list(cols), list(qs)
    out: dict[tuple[str, float], float | None] = {(c, q): None for c in cols for q in qs}
    if not cols or not qs:
        return out
    values = [F.col(c).cast("double") for c in cols]
    if df.select(F.lit(1)).limit(small_rows + 1).count() <= small_rows:
        for (i, j), v in _of_small(df, values, qs).items():
            out[cols[i], qs[j]] = v
        return out
    k = max(8, min(65_535, accuracy * 2048 // 10_000))
    eps = _rank_error(k)
    pairs = [(max(0.0, q - eps), min(1.0, q + eps)) for q in qs]
    targets: list[Target] = []
    for i, (n, got) in enumerate(_sketches(df, values, [[p for pair in pairs for p in pair]] * len(cols), k)):
        for j, q in enumerate(qs if n else []):
            t = Target(i, q, n)
            # a rank of one row must not fall out of a bracket of a small column
            t.lo, t.hi = _bracket(*pairs[j], got[2 * j:2 * j + 2]) if eps * n > 2 else (NEG, POS)
            targets.append(t)
    unsure = [t for t in targets if (t.lo, t.hi) != (NEG, POS)]
    for _ in range(max_rounds):
        if unsure:
            _count(df, values, unsure)
        wide = [t for t in targets if t.value is None and t.inside > max_exact and not t.stuck]
        if not wide:
            break
        _narrow(df, values, wide, k)
        unsure = wide
    open_ = [t for t in targets if t.value is None]
    if open_:
        _resolve(df, values, open_)
    for t in targets:
        if t.value is None:
            raise RuntimeError(f"quantile {t.q} of {cols[t.column]} was not found")
        out[(cols[t.column], t.q)] = t.value
    return out


def exact_quantiles(df: DataFrame, cols: Sequence[str], q: float = 0.5, **kw) -> dict[str, float | None]:
    res = exact_quantiles_multi(df, cols, [q], **kw)
    return {c: res[(c, q)] for c in cols}


def exact_medians(df: DataFrame, cols: Sequence[str], **kw) -> dict[str, float | None]:
    return exact_quantiles(df, cols, 0.5, **kw)
