"""Explanations: adverse-action reasons per denied applicant and permutation
importance of a fitted scorer.

Reasons: every feature in the reason map gets an adverse strength in [0, 1]
(min-max scaled in its bad direction); the reasons of a row are sorted in an
array of the row and the top ``k`` kept: one primary reason plus secondary ones.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import boost as B

SCORED_ROWS = 2048  # rows that are scored together, as they are and once per column


@dataclass(frozen=True)
class Reason:
    feature: str
    direction: str  # "low" or "high": which side is adverse
    text: str


# The reference's adverse-action mapping (feature, adverse side, text).
REASON_MAP = (
    Reason("EXT_SOURCE_2", "low", "Limited external credit history"),
    Reason("EXT_SOURCE_3", "low", "Insufficient credit bureau history"),
    Reason("AGE_YEARS", "low", "Limited financial track record"),
    Reason("CREDIT_TO_INCOME_RATIO", "high", "Debt obligations high relative to income"),
    Reason("BUREAU_TOTAL_CREDIT", "low", "Limited credit history with lenders"),
)


def top_reasons(
    df: DataFrame,
    reasons: Sequence[Reason] = REASON_MAP,
    key: str = "SK_ID_CURR",
    k: int = 5,
    denied: F.Column | None = None,
) -> DataFrame:
    """``(key, reason_rank, feature, reason, strength)`` for the rows selected
    by ``denied`` (all rows if None); rank 1 is the primary reason."""
    reasons = list(reasons)
    # population min / max per feature over finite values: one small aggregate, used as literals
    def finite(c: str):
        x = F.col(c).cast("double")
        return F.when(F.abs(x) < F.lit(float("inf")), x)  # NaN is above infinity in Spark's order

    stats = df.agg(*[x for r in reasons for x in (F.min(finite(r.feature)).alias(f"lo_{r.feature}"),
                                                   F.max(finite(r.feature)).alias(f"hi_{r.feature}"))]).first()
    base = df if denied is None else df.where(denied)
    rows = base.select(key, *[r.feature for r in reasons])

    def strength(r: Reason):
        lo = F.lit(stats[f"lo_{r.feature}"]).cast("double")
        hi = F.lit(stats[f"hi_{r.feature}"]).cast("double")
        # an infinite value counts as the end of the range it lies beyond
        x = F.col(r.feature).cast("double")
        x = F.when(x == F.lit(float("inf")), hi).when(x == F.lit(float("-inf")), lo).otherwise(x)
        num = (x - lo) if r.direction == "high" else (hi - x)
        return F.when(hi > lo, num.cast("double") / (hi - lo).cast("double")).otherwise(F.lit(0.0))

    # strongest first, then by name; a handful of entries sorted inside each row, no window and no shuffle
    by_name = {f: i for i, f in enumerate(sorted(r.feature for r in reasons))}
    entries = F.sort_array(F.array(*[
        F.struct(strength(r).alias("strength"), F.lit(-by_name[r.feature]).alias("name"), F.lit(r.feature).alias("feature"), F.lit(r.text).alias("reason"))
        for r in reasons
    ]), asc=False)
    long = rows.select(key, F.posexplode(F.slice(entries, 1, k)).alias("pos", "r"))
    return long.select(key, "r.feature", "r.reason", "r.strength", (F.col("pos") + 1).alias("reason_rank"))


def permutation_drops(
    matrix: DataFrame,
    sources: dict[str, Sequence[int]],
    model: B.Model,
    key: str = "SK_ID_CURR",
    label: str = "TARGET",
    seed: int = 42,
    features: str = "features",
) -> list[tuple[str, float]]:
    """AUC drop per permuted source column, all columns scored in one pass.

    ``sources`` names the places in the feature vector that a column fills (an
    encoded one fills several). Rows are ranked by two seeded hashes of the key
    (distributed ranks); the row with rank r donates its values to the row with
    rank r in the other order. The donor ranking does not depend on the column,
    so one join serves all. A task scores its rows as they are and once per
    column, by the trees that the column enters; nothing but the counts per score
    is written, and ``roc_auc_by`` gives every AUC.
    """
    from . import evaluate, ranks

    groups = list(sources.values())
    bc = matrix.sparkSession.sparkContext.broadcast((model, groups))

    def ranked(s: int, name: str) -> DataFrame:
        rows = ranks.rank_within(matrix.withColumn("_all", F.lit(0)), ["_all"], key, s)
        return rows.select("_rank", F.col(label).cast("double").alias("_y"), vector_to_array(features).alias(name))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, places = bc.value
        for whole in batches:
            for at in range(0, whole.num_rows, SCORED_ROWS):
                b = whole.slice(at, SCORED_ROWS)
                x, d = B.matrix_of(b.column("x")).copy(), B.matrix_of(b.column("d"))
                for i, margin in enumerate(trees.margins_with(x, d, places)):
                    with np.errstate(over="ignore"):
                        p = B.probability(margin)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(p), i, np.int32)), b.column("_y"), pa.array(p)], names=["_feature", "_y", "SCORE"])

    joined = ranked(seed, "x").join(ranked(seed + 1, "d").drop("_y"), "_rank").select("_y", "x", "d")
    scored = joined.mapInArrow(run, "_feature int, _y double, SCORE double")
    aucs = {r["_feature"]: r["auc"] for r in evaluate.roc_auc_by(scored, "_feature", "_y", "SCORE").collect()}
    return sorted(((f, aucs[0] - aucs[i + 1]) for i, f in enumerate(sources)), key=lambda t: (-t[1], t[0]))
