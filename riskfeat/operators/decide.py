"""Decision rules on scores: approval, review bands, pilot assignment, and
group approval rates / gaps (fairness view)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as X
from .ranks import seeded_hash

# Fixed values from the reference's decision policy.
APPROVE_BELOW = 0.30
REVIEW_BELOW = 0.40
BAND_LABELS = ("approve", "review", "deny")
PILOT_PERCENT = 20


def approved(score: str = "SCORE", threshold: float = 0.35) -> Column:
    """1 when the default probability is below the threshold."""
    return (F.col(score) < F.lit(threshold)).cast("int")


def decision_band(score: str = "SCORE") -> Column:
    return X.bucketize(score, (APPROVE_BELOW, REVIEW_BELOW), BAND_LABELS)


def band_summary(df: DataFrame, score: str = "SCORE", label: str = "TARGET") -> DataFrame:
    return df.groupBy(decision_band(score).alias("band")).agg(
        F.count(F.lit(1)).alias("n"),
        X.count_if(F.col(label) == 1).alias("defaults"),
        F.avg(F.col(label).cast("double")).alias("default_rate"),
    )


def pilot_flag(key: str = "SK_ID_CURR", percent: int = PILOT_PERCENT, seed: int = 7) -> Column:
    """Stable pilot assignment: a seeded hash of the key, ``percent`` in 100."""
    return (F.pmod(seeded_hash(key, seed), F.lit(100)) < F.lit(percent)).cast("int")


def approval_by_group(df: DataFrame, group: str, score: str = "SCORE", threshold: float = 0.35) -> DataFrame:
    """Approval rate (%) per group value; rows with a null group are left out."""
    return (
        df.where(F.col(group).isNotNull())
        .groupBy(group)
        .agg(F.count(F.lit(1)).alias("n"), (F.avg(approved(score, threshold).cast("double")) * 100).alias("approval_pct"))
    )


def group_gap(df: DataFrame, group: str = "CODE_GENDER", a: str = "M", b: str = "F",
              score: str = "SCORE", threshold: float = 0.35) -> DataFrame:
    """Approval-rate difference ``a - b`` in percentage points."""
    rates = approval_by_group(df, group, score, threshold)
    return rates.agg(
        (F.max(F.when(F.col(group) == a, F.col("approval_pct")))
         - F.max(F.when(F.col(group) == b, F.col("approval_pct")))).alias("gap_points")
    )


def fairness_frame(demographics: DataFrame, labels: DataFrame, scores: DataFrame, key: str = "SK_ID_CURR") -> DataFrame:
    """Demographics, label and score of each applicant, joined by key (inner)
    rather than attached by row position."""
    return demographics.join(labels, key, "inner").join(scores, key, "inner")
