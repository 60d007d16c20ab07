"""Score evaluation over ``(key, label, score)``: exact ROC-AUC, ROC points,
threshold metrics, confusion matrix and the profit sweep.

Every query is a handful of aggregates. Rank-based ones (AUC, ROC) group by
distinct score first and use bucketed running totals, so no window spans the
whole table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..session import checkpoint
from . import ranks


@dataclass(frozen=True)
class EconParams:
    """Decision economics (fixed values of the reference's analysis)."""

    profit_per_repaid: float = 2500.0
    loss_per_default: float = -8000.0
    recovery_rate: float = 0.20  # stated, not used in the EV formula
    applicants: int = 100000
    threshold: float = 0.35


DEFAULT_ECON = EconParams()


def score_counts(df: DataFrame, label: str = "TARGET", score: str = "SCORE") -> DataFrame:
    """``(score, pos, neg)`` per distinct score; partial aggregation map-side."""
    return df.where(F.col(score).isNotNull()).groupBy(F.col(score).alias("score")).agg(
        X.count_if(F.col(label) == 1).alias("pos"),
        X.count_if(F.col(label) != 1).alias("neg"),
    )


def _cumulated(df: DataFrame, label: str, score: str, buckets: int) -> DataFrame:
    g = ranks.value_bucket(_counted(df, label, score), "score", buckets)
    return ranks.running_totals(g, ["score"], ["pos", "neg"], bucket="_b")


def _counted(df: DataFrame, label: str, score: str) -> DataFrame:
    """Counts per score, written once: the sketch and both sides of the running
    totals read them, and scores may come from a model."""
    return checkpoint(score_counts(df, label, score))


def roc_auc(df: DataFrame, label: str = "TARGET", score: str = "SCORE", buckets: int = 1024) -> DataFrame:
    """Exact ROC-AUC (ties count one half) as a one-row DataFrame ``auc``.

    AUC = sum over scores of pos * (2 * negatives below + neg) / (2 * P * N),
    summed in whole numbers wide enough for any row count. Null if a class is
    missing.
    """
    return _cumulated(df, label, score, buckets).agg(_auc().alias("auc"))


def _auc():
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    pairs = F.sum((wide("pos") * (wide("cum_neg") * 2 + wide("neg"))).cast("decimal(38,0)")).cast("double")
    both = F.sum("pos").cast("double") * F.sum("neg").cast("double") * 2.0
    return F.when(both > 0, F.try_divide(pairs, both))


def roc_auc_by(df: DataFrame, group: str, label: str = "TARGET", score: str = "SCORE",
               buckets: int = 1024) -> DataFrame:
    """Exact AUC per value of ``group`` (e.g. a week): ``(group, n, auc)``.

    Score buckets are shared by all groups; the running totals are partitioned
    by (group, bucket), so no group is ranked in a single task.
    """
    g = (df.where(F.col(score).isNotNull())
         .groupBy(F.col(group), F.col(score).alias("score"))
         .agg(X.count_if(F.col(label) == 1).alias("pos"), X.count_if(F.col(label) != 1).alias("neg")))
    b = ranks.value_bucket(checkpoint(g), "score", buckets)
    c = ranks.running_totals(b, ["score"], ["pos", "neg"], partition=[group], bucket="_b", bounded_partitions=False)
    return c.groupBy(group).agg(
        (F.sum("pos") + F.sum("neg")).alias("n"),
        _auc().alias("auc"),
    )


def roc_points(df: DataFrame, label: str = "TARGET", score: str = "SCORE", buckets: int = 1024) -> DataFrame:
    """One ROC point per distinct score: predicting 1 for ``score >= threshold``
    (a rate is null if its class is missing)."""
    g = ranks.value_bucket(_counted(df, label, score), "score", buckets)
    c = ranks.running_totals(g, ["score"], ["pos", "neg"], bucket="_b", totals=True)
    return c.select(
        F.col("score").alias("threshold"),
        F.try_divide(F.col("tot_pos") - F.col("cum_pos"), F.col("tot_pos")).alias("tpr"),
        F.try_divide(F.col("tot_neg") - F.col("cum_neg"), F.col("tot_neg")).alias("fpr"),
    )


def threshold_metrics(df: DataFrame, threshold: float = 0.35, label: str = "TARGET", score: str = "SCORE") -> DataFrame:
    """Precision, recall, F1 and approval rate when ``score >= threshold`` means
    "predicted default"; a zero denominator gives 0. Rows without a score
    take no part, as in every evaluation here; without rows the rate is null."""
    df = df.where(F.col(score).isNotNull())
    pred = F.col(score) >= F.lit(threshold)
    y = F.col(label) == 1
    agg = df.agg(
        X.count_if(pred & y).alias("tp"),
        X.count_if(pred & ~y).alias("fp"),
        X.count_if(~pred & y).alias("fn"),
        F.count(F.lit(1)).alias("n"),
        X.count_if(pred).alias("n_pred"),
    )
    tp, fp, fn = F.col("tp").cast("double"), F.col("fp").cast("double"), F.col("fn").cast("double")
    return agg.select(
        F.lit(threshold).alias("threshold"),
        F.when(tp + fp > 0, tp / (tp + fp)).otherwise(0.0).alias("precision"),
        F.when(tp + fn > 0, tp / (tp + fn)).otherwise(0.0).alias("recall"),
        F.when(2 * tp + fp + fn > 0, 2 * tp / (2 * tp + fp + fn)).otherwise(0.0).alias("f1"),
        (F.lit(1.0) - F.try_divide(F.col("n_pred"), F.col("n"))).alias("approval_rate"),
    )


def confusion(df: DataFrame, threshold: float = 0.35, label: str = "TARGET", score: str = "SCORE") -> DataFrame:
    """All four cells ``(actual, predicted, n)``, zeros included."""
    spark = df.sparkSession
    cells = spark.createDataFrame([(a, p) for a in (0, 1) for p in (0, 1)], "actual int, predicted int")
    counts = df.groupBy(
        F.col(label).cast("int").alias("actual"),
        (F.col(score) >= F.lit(threshold)).cast("int").alias("predicted"),
    ).agg(F.count(F.lit(1)).alias("n"))
    return cells.join(counts, ["actual", "predicted"], "left").select(
        "actual", "predicted", F.coalesce("n", F.lit(0)).alias("n")
    )


def threshold_sweep(
    df: DataFrame,
    label: str = "TARGET",
    score: str = "SCORE",
    steps: int = 100,
    econ: EconParams = DEFAULT_ECON,
) -> DataFrame:
    """Approval, default rate among approved, EV per loan and total profit
    (millions, per ``econ.applicants``) for thresholds ``i * (1/steps)``.

    One pass: each row gets the first threshold index at which it would be
    approved (``score < t``); a histogram over those indices plus running
    sums gives all thresholds at once (no cross join with the grid).
    """
    spark = df.sparkSession
    step = 1.0 / steps
    p = F.col(score)
    c = F.floor(p * F.lit(float(steps))).cast("long")

    def t(i):
        return i.cast("double") * F.lit(step)

    first = (
        F.when(p < t(c - 1), c - 1).when(p < t(c), c).when(p < t(c + 1), c + 1).otherwise(c + 2)
    )
    idx = F.greatest(F.least(first, F.lit(steps + 1)), F.lit(0))
    hist = df.where(p.isNotNull()).groupBy(idx.alias("i")).agg(
        F.count(F.lit(1)).alias("n"), X.count_if(F.col(label) == 1).alias("d")
    )
    grid = spark.range(steps + 1).withColumnRenamed("id", "i")
    w = Window.orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # the histogram has at most steps + 2 rows: a global window over it is tiny
    cum = (
        grid.join(hist, "i", "full")
        .select("i", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("d", F.lit(0)).alias("d"))
        .select("i", F.sum("n").over(w).alias("approved"), F.sum("d").over(w).alias("defaults"),
                F.sum("n").over(Window.partitionBy()).alias("total"))
        .where(F.col("i") <= steps)
    )
    approval = F.lit(1.0) - (F.col("total") - F.col("approved")).cast("double") / F.col("total").cast("double")
    default_rate = F.when(
        approval > 0,
        F.when(F.col("approved") > 0, F.col("defaults").cast("double") / F.col("approved").cast("double")).otherwise(0.0),
    ).otherwise(0.0)
    num_approved = approval * F.lit(float(econ.applicants))
    num_defaults = num_approved * default_rate
    num_repay = num_approved - num_defaults
    profit = num_repay * F.lit(econ.profit_per_repaid) + num_defaults * F.lit(econ.loss_per_default)
    return cum.select(
        (F.col("i").cast("double") * F.lit(step)).alias("threshold"),
        approval.alias("approval_rate"),
        default_rate.alias("default_rate"),
        F.when(num_approved > 0, profit / num_approved).otherwise(0.0).alias("expected_value"),
        (profit / F.lit(1e6)).alias("total_profit"),
    )


def best_threshold(sweep: DataFrame) -> DataFrame:
    """Threshold with the highest total profit (lowest threshold on ties)."""
    return sweep.orderBy(F.col("total_profit").desc(), F.col("threshold").asc()).limit(1)


def majority_baseline(df: DataFrame, label: str = "TARGET") -> DataFrame:
    """Always predict 0: accuracy is the share of 0s; AUC is defined as 0.5."""
    return df.agg(
        (X.count_if(F.col(label) == 0) / F.count(F.lit(1))).alias("accuracy"),
        F.lit(0.5).alias("auc"),
    )


def expected_value(p_default: float, econ: EconParams = DEFAULT_ECON) -> float:
    """EV of approving one loan with default probability ``p_default``."""
    return (1 - p_default) * econ.profit_per_repaid + p_default * econ.loss_per_default
