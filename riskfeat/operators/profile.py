"""Profiles and summaries: per-column statistics, class balance, score summary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exprs as X
from . import quantiles
from .fit import numeric_columns

SUMMARY_SCALE = 4


def feature_summary(df: DataFrame, columns: Sequence[str] | None = None, scale: int = SUMMARY_SCALE) -> DataFrame:
    """count, null_count, mean, std (sample), min, 25/50/75% (linear), max.

    Where all values of a column are whole multiples of 10^-scale, sums and
    sums of squares are exact decimals, so mean and std do not depend on
    partitioning; any other column gets double mean and std, with NaN and
    infinities by IEEE rules. Quantiles are exact (bracketed, never a whole
    column in one task). One row per column.
    """
    cols = list(columns or numeric_columns(df, ()))
    # one set of aggregates over (column, value), combined before the shuffle to a row per
    # column and task: hundreds of columns do not make hundreds of aggregates to compile
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v")) for c in cols])
    v = F.col("v")
    fits, _ = X.money_units(v, scale)
    x = F.when(fits, v).cast(f"decimal(18,{scale})")
    n, s, q = F.col("count"), F.col("s"), F.col("q")
    stats = df.select(F.explode(pairs).alias("p")).select("p.*").groupBy("column_name").agg(
        F.count("v").alias("count"),
        F.count_if(v.isNull()).alias("null_count"),
        F.coalesce(F.bool_and(fits), F.lit(True)).alias("ok"),
        F.avg(v).alias("avg"),
        F.stddev_samp(v).alias("dev"),
        F.sum(x).cast("double").alias("s"),
        F.sum(x * x).cast("double").alias("q"),
        F.min(v).alias("min"),
        F.max(v).alias("max"),
    ).select(
        "column_name", "count", "null_count",
        F.when(F.col("ok"), F.try_divide(s, n.cast("double"))).otherwise(F.col("avg")).alias("mean"),
        F.when(~F.col("ok"), F.col("dev")).when(n > 1, F.sqrt((q - s * s / n) / (n - 1))).alias("std"),
        "min", "max",
    )
    shares = (0.25, 0.5, 0.75)
    found = quantiles.exact_quantiles_multi(df, cols, shares)
    rows = [(c, *[found[c, p] for p in shares]) for c in cols]
    qdf = df.sparkSession.createDataFrame(rows, "column_name string, q25 double, q50 double, q75 double")
    # a table without rows has no pairs: its columns have zero counts
    return qdf.join(stats, "column_name", "left").select(
        "column_name", F.coalesce("count", F.lit(0)).alias("count"), F.coalesce("null_count", F.lit(0)).alias("null_count"),
        "mean", "std", "min", "max", "q25", "q50", "q75")


def class_balance(df: DataFrame, label: str = "TARGET") -> DataFrame:
    """Rows and share per class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    # one row per class: a window over this tiny table gives the total
    return counts.select(label, "n", (F.col("n") / F.sum("n").over(Window.partitionBy())).alias("share"))


def default_rate(df: DataFrame, label: str = "TARGET") -> DataFrame:
    return df.agg(F.avg(F.col(label).cast("double")).alias("default_rate"))


def score_summary(df: DataFrame, score: str = "SCORE", scale: int = 6) -> DataFrame:
    """min / max / mean of a score column (mean free of row order if all scores have at most ``scale`` decimals)."""
    return df.agg(
        F.min(score).alias("min_score"),
        F.max(score).alias("max_score"),
        X.mean(score, scale).alias("mean_score"),
        F.count(score).alias("n"),
    )


def prefix_counts(columns: Sequence[str], prefixes: Sequence[str]) -> dict[str, int]:
    """Number of columns per name prefix (metadata only, no job)."""
    return {p: sum(1 for c in columns if c.startswith(p)) for p in prefixes}


# The columns a preview of the processed frame shows, in this order.
PREVIEW_FEATURES = (
    "SK_ID_CURR", "TARGET", "AGE_YEARS", "EMPLOYMENT_YEARS",
    "CREDIT_TO_INCOME_RATIO", "ANNUITY_TO_INCOME_RATIO",
    "FLAG_UNEMPLOYED_UNKNOWN", "EXT_SOURCE_MEAN",
    "BUREAU_NUM_CREDITS", "PREV_APPROVAL_RATE",
    "INST_LATE_PAYMENT_RATE", "CC_UTILIZATION_RATE",
)
FEATURE_PREFIXES = ("FLAG_MISSING_", "EXT_SOURCE_", "BUREAU_", "PREV_", "INST_", "CC_", "POS_")


def feature_preview(df: DataFrame, features=PREVIEW_FEATURES) -> DataFrame:
    """Per existing preview feature: non-null count, null count, min, max (one pass)."""
    present = [c for c in features if c in df.columns]
    wide = df.agg(F.count(F.lit(1)).alias("__rows"), *[x for i, c in enumerate(present) for x in (
        F.count(F.col(c)).alias(f"n{i}"), F.min(F.col(c)).cast("double").alias(f"lo{i}"),
        F.max(F.col(c)).cast("double").alias(f"hi{i}"))])
    stack = F.explode(F.array(*[F.struct(
        F.lit(c).alias("column_name"), F.col(f"n{i}").alias("count"),
        (F.col("__rows") - F.col(f"n{i}")).alias("null_count"),
        F.col(f"lo{i}").alias("min"), F.col(f"hi{i}").alias("max")) for i, c in enumerate(present)]))
    return wide.select(stack.alias("s")).select("s.*")


def preview_rows(df: DataFrame, features=PREVIEW_FEATURES, n: int = 10, key: str = "SK_ID_CURR") -> DataFrame:
    """The existing preview features of the first ``n`` rows by key (a table has no other order)."""
    return df.select(*[c for c in features if c in df.columns]).orderBy(key).limit(n)


def preview_statistics(df: DataFrame, features=PREVIEW_FEATURES) -> DataFrame:
    """Full statistics (as ``processed_summary``) of the existing preview features."""
    return processed_summary(df.select(*[c for c in features if c in df.columns]))


def processed_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Summary of every numeric column of a processed frame over its finite values.

    Ratios may be infinite or NaN where a denominator is 0; as in the feature
    matrix those count as missing here, so that one row does not take the mean
    and the spread of its column away.
    """
    cols = list(columns or numeric_columns(df, ()))
    def known(c: str):
        x = F.col(c).cast("double")
        return F.when(F.abs(x) < F.lit(float("inf")), x).alias(c)

    return feature_summary(df.select(*[known(c) for c in cols]), cols)


CATEGORIES = {"Bureau Features": "BUREAU_", "Previous App Features": "PREV_", "Installment Features": "INST_",
              "Credit Card Features": "CC_", "POS Cash Features": "POS_"}


def category_counts(columns: Sequence[str]) -> dict[str, int]:
    """Columns per category of the processed frame; what no history made is an application feature."""
    made = {name: sum(c.startswith(p) for c in columns) for name, p in CATEGORIES.items()}
    return {"Application Features": len(columns) - sum(made.values()), **made}


def prefix_count_rows(columns, prefixes=FEATURE_PREFIXES) -> list[tuple[str, int]]:
    return [(p, n) for p, n in prefix_counts(columns, prefixes).items()]
