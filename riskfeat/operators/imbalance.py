"""Class imbalance treatments: balanced class weights (and, in
``smote.py``, synthetic minority rows)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def class_weights(df: DataFrame, label: str = "TARGET") -> DataFrame:
    """``balanced`` weights n / (k * n_class), one row per class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    # one row per class: windows over this tiny table give total and k
    everything = Window.partitionBy()
    return counts.select(
        label, "n",
        (F.sum("n").over(everything).cast("double") / (F.count(F.lit(1)).over(everything) * F.col("n"))).alias("weight"),
    )


def with_weights(df: DataFrame, label: str = "TARGET", weight_col: str = "weight") -> DataFrame:
    """Attach the class weight to every row (broadcast of a k-row table)."""
    w = class_weights(df, label).select(label, F.col("weight").alias(weight_col))
    return df.join(F.broadcast(w), label)
