"""Encoding and matrix preparation: one-hot indicators, column alignment,
name sanitising and the ML feature vector.

Categories are learnt once from the training frame (a distinct-per-column
aggregate whose size is checked) and replayed on any other frame, so train
and test always get the same indicator columns.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

class TooManyCategories(ValueError):
    pass


@dataclass(frozen=True)
class OneHotPlan:
    categories: dict[str, tuple[str, ...]]
    drop_first: bool = True

    def indicator_names(self) -> list[str]:
        names = []
        for c, values in self.categories.items():
            kept = values[1:] if self.drop_first else values
            names += [f"{c}_{v}" for v in kept]
        return names


def fit_one_hot(df: DataFrame, columns: Sequence[str], drop_first: bool = True,
                max_categories: int | None = None) -> OneHotPlan:
    """Sorted distinct non-null values per column, in one aggregation job.

    The distinct values become columns, so they are collected. With
    ``max_categories``, a column with more values is refused, never truncated.
    """
    columns = list(columns)
    if not columns:
        return OneHotPlan({}, drop_first)
    pairs = [F.struct(F.lit(i).alias("c"), F.col(c).cast("string").alias("v")) for i, c in enumerate(columns)]
    distinct = (
        df.select(F.explode(F.array(*pairs)).alias("p")).select("p.c", "p.v")
        .where(F.col("v").isNotNull()).distinct()
    )
    if max_categories is not None:
        sizes = {r["c"]: r["k"] for r in distinct.groupBy("c").agg(F.count(F.lit(1)).alias("k")).collect()}
        too_big = {columns[i]: k for i, k in sizes.items() if k > max_categories}
        if too_big:
            raise TooManyCategories(f"columns over {max_categories} categories: {too_big}")
    found: dict[int, list[str]] = {}
    for r in distinct.collect():
        found.setdefault(r["c"], []).append(r["v"])
    cats = {c: tuple(sorted(found.get(i, []))) for i, c in enumerate(columns)}
    return OneHotPlan(cats, drop_first)


def one_hot_columns(plan: OneHotPlan) -> list[Column]:
    out = []
    for c, values in plan.categories.items():
        kept = values[1:] if plan.drop_first else values
        for v in kept:
            out.append(F.when(F.col(c) == F.lit(v), F.lit(1)).otherwise(F.lit(0)).alias(f"{c}_{v}"))
    return out


def one_hot(df: DataFrame, plan: OneHotPlan, keep_source: bool = False) -> DataFrame:
    """Replace each encoded column by its indicators (null -> all zeros)."""
    rest = [F.col(c) for c in df.columns if keep_source or c not in plan.categories]
    return df.select(*rest, *one_hot_columns(plan))


def align(df: DataFrame, reference_columns: Sequence[str], fill_value=0) -> DataFrame:
    """Reorder to ``reference_columns``; add missing ones as ``fill_value``,
    drop columns the reference does not have."""
    have = set(df.columns)
    return df.select(*[F.col(c) if c in have else F.lit(fill_value).alias(c) for c in reference_columns])


_BAD = re.compile(r"[^A-Za-z0-9_]")


def sanitize_names(df: DataFrame) -> DataFrame:
    """Replace characters outside ``[A-Za-z0-9_]`` with ``_``; refuse collisions."""
    new = [_BAD.sub("_", c) for c in df.columns]
    if len(set(new)) != len(new):
        dup = sorted({n for n in new if new.count(n) > 1})
        raise ValueError(f"sanitised names collide: {dup}")
    return df.toDF(*new)


def numeric_feature_columns(df: DataFrame, exclude: Sequence[str]) -> list[str]:
    from pyspark.sql import types as T

    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, (T.NumericType, T.BooleanType)) and f.name not in set(exclude)]


def nonfinite_to_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NaN and +/-inf become null (then the median fill applies), one projection."""
    cols = set(columns)
    return df.select(*[
        F.when(F.isnan(F.col(c)) | (F.abs(F.col(c)) == float("inf")), F.lit(None)).otherwise(F.col(c)).cast("double").alias(c)
        if c in cols else F.col(c)
        for c in df.columns
    ])
