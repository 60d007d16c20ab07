"""Exact attributions of linear scorers and the reasons that follow from them.

For a logistic model the contribution of feature j to a row's log-odds against
the average row is ``coef_j * (x_j - mean_j)``: the contributions of a row and
the log-odds of the mean row add up to the row's log-odds. They are array
expressions over a row's values, so they need no shuffle, no explode and no
second model call.

A missing or non-finite value counts as the mean and contributes nothing.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .explain import REASON_MAP, Reason


@dataclass(frozen=True)
class LinearScorer:
    """Log-odds = intercept + sum of coefficient * value; ``means`` are the values of the average row."""

    features: tuple[str, ...]
    coefficients: tuple[float, ...]
    intercept: float
    means: tuple[float, ...]

    def __post_init__(self):
        if not len(self.features) == len(self.coefficients) == len(self.means):
            raise ValueError("one coefficient and one mean per feature")

    @property
    def base(self) -> float:
        """Log-odds of the average row."""
        return self.intercept + math.fsum(c * m for c, m in zip(self.coefficients, self.means))

    def table(self, spark) -> DataFrame:
        """``(feature, coefficient, mean)``: the exported model."""
        rows = [(f, float(c), float(m)) for f, c, m in zip(self.features, self.coefficients, self.means)]
        return spark.createDataFrame(rows, "feature string, coefficient double, mean double")


def finite(c: Column) -> Column:
    """The value as a double; null if missing, NaN or infinite."""
    x = c.cast("double")
    return F.when(F.abs(x) < F.lit(float("inf")), x)


# ---------------------------------------------------------------- the scorer
def from_model(model, matrix: DataFrame, features: Sequence[str], vector: str = "features") -> LinearScorer:
    """Scorer of a fitted logistic regression; the means take one summary pass over ``matrix``."""
    means = matrix.select(Summarizer.mean(F.col(vector)).alias("m")).first()["m"]
    return LinearScorer(tuple(features), tuple(float(c) for c in model.coefficients.toArray()),
                        float(model.intercept), tuple(float(m) for m in means.toArray()))


def from_scorecard(df: DataFrame, coefficients: dict[str, float], intercept: float) -> LinearScorer:
    """Scorer of exported coefficients; the means of all columns take one aggregate over ``df``."""
    names = list(coefficients)
    row = df.agg(*[F.avg(finite(F.col(c))).alias(f"m{i}") for i, c in enumerate(names)]).first()
    means = tuple(float(row[f"m{i}"]) if row[f"m{i}"] is not None else 0.0 for i in range(len(names)))
    return LinearScorer(tuple(names), tuple(float(coefficients[c]) for c in names), float(intercept), means)


# ----------------------------------------------------------- row expressions
def values_of(scorer: LinearScorer) -> Column:
    """A wide row's values in the scorer's order (as against an assembled vector)."""
    return F.array(*[finite(F.col(c)) for c in scorer.features])


def contributions(scorer: LinearScorer, values: Column) -> Column:
    """``array<double>``, one signed contribution per feature, from an array of values."""
    weights = F.array(*[F.struct(F.lit(float(c)).alias("c"), F.lit(float(m)).alias("m"))
                        for c, m in zip(scorer.coefficients, scorer.means)])
    return F.zip_with(values, weights, lambda x, w: F.coalesce((finite(x) - w["m"]) * w["c"], F.lit(0.0)))


def total(parts: Column) -> Column:
    return F.aggregate(parts, F.lit(0.0), lambda a, x: a + x)


def log_odds(scorer: LinearScorer, parts: Column) -> Column:
    return F.lit(scorer.base) + total(parts)


def probability(logit: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))


# ------------------------------------------------------------------ queries
def attribute(df: DataFrame, scorer: LinearScorer, keep: Sequence[str], values: Column | None = None) -> DataFrame:
    """``(*keep, contributions, logit, SCORE)``; a narrow map over the rows."""
    out = df.select(*keep, contributions(scorer, values_of(scorer) if values is None else values).alias("contributions"))
    return out.withColumn("logit", log_odds(scorer, F.col("contributions"))).withColumn("SCORE", probability(F.col("logit")))


def per_feature(attributed: DataFrame, scorer: LinearScorer, keep: Sequence[str]) -> DataFrame:
    """``(*keep, feature, contribution)``: one row per feature of each row."""
    names = F.array(*[F.lit(f) for f in scorer.features])
    return attributed.select(*keep, F.explode(F.arrays_zip(names.alias("feature"), F.col("contributions").alias("contribution"))).alias("x")).select(*keep, "x.*")


def ranking(attributed: DataFrame, scorer: LinearScorer, top: int | None = 10) -> DataFrame:
    """``(feature, mean_abs, mean_signed, rank)`` by mean absolute contribution; one aggregate, nothing is exploded before it."""
    at = lambda i: F.get(F.col("contributions"), F.lit(i))
    means = attributed.agg(*[x for i in range(len(scorer.features)) for x in (F.avg(F.abs(at(i))).alias(f"a{i}"), F.avg(at(i)).alias(f"s{i}"))])
    rows = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"a{i}").alias("mean_abs"), F.col(f"s{i}").alias("mean_signed"))
                     for i, f in enumerate(scorer.features)])
    ordered = F.array_sort(rows, lambda a, b: F.when(a["mean_abs"] > b["mean_abs"], -1).when(a["mean_abs"] < b["mean_abs"], 1)
                           .when(a["feature"] < b["feature"], -1).otherwise(1))
    first = ordered if top is None else F.slice(ordered, 1, top)
    return means.select(F.posexplode(first).alias("pos", "x")).select("x.*", (F.col("pos") + 1).alias("rank"))


def signed_reasons(
    attributed: DataFrame,
    scorer: LinearScorer,
    keep: Sequence[str],
    reasons: Sequence[Reason] = REASON_MAP,
    k: int = 5,
    values: str = "values",
) -> DataFrame:
    """``(*keep, reason_rank, reason_kind, feature, reason, contribution)``.

    A reason counts if its feature pushes the row's log-odds up and its value
    lies on the reason's adverse side of the mean; the strongest comes first
    (the primary reason), ties by feature name, at most ``k``. All in arrays of
    the row: no window, no shuffle. ``values`` is the array column of the row's
    values in the scorer's order.
    """
    place = {f: i for i, f in enumerate(scorer.features)}
    unknown = [r.feature for r in reasons if r.feature not in place]
    if unknown:
        raise ValueError(f"the scorer has no feature {unknown}")

    def entry(r: Reason) -> Column:
        i = place[r.feature]
        part, x = F.get(F.col("contributions"), F.lit(i)), finite(F.get(F.col(values), F.lit(i)))
        adverse = (x > F.lit(scorer.means[i])) if r.direction == "high" else (x < F.lit(scorer.means[i]))
        # smallest first: the strongest push, then the name
        return F.when(adverse & (part > 0), F.struct((-part).alias("push"), F.lit(r.feature).alias("feature"), F.lit(r.text).alias("reason")))

    found = F.sort_array(F.filter(F.array(*[entry(r) for r in reasons]), lambda x: x.isNotNull()))
    rows = attributed.select(*keep, F.posexplode(F.slice(found, 1, k)).alias("pos", "r"))
    return rows.select(
        *keep, (F.col("pos") + 1).alias("reason_rank"), F.when(F.col("pos") == 0, "primary").otherwise("secondary").alias("reason_kind"),
        "r.feature", "r.reason", (-F.col("r.push")).alias("contribution"),
    )
