"""Leak-safe cleaning plan: fit on training rows, replay on any frame.

``fit_plan(train)`` runs a fixed number of jobs (null profile, exact medians,
modes) and returns a small immutable ``FitPlan``; ``clean(df, plan)`` is a
single projection. Order of the steps follows the reference: drop columns
with more than half missing, turn the employment sentinel into null + flag,
fit, impute the external scores (flag always), impute the other numerics and
strings (flag only where nulls occur).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import exprs as X
from . import quantiles

KEY = "SK_ID_CURR"
TARGET = "TARGET"
# Fixed values that must equal the reference's for identical results.
SENTINEL_COLUMN = "DAYS_EMPLOYED"
SENTINEL_THRESHOLD = 15000          # values above it are "unknown employment"
SENTINEL_FLAG = "FLAG_UNEMPLOYED_UNKNOWN"
MISSING_THRESHOLD = 0.5             # drop when the null share is strictly above
MISSING_CATEGORY = "Missing"        # stored mode when the mode itself is null
EXT_SOURCES = ("EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3")
FLAG_PREFIX = "FLAG_MISSING_"


class NotFittedError(RuntimeError):
    pass


def numeric_columns(df: DataFrame, exclude: Sequence[str] = (KEY, TARGET)) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


# ----------------------------------------------------------------- profiles


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> tuple[int, dict[str, int]]:
    """Row count and null count of every column, in one job."""
    columns = list(columns or df.columns)
    row = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count(F.when(F.col(c).isNull(), 1)).alias(f"__n{i}") for i, c in enumerate(columns)],
    ).first()
    return row["__rows"], {c: row[f"__n{i}"] for i, c in enumerate(columns)}


def null_profile_table(df: DataFrame) -> DataFrame:
    """``(column_name, null_count, null_share)`` as a DataFrame, one pass."""
    cols = df.columns
    wide = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count(F.when(F.col(c).isNull(), 1)).alias(f"__n{i}") for i, c in enumerate(cols)],
    )
    stack = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"__n{i}").alias("null_count")) for i, c in enumerate(cols)])
    )
    return wide.select(F.col("__rows"), stack.alias("s")).select(
        "s.column_name", "s.null_count", (F.col("s.null_count") / F.col("__rows")).alias("null_share")
    )


def high_missing_columns(rows: int, nulls: dict[str, int], threshold: float = MISSING_THRESHOLD) -> list[str]:
    if rows == 0:
        return []
    return [c for c, n in nulls.items() if n / rows > threshold]


def drop_high_missing(df: DataFrame, threshold: float = MISSING_THRESHOLD) -> DataFrame:
    rows, nulls = null_profile(df)
    return df.drop(*high_missing_columns(rows, nulls, threshold))


def fix_sentinel(df: DataFrame, column: str = SENTINEL_COLUMN, threshold: float = SENTINEL_THRESHOLD) -> DataFrame:
    """Sentinel values (> threshold) become null and are flagged; one projection."""
    if column not in df.columns:
        return df
    cols = [X.null_above(column, threshold).alias(c) if c == column else F.col(c) for c in df.columns]
    return df.select(*cols, X.flag_gt(column, threshold).alias(SENTINEL_FLAG))


# -------------------------------------------------------------------- modes


def modes(df: DataFrame, columns: Sequence[str], null_mode: str = "compete") -> dict[str, str | None]:
    """Most frequent value per string column; ties go to the smallest value.

    ``compete``: null is a value like any other (the reference's rule);
    ``ignore``: nulls are skipped. Counting is a ``groupBy(column, value)``
    whose partial aggregation collapses hot values map-side; the winner per
    column is an algebraic ``min(struct)``, so no column is gathered in one task.
    """
    columns = list(columns)
    if not columns:
        return {}
    pairs = [F.struct(F.lit(i).alias("c"), F.col(c).cast("string").alias("v")) for i, c in enumerate(columns)]
    long = df.select(F.explode(F.array(*pairs)).alias("p")).select("p.c", "p.v")
    if null_mode == "ignore":
        long = long.where(F.col("v").isNotNull())
    elif null_mode != "compete":
        raise ValueError(f"unknown null_mode {null_mode!r}")
    counts = long.groupBy("c", "v").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("c").agg(
        F.min(F.struct((-F.col("n")).alias("neg"), F.col("v").isNull().alias("isnull"), F.col("v").alias("v"))).alias("m")
    )
    found = {r["c"]: r["m"]["v"] for r in best.collect()}
    return {c: found.get(i) for i, c in enumerate(columns)}


# ---------------------------------------------------------------- fit plan


@dataclass(frozen=True)
class FitPlan:
    """Everything learnt from the training frame; small and driver-side."""

    dropped: tuple[str, ...]
    numeric_medians: dict[str, float]
    categorical_modes: dict[str, str]
    ext_source_medians: dict[str, float]
    numeric_impute: tuple[str, ...]
    categorical_impute: tuple[str, ...]
    schema_mode: str = "frozen"
    missing_threshold: float = MISSING_THRESHOLD
    key: str = KEY
    target: str = TARGET
    is_fitted: bool = True
    train_columns: tuple[str, ...] = field(default_factory=tuple)

    def as_rows(self) -> list[tuple[str, str, str]]:
        """``(column, kind, value)`` rows, e.g. to persist the plan as a table."""
        rows = [(c, "dropped", "") for c in self.dropped]
        rows += [(c, "median", repr(v)) for c, v in self.numeric_medians.items()]
        rows += [(c, "ext_median", repr(v)) for c, v in self.ext_source_medians.items()]
        rows += [(c, "mode", v) for c, v in self.categorical_modes.items()]
        return rows


UNFITTED = FitPlan((), {}, {}, {}, (), (), is_fitted=False)


def plan_to_json(plan: FitPlan) -> str:
    """Serialise a fitted plan (a few scalars per column) for later replay."""
    import json
    from dataclasses import asdict

    return json.dumps(asdict(plan), sort_keys=True)


def plan_from_json(text: str) -> FitPlan:
    import json

    d = json.loads(text)
    for k in ("dropped", "numeric_impute", "categorical_impute", "train_columns"):
        d[k] = tuple(d[k])
    return FitPlan(**d)


def save_plan(spark, plan: FitPlan, path: str) -> None:
    """Write the plan as a one-row text table (shared storage, any job can read it)."""
    spark.createDataFrame([(plan_to_json(plan),)], "plan string").coalesce(1).write.mode("overwrite").text(path)


def load_plan(spark, path: str) -> FitPlan:
    return plan_from_json(spark.read.text(path).first()[0])


def _impute_candidates(columns: Sequence[str], numeric: set[str], strings: set[str], rows: int,
                       nulls: dict[str, int], key: str, target: str, threshold: float) -> tuple[list[str], list[str]]:
    num, cat = [], []
    for c in columns:
        n = nulls.get(c, 0)
        share = n / rows if rows else 0.0
        if c in numeric and c not in (key, target):
            if c.startswith("EXT_SOURCE_") or c.startswith("FLAG_") or share > threshold:
                continue
            if n > 0:
                num.append(c)
        elif c in strings:
            if share > threshold:
                continue
            if n > 0:
                cat.append(c)
    return num, cat


def _profile_after_fix(df: DataFrame, plan_drop: Sequence[str]) -> tuple[DataFrame, int, dict[str, int]]:
    kept = df.drop(*plan_drop)
    fixed = fix_sentinel(kept)
    rows, nulls = null_profile(fixed)
    return fixed, rows, nulls


def fit_plan(
    train: DataFrame,
    key: str = KEY,
    target: str = TARGET,
    null_mode: str = "compete",
    schema_mode: str = "frozen",
    threshold: float = MISSING_THRESHOLD,
) -> FitPlan:
    """Fit on the training frame: 3 passes over it plus the median brackets."""
    # Pass 1: one wide count aggregate over the sentinel-fixed frame (counts
    # merge cheaply): raw null counts for the drop rule (raw nulls of the
    # sentinel column = null flags) and its after-fix count for imputation.
    # Passes 2-3: exact medians of the kept numeric columns; pass 4: modes.
    fixed_all = fix_sentinel(train)
    cols = train.columns
    extra = {"__rows": F.count(F.lit(1))}
    for i, c in enumerate(cols):
        raw_null = F.col(SENTINEL_FLAG).isNull() if c == SENTINEL_COLUMN else F.col(c).isNull()
        extra[f"__n{i}"] = F.count(F.when(raw_null, 1))
    if SENTINEL_COLUMN in cols:
        extra["__sent_null"] = F.count(F.when(F.col(SENTINEL_COLUMN).isNull(), 1))
    prof = fixed_all.agg(*[e.alias(n) for n, e in extra.items()]).first()
    rows = prof["__rows"]
    nulls = {c: prof[f"__n{i}"] for i, c in enumerate(cols)}
    dropped = high_missing_columns(rows, nulls, threshold)
    fixed = fixed_all.drop(*dropped)
    if SENTINEL_COLUMN in fixed.columns:
        nulls = dict(nulls, **{SENTINEL_COLUMN: prof["__sent_null"], SENTINEL_FLAG: nulls[SENTINEL_COLUMN]})
    numeric = numeric_columns(fixed, (key, target))
    strings = string_columns(fixed)
    ext = [c for c in EXT_SOURCES if c in fixed.columns]
    med = quantiles.exact_medians(fixed, numeric)
    numeric_medians = {c: (med[c] if med[c] is not None else 0) for c in numeric}
    ext_medians = {c: numeric_medians.get(c, 0) for c in ext}
    found_modes = modes(fixed, strings, null_mode)
    cat_modes = {c: (v if v is not None else MISSING_CATEGORY) for c, v in found_modes.items()}
    num_imp, cat_imp = _impute_candidates(
        fixed.columns, set(numeric), set(strings), rows, nulls, key, target, threshold
    )
    return FitPlan(
        dropped=tuple(dropped),
        numeric_medians=numeric_medians,
        categorical_modes=cat_modes,
        ext_source_medians=ext_medians,
        numeric_impute=tuple(num_imp),
        categorical_impute=tuple(cat_imp),
        schema_mode=schema_mode,
        missing_threshold=threshold,
        key=key,
        target=target,
        train_columns=tuple(fixed.columns),
    )


def clean_columns(df: DataFrame, plan: FitPlan) -> list[Column]:
    """The cleaned frame as one list of column expressions."""
    if not plan.is_fitted:
        raise NotFittedError("clean() needs a plan from fit_plan(train)")
    if plan.schema_mode == "frozen":
        dropped = [c for c in plan.dropped if c in df.columns]
        num_imp = [c for c in plan.numeric_impute if c in df.columns]
        cat_imp = [c for c in plan.categorical_impute if c in df.columns]
    elif plan.schema_mode == "per_frame":
        rows, nulls = null_profile(df)
        dropped = high_missing_columns(rows, nulls, plan.missing_threshold)
        fixed, rows, nulls = _profile_after_fix(df, dropped)
        numeric = set(numeric_columns(fixed, (plan.key, plan.target)))
        strings = set(string_columns(fixed))
        num_imp, cat_imp = _impute_candidates(
            fixed.columns, numeric, strings, rows, nulls, plan.key, plan.target, plan.missing_threshold
        )
    else:
        raise ValueError(f"unknown schema_mode {plan.schema_mode!r}")

    kept = [c for c in df.columns if c not in set(dropped)]
    ext = [c for c in EXT_SOURCES if c in kept]
    values: dict[str, Column] = {}
    for c in kept:
        expr = F.col(c)
        if c == SENTINEL_COLUMN:
            expr = X.null_above(c, SENTINEL_THRESHOLD)
        values[c] = expr
    flags: dict[str, Column] = {}
    if SENTINEL_COLUMN in kept:
        flags[SENTINEL_FLAG] = X.flag_gt(SENTINEL_COLUMN, SENTINEL_THRESHOLD)
    for c in ext:
        flags[FLAG_PREFIX + c] = values[c].isNull().cast("int")
        values[c] = F.coalesce(values[c], F.lit(plan.ext_source_medians.get(c, 0)))
    for c in num_imp:
        flags[FLAG_PREFIX + c] = values[c].isNull().cast("int")
        values[c] = F.coalesce(values[c], F.lit(plan.numeric_medians.get(c, 0)))
    for c in cat_imp:
        flags[FLAG_PREFIX + c] = values[c].isNull().cast("int")
        values[c] = F.coalesce(values[c], F.lit(plan.categorical_modes.get(c, MISSING_CATEGORY)))
    return [e.alias(c) for c, e in values.items()] + [e.alias(c) for c, e in flags.items()]


def clean(df: DataFrame, plan: FitPlan) -> DataFrame:
    return df.select(*clean_columns(df, plan))


def with_schema_mode(plan: FitPlan, mode: str) -> FitPlan:
    return replace(plan, schema_mode=mode)
