"""One-to-many history tables rolled up to one row per applicant.

A rollup is declared as a ``HistorySpec``: row-level derived columns, the
aggregates, and ratios over the aggregates. Every aggregate is algebraic
(count / sum / min / max / exact mean) except one distinct count, so Spark
combines map-side before the shuffle on the key: a key holding a third of
all rows is reduced to one partial row per task, not shipped whole.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as X

KEY = "SK_ID_CURR"


@dataclass(frozen=True)
class HistorySpec:
    """Declarative rollup of a history table to ``key`` grain."""

    name: str
    prefix: str
    aggs: Callable[[], list[Column]]
    ratios: Callable[[], dict[str, Column]] = lambda: {}
    row_exprs: Callable[[], dict[str, Column]] = lambda: {}
    key: str = KEY
    columns: tuple[str, ...] = field(default_factory=tuple)


def rollup(history: DataFrame, spec: HistorySpec) -> DataFrame:
    """Aggregate ``history`` to one row per key; ratios in one projection."""
    src = history
    if spec.columns:
        src = src.select(spec.key, *spec.columns)
    rows = spec.row_exprs()
    if rows:
        src = src.withColumns(rows)
    agg = src.groupBy(spec.key).agg(*spec.aggs())
    ratios = spec.ratios()
    return agg.withColumns(ratios) if ratios else agg


def rollup_together(rows: DataFrame, specs: Sequence[HistorySpec], member: dict[str, str] | None = None) -> DataFrame:
    """``rollup`` of several histories that are made of the same rows, by one aggregate.

    ``member`` names, for a history that not every key takes part in, a boolean
    column that is the same in all rows of a key; elsewhere its columns are null.
    """
    key, member = specs[0].key, member or {}
    aggs = [(s, a) for s in specs for a in s.aggs()]
    derived = {c: x for s in specs for c, x in s.row_exprs().items()}
    marks = [F.max(c).alias(f"_in_{name}") for name, c in member.items()]
    agg = rows.withColumns(derived).groupBy(key).agg(*[a for _, a in aggs], *marks)
    ratios = {c: x for s in specs for c, x in s.ratios().items()}
    agg = agg.withColumns(ratios) if ratios else agg
    names = {s.name: [c for c in agg.columns if c.startswith(s.prefix)] for s in specs}
    return agg.select(key, *[F.when(F.col(f"_in_{n}"), F.col(c)).alias(c) if n in member else F.col(c) for n, cols in names.items() for c in cols])


# ------------------------------------------------------------------ presets
M = X.MONEY_SCALE


def _bureau_aggs() -> list[Column]:
    p = "BUREAU_"
    return [
        F.count(F.lit(1)).alias(p + "NUM_CREDITS"),
        X.count_if(F.col("CREDIT_ACTIVE") == "Active").alias(p + "NUM_ACTIVE"),
        X.count_if(F.col("CREDIT_ACTIVE") == "Closed").alias(p + "NUM_CLOSED"),
        X.sum0("AMT_CREDIT_SUM", M).alias(p + "TOTAL_CREDIT"),
        X.sum0("AMT_CREDIT_SUM_DEBT", M).alias(p + "TOTAL_DEBT"),
        X.sum0("AMT_CREDIT_SUM_OVERDUE", M).alias(p + "TOTAL_OVERDUE"),
        F.max("AMT_CREDIT_MAX_OVERDUE").alias(p + "MAX_OVERDUE"),
        F.max("DAYS_CREDIT").alias(p + "DAYS_MOST_RECENT_CREDIT"),
        F.min("DAYS_CREDIT").alias(p + "DAYS_OLDEST_CREDIT"),
        X.mean("DAYS_CREDIT").alias(p + "AVG_DAYS_CREDIT"),
        X.n_unique_with_null("CREDIT_TYPE").alias(p + "NUM_CREDIT_TYPES"),
    ]


def _bureau_ratios() -> dict[str, Column]:
    p = "BUREAU_"
    return {
        p + "DEBT_TO_CREDIT_RATIO": X.ratio(p + "TOTAL_DEBT", p + "TOTAL_CREDIT"),
        p + "OVERDUE_TO_CREDIT_RATIO": X.ratio(p + "TOTAL_OVERDUE", p + "TOTAL_CREDIT"),
        p + "ACTIVE_RATIO": X.ratio(p + "NUM_ACTIVE", p + "NUM_CREDITS"),
    }


BUREAU = HistorySpec(
    "bureau", "BUREAU_", _bureau_aggs, _bureau_ratios,
    columns=("CREDIT_ACTIVE", "AMT_CREDIT_SUM", "AMT_CREDIT_SUM_DEBT", "AMT_CREDIT_SUM_OVERDUE",
             "AMT_CREDIT_MAX_OVERDUE", "DAYS_CREDIT", "CREDIT_TYPE"),
)


def _prev_aggs() -> list[Column]:
    p = "PREV_"
    status = F.col("NAME_CONTRACT_STATUS")
    return [
        F.count(F.lit(1)).alias(p + "NUM_APPLICATIONS"),
        X.count_if(status == "Approved").alias(p + "NUM_APPROVED"),
        X.count_if(status == "Refused").alias(p + "NUM_REFUSED"),
        X.count_if(status == "Canceled").alias(p + "NUM_CANCELED"),
        X.mean("AMT_APPLICATION", M).alias(p + "AVG_APPLICATION_AMT"),
        F.max("AMT_APPLICATION").alias(p + "MAX_APPLICATION_AMT"),
        X.mean("AMT_CREDIT", M).alias(p + "AVG_CREDIT_AMT"),
        F.max("AMT_CREDIT").alias(p + "MAX_CREDIT_AMT"),
        X.mean("AMT_DOWN_PAYMENT", M).alias(p + "AVG_DOWN_PAYMENT"),
        X.sum0("AMT_DOWN_PAYMENT", M).alias(p + "TOTAL_DOWN_PAYMENT"),
        F.max("DAYS_DECISION").alias(p + "DAYS_MOST_RECENT"),
        X.mean("DAYS_DECISION").alias(p + "AVG_DAYS_DECISION"),
    ]


def _prev_ratios() -> dict[str, Column]:
    p = "PREV_"
    return {
        p + "APPROVAL_RATE": X.ratio(p + "NUM_APPROVED", p + "NUM_APPLICATIONS"),
        p + "REFUSAL_RATE": X.ratio(p + "NUM_REFUSED", p + "NUM_APPLICATIONS"),
        p + "CREDIT_TO_APPLICATION_RATIO": X.ratio(p + "AVG_CREDIT_AMT", p + "AVG_APPLICATION_AMT"),
    }


PREVIOUS = HistorySpec(
    "previous_application", "PREV_", _prev_aggs, _prev_ratios,
    columns=("NAME_CONTRACT_STATUS", "AMT_APPLICATION", "AMT_CREDIT", "AMT_DOWN_PAYMENT",
             "DAYS_DECISION"),
)


def _inst_rows() -> dict[str, Column]:
    return {
        "DAYS_PAST_DUE": F.col("DAYS_ENTRY_PAYMENT") - F.col("DAYS_INSTALMENT"),
        "PAYMENT_DIFF": F.col("AMT_PAYMENT") - F.col("AMT_INSTALMENT"),
    }


def _inst_aggs() -> list[Column]:
    p = "INST_"
    return [
        F.count(F.lit(1)).alias(p + "NUM_PAYMENTS"),
        X.count_if(F.col("DAYS_PAST_DUE") > 0).alias(p + "NUM_LATE_PAYMENTS"),
        F.max("DAYS_PAST_DUE").alias(p + "MAX_DAYS_PAST_DUE"),
        X.mean("DAYS_PAST_DUE").alias(p + "AVG_DAYS_PAST_DUE"),
        X.mean("AMT_PAYMENT", M).alias(p + "AVG_PAYMENT_AMT"),
        X.sum0("AMT_PAYMENT", M).alias(p + "TOTAL_PAYMENT_AMT"),
        X.mean("PAYMENT_DIFF", M).alias(p + "AVG_PAYMENT_DIFF"),
    ]


def _inst_ratios() -> dict[str, Column]:
    p = "INST_"
    return {p + "LATE_PAYMENT_RATE": X.ratio(p + "NUM_LATE_PAYMENTS", p + "NUM_PAYMENTS")}


INSTALLMENTS = HistorySpec(
    "installments_payments", "INST_", _inst_aggs, _inst_ratios, _inst_rows,
    columns=("DAYS_ENTRY_PAYMENT", "DAYS_INSTALMENT", "AMT_PAYMENT", "AMT_INSTALMENT"),
)


def _cc_aggs() -> list[Column]:
    p = "CC_"
    return [
        F.count(F.lit(1)).alias(p + "NUM_RECORDS"),
        X.mean("AMT_BALANCE", M).alias(p + "AVG_BALANCE"),
        F.max("AMT_BALANCE").alias(p + "MAX_BALANCE"),
        F.min("AMT_BALANCE").alias(p + "MIN_BALANCE"),
        X.mean("AMT_CREDIT_LIMIT_ACTUAL", M).alias(p + "AVG_CREDIT_LIMIT"),
        F.max("AMT_CREDIT_LIMIT_ACTUAL").alias(p + "MAX_CREDIT_LIMIT"),
        X.mean("AMT_DRAWINGS_CURRENT", M).alias(p + "AVG_DRAWINGS"),
        X.sum0("AMT_DRAWINGS_CURRENT", M).alias(p + "TOTAL_DRAWINGS"),
        X.mean("AMT_PAYMENT_CURRENT", M).alias(p + "AVG_PAYMENT"),
        X.mean("AMT_PAYMENT_TOTAL_CURRENT", M).alias(p + "AVG_TOTAL_PAYMENT"),
        X.mean("AMT_INST_MIN_REGULARITY", M).alias(p + "AVG_MIN_PAYMENT"),
    ]


def _cc_ratios() -> dict[str, Column]:
    p = "CC_"
    return {
        p + "UTILIZATION_RATE": X.ratio(p + "AVG_BALANCE", p + "AVG_CREDIT_LIMIT"),
        p + "PAYMENT_TO_BALANCE_RATIO": X.ratio(p + "AVG_PAYMENT", p + "AVG_BALANCE"),
    }


CREDIT_CARD = HistorySpec(
    "credit_card_balance", "CC_", _cc_aggs, _cc_ratios,
    columns=("AMT_BALANCE", "AMT_CREDIT_LIMIT_ACTUAL", "AMT_DRAWINGS_CURRENT", "AMT_PAYMENT_CURRENT",
             "AMT_PAYMENT_TOTAL_CURRENT", "AMT_INST_MIN_REGULARITY"),
)


def _pos_aggs() -> list[Column]:
    p = "POS_"
    status = F.col("NAME_CONTRACT_STATUS")
    return [
        F.count(F.lit(1)).alias(p + "NUM_RECORDS"),
        X.count_if(status == "Active").alias(p + "NUM_ACTIVE"),
        X.count_if(status == "Completed").alias(p + "NUM_COMPLETED"),
        F.max("SK_DPD").alias(p + "MAX_DPD"),
        X.mean("SK_DPD").alias(p + "AVG_DPD"),
        F.max("SK_DPD_DEF").alias(p + "MAX_DPD_DEF"),
        X.mean("CNT_INSTALMENT", M).alias(p + "AVG_INSTALMENTS"),
        X.mean("CNT_INSTALMENT_FUTURE", M).alias(p + "AVG_FUTURE_INSTALMENTS"),
    ]


def _pos_ratios() -> dict[str, Column]:
    p = "POS_"
    return {
        p + "COMPLETION_RATE": X.ratio(p + "NUM_COMPLETED", F.col(p + "NUM_ACTIVE") + F.col(p + "NUM_COMPLETED")),
    }


POS_CASH = HistorySpec(
    "POS_CASH_balance", "POS_", _pos_aggs, _pos_ratios,
    columns=("NAME_CONTRACT_STATUS", "SK_DPD", "SK_DPD_DEF", "CNT_INSTALMENT", "CNT_INSTALMENT_FUTURE"),
)

PRESETS: dict[str, HistorySpec] = {
    "bureau": BUREAU,
    "prev_app": PREVIOUS,
    "installments": INSTALLMENTS,
    "credit_card": CREDIT_CARD,
    "pos_cash": POS_CASH,
}

HISTORY_PREFIXES = tuple(s.prefix for s in PRESETS.values())


def aggregate_bureau(df: DataFrame) -> DataFrame:
    return rollup(df, BUREAU)


def aggregate_previous(df: DataFrame) -> DataFrame:
    return rollup(df, PREVIOUS)


def aggregate_installments(df: DataFrame) -> DataFrame:
    return rollup(df, INSTALLMENTS)


def aggregate_credit_card(df: DataFrame) -> DataFrame:
    return rollup(df, CREDIT_CARD)


def aggregate_pos_cash(df: DataFrame) -> DataFrame:
    return rollup(df, POS_CASH)


def attach_histories(app: DataFrame, rollups: dict[str | tuple[str, ...], DataFrame], key: str = KEY) -> DataFrame:
    """Left-join each rolled-up history (unique by key) and fill its gaps with 0.

    Only nulls are filled: a NaN produced by 0/0 stays NaN. The fill is one
    projection over all history columns, not a loop of ``withColumn``. Histories
    rolled up together stand under the tuple of their names; the columns come
    in the order of ``PRESETS`` either way.
    """
    found = {name: (names, agg) for names, agg in rollups.items() if agg is not None for name in ([names] if isinstance(names, str) else names)}
    out = app
    joined = set()
    history_cols: list[str] = []
    for name, spec in PRESETS.items():
        if name not in found:
            continue
        names, agg = found[name]
        if names not in joined:
            out = out.join(agg, on=key, how="left")
            joined.add(names)
        history_cols += [c for c in agg.columns if c != key and (names == name or c.startswith(spec.prefix))]
    if not history_cols:
        return out
    filled = {c: X.fill(c, 0).alias(c) for c in history_cols}
    return out.select(*[c for c in out.columns if c not in filled], *filled.values())
