"""End-to-end feature pipeline: clean -> engineer -> attach histories.

The training frame is profiled once to build a ``FitPlan``; train and test
are then the same lazy plan shape (one projection each) joined to history
rollups that are aggregated once and shared by both outputs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..operators import features as FE
from ..operators import fit as FIT
from ..operators import history as H


def engineer(df: DataFrame) -> DataFrame:
    """Append all engineered application features in one projection."""
    feats = FE.application_features(df.columns)
    return df.select("*", *[c.alias(n) for n, c in feats.items()])


def clean_application(df: DataFrame, plan: FIT.FitPlan) -> DataFrame:
    return FIT.clean(df, plan)


def rollup_histories(histories: dict[str, DataFrame] | None) -> dict[str, DataFrame]:
    """Aggregate each provided history table (keys as in ``history.PRESETS``)."""
    return {name: H.rollup(df, H.PRESETS[name]) for name, df in (histories or {}).items() if df is not None}


def materialize(df: DataFrame, how: str = "checkpoint") -> DataFrame:
    """Cut lineage so a result reused by several outputs is computed once.

    ``checkpoint`` writes to the shared ``spark.checkpoint.dir`` (survives
    executor loss); ``none`` keeps it lazy.
    """
    if how == "none":
        return df
    if how == "checkpoint":
        from ..session import ensure_checkpoint_dir

        ensure_checkpoint_dir(df.sparkSession)
        return df.checkpoint(eager=True)
    raise ValueError(f"unknown materialize mode {how!r}")


@dataclass
class PipelineResult:
    train: DataFrame
    test: DataFrame
    plan: FIT.FitPlan


def process_pipeline(
    app_train: DataFrame,
    app_test: DataFrame,
    histories: dict[str, DataFrame] | None = None,
    *,
    schema_mode: str = "frozen",
    null_mode: str = "compete",
    share_rollups: str = "checkpoint",
) -> PipelineResult:
    """Fit on train, transform both frames, attach history features.

    Histories are aggregated once (not once per frame) and, when both
    outputs use them, checkpointed so the raw history tables are read once.
    """
    plan = FIT.fit_plan(app_train, null_mode=null_mode, schema_mode=schema_mode)
    rollups = rollup_histories(histories)
    if rollups and share_rollups != "none":
        rollups = {k: materialize(v, share_rollups) for k, v in rollups.items()}
    train = H.attach_histories(engineer(FIT.clean(app_train, plan)), rollups)
    test = H.attach_histories(engineer(FIT.clean(app_test, plan)), rollups)
    return PipelineResult(train, test, plan)


def build_frame(app: DataFrame, plan: FIT.FitPlan, rollups: dict[str, DataFrame]) -> DataFrame:
    """One frame through clean -> engineer -> attach (no materialisation)."""
    return H.attach_histories(engineer(FIT.clean(app, plan)), rollups)


def column_report(train: DataFrame, test: DataFrame, target: str = FIT.TARGET) -> list[tuple[str, bool, bool]]:
    """Columns of either frame with presence flags; the label is ignored."""
    a = [c for c in train.columns if c != target]
    b = list(test.columns)
    names = a + [c for c in b if c not in set(a)]
    return [(c, c in set(a), c in set(b)) for c in names]


def clean_with_metrics(df: DataFrame, plan: FIT.FitPlan):
    """Clean and attach an ``Observation`` with the logged counts (sentinel
    rows, imputed values per flag) - gathered by the job that consumes the
    frame, not by extra passes."""
    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    out = FIT.clean(df, plan)
    flags = [c for c in out.columns if c.startswith(FIT.FLAG_PREFIX) or c == FIT.SENTINEL_FLAG]
    obs = Observation("clean_metrics")
    observed = out.observe(obs, F.count(F.lit(1)).alias("rows"),
                           *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in flags])
    return observed, obs


def drop_columns(df: DataFrame, names) -> DataFrame:
    """Drop id / label columns (missing names are ignored)."""
    return df.drop(*[c for c in names if c in df.columns])


def columns_with_prefix(df: DataFrame, prefixes) -> list[str]:
    return [c for c in df.columns if any(c.startswith(p) for p in prefixes)]


def select_existing(df: DataFrame, names) -> DataFrame:
    have = set(df.columns)
    return df.select(*[c for c in names if c in have])
