"""Monitoring of scoring decisions: daily approval rate with alert levels.

The same aggregation runs on a static table (batch) and on a stream
(``readStream``): event-time tumbling windows with a watermark, so state is
one small counter row per open day and rows later than the watermark are
dropped. AUC and the gender gap need ranks or whole months and run as batch
jobs over ``date_trunc`` periods.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exprs as X


@dataclass(frozen=True)
class MonitorPlan:
    """Targets and alert bands of the reference's monitoring plan (fixed values)."""

    threshold: float = 0.35
    approval_target: tuple[float, float] = (0.60, 0.70)
    approval_alert: tuple[float, float] = (0.50, 0.80)
    auc_target: float = 0.74
    auc_alert: float = 0.72
    gap_target: float = 8.0
    gap_alert: float = 10.0
    retrain_auc_drop: float = 0.02


DEFAULT_PLAN = MonitorPlan()


def _trunc(df: DataFrame, unit: str, ts: str) -> Column:
    """``date_trunc`` that keeps the input's timestamp flavour (NTZ stays NTZ)."""
    out = F.date_trunc(unit, F.col(ts))
    return out.cast("timestamp_ntz") if dict(df.dtypes).get(ts) == "timestamp_ntz" else out


def approval_status(rate: Column, plan: MonitorPlan = DEFAULT_PLAN) -> Column:
    lo_alert, hi_alert = plan.approval_alert
    lo_t, hi_t = plan.approval_target
    return (
        F.when((rate < lo_alert) | (rate > hi_alert), F.lit("ALERT"))
        .when((rate < lo_t) | (rate > hi_t), F.lit("WARN"))
        .otherwise(F.lit("OK"))
    )


def daily_approval(events: DataFrame, ts: str = "TS", score: str = "SCORE",
                   plan: MonitorPlan = DEFAULT_PLAN, period: str = "1 day") -> DataFrame:
    """Per event-time window: decisions, approvals, approval rate, status."""
    counts = events.groupBy(F.window(F.col(ts), period).alias("w")).agg(
        F.count(F.lit(1)).alias("decisions"),
        X.count_if(F.col(score) < F.lit(plan.threshold)).alias("approved"),
    )
    rate = F.col("approved") / F.col("decisions")
    return counts.select(
        F.col("w.start").alias("day"),
        "decisions",
        "approved",
        rate.alias("approval_rate"),
        approval_status(rate, plan).alias("status"),
    )


def gap_by_period(events: DataFrame, ts: str = "TS", score: str = "SCORE", group: str = "CODE_GENDER",
                  a: str = "M", b: str = "F", unit: str = "month", plan: MonitorPlan = DEFAULT_PLAN) -> DataFrame:
    """Approval gap ``a - b`` (points) per calendar period with status."""
    appr = (F.col(score) < F.lit(plan.threshold)).cast("double")
    per = events.where(F.col(group).isNotNull()).groupBy(_trunc(events, unit, ts).alias("period")).agg(
        (F.avg(F.when(F.col(group) == a, appr)) * 100 - F.avg(F.when(F.col(group) == b, appr)) * 100).alias("gap_points")
    )
    return per.withColumn(
        "status",
        F.when(F.abs("gap_points") > plan.gap_alert, "ALERT").when(F.abs("gap_points") > plan.gap_target, "WARN").otherwise("OK"),
    )


def auc_status(auc: Column, baseline: float | None = None, plan: MonitorPlan = DEFAULT_PLAN) -> Column:
    status = F.when(auc < plan.auc_alert, "ALERT").when(auc < plan.auc_target, "WARN").otherwise("OK")
    if baseline is not None:
        status = F.when(auc < F.lit(baseline - plan.retrain_auc_drop), "RETRAIN").otherwise(status)
    return F.when(auc.isNull(), "NO_DATA").otherwise(status)


def weekly_auc(labelled: DataFrame, ts: str = "TS", label: str = "TARGET", score: str = "SCORE",
               plan: MonitorPlan = DEFAULT_PLAN, baseline: float | None = None) -> DataFrame:
    """Exact AUC per calendar week with its status (batch: AUC needs ranks)."""
    from ..operators.evaluate import roc_auc_by

    weeks = labelled.withColumn("week", _trunc(labelled, "week", ts))
    return roc_auc_by(weeks, "week", label, score).withColumn("status", auc_status(F.col("auc"), baseline, plan))


def stream_daily_approval(stream: DataFrame, ts: str = "TS", score: str = "SCORE",
                          watermark: str = "2 days", plan: MonitorPlan = DEFAULT_PLAN) -> DataFrame:
    """Streaming form: watermark then the same windowed aggregation.

    Watermarks need a zoned timestamp: a wall-clock (NTZ) event time is read
    in the session time zone.
    """
    if dict(stream.dtypes).get(ts) == "timestamp_ntz":
        stream = stream.withColumn(ts, F.col(ts).cast("timestamp"))
    return daily_approval(stream.withWatermark(ts, watermark), ts, score, plan)


def start_monitor(stream: DataFrame, sink_path: str, checkpoint: str, trigger_seconds: int = 60,
                  **kw):
    """Append finished days to a Parquet sink; the checkpoint folder must be
    on shared storage so a restarted query resumes its state."""
    q = (
        stream_daily_approval(stream, **kw)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", sink_path)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=f"{trigger_seconds} seconds")
        .start()
    )
    return q


def run_daily_monitor(spark, source: str, schema, sink_path: str, checkpoint: str, files_per_trigger: int | None = None,
                      **kw) -> dict[str, int]:
    """Everything that has arrived in ``source`` (Parquet files), then stop.

    Finished days (those the watermark has passed) are appended to the sink;
    open days stay in the checkpoint's state, and the next run, in this session
    or another, goes on from there. Returns the rows read and the rows that
    came too late for their day, as the engine's progress reports them.
    """
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    query = (
        stream_daily_approval(reader.parquet(source), **kw)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", sink_path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    progress = query.recentProgress
    return {"rows": sum(p["numInputRows"] for p in progress),
            "late_rows": sum(s["numRowsDroppedByWatermark"] for p in progress for s in p["stateOperators"])}


def retrain_rule(weekly: DataFrame, plan: MonitorPlan = DEFAULT_PLAN) -> DataFrame:
    """``(week, auc, auc_before, auc_drop, retrain)``: retrain if the AUC fell by
    more than the plan's drop against the last week that has one.

    One row per week reaches the window.
    """
    w = Window.orderBy("week").rowsBetween(Window.unboundedPreceding, -1)
    before = weekly.select("week", "auc", F.last("auc", ignorenulls=True).over(w).alias("auc_before"))
    drop = F.col("auc_before") - F.col("auc")
    return before.withColumn("auc_drop", drop).withColumn("retrain", F.coalesce(F.col("auc_drop") > plan.retrain_auc_drop, F.lit(False)))
