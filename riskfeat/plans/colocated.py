"""Train and test frame from one job over co-located histories.

The histories are cut into buckets by applicant once (``write_histories``) and
stay so for later runs.  A run writes its cleaned and engineered applications,
train and test together, into the same buckets: the five rollups and the five
joins then work bucket by bucket, without an exchange, and every history is read
once for both frames.  Heavy applicants (see ``sources.bucketed``) are rolled up
by map-side aggregation beside the buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators import fit as FIT
from ..operators import history as H
from ..sources import bucketed as B
from . import assembly as PL

SPLIT = "_split"
_HEAVY = "_heavy_"


def write_histories(histories: dict[str, DataFrame], folder: str, buckets: int, heavy_rows: int = B.HEAVY_ROWS) -> dict[str, B.Bucketed]:
    """Each history (keys as in ``history.PRESETS``) with the columns its rollup needs, in buckets."""
    out = {}
    for name, df in histories.items():
        spec = H.PRESETS[name]
        cols = [spec.key, *spec.columns] if spec.columns else df.columns
        out[name] = B.write_bucketed(df.select(*cols), f"{folder.rstrip('/')}/{name}", spec.key, buckets, heavy_rows)
    return out


def open_histories(spark: SparkSession, folder: str, names=tuple(H.PRESETS)) -> dict[str, B.Bucketed]:
    return {name: B.open_bucketed(spark, f"{folder.rstrip('/')}/{name}") for name in names}


def attach(app: DataFrame, histories: dict[str, B.Bucketed], key: str = H.KEY) -> DataFrame:
    """``history.attach_histories`` over bucketed histories.

    A key is either in the buckets or heavy, so of the two rollups of a history
    at most one has a row for it.
    """
    out = app
    filled: list[str] = []
    for name, spec in H.PRESETS.items():
        t = histories.get(name)
        if t is None:
            continue
        agg = H.rollup(t.rows, spec)
        cols = [c for c in agg.columns if c != key]
        out = out.join(agg, on=key, how="left")
        if t.heavy is not None:
            heavy = H.rollup(t.heavy, spec).select(key, *[F.col(c).alias(_HEAVY + c) for c in cols])
            out = out.join(heavy, on=key, how="left")
            out = out.withColumns({c: F.coalesce(c, _HEAVY + c) for c in cols}).drop(*[_HEAVY + c for c in cols])
        filled += cols
    return out.withColumns({c: X.fill(c, 0) for c in filled}) if filled else out


def joined(app: B.Bucketed, histories: dict[str, B.Bucketed]) -> DataFrame:
    """Applications with their histories; rows of heavy keys or none go a way of their own."""
    out = attach(app.rows, histories, app.key)
    return out if app.heavy is None else out.unionByName(attach(app.heavy, histories, app.key))


def process(
    app_train: DataFrame,
    app_test: DataFrame,
    histories: dict[str, B.Bucketed],
    folder: str,
    *,
    schema_mode: str = "frozen",
    null_mode: str = "compete",
    heavy_rows: int = B.HEAVY_ROWS,
) -> PL.PipelineResult:
    """``assembly.process_pipeline`` over bucketed histories, both frames by one job.

    The frames are written to ``folder/processed``, partitioned by split, and
    read back with the columns that belong to each.
    """
    folder = folder.rstrip("/")
    spark = app_train.sparkSession
    plan = FIT.fit_plan(app_train, null_mode=null_mode, schema_mode=schema_mode)
    frames = {"train": PL.engineer(FIT.clean(app_train, plan)), "test": PL.engineer(FIT.clean(app_test, plan))}
    own = {split: df.columns for split, df in frames.items()}
    both = frames["train"].withColumn(SPLIT, F.lit("train")).unionByName(
        frames["test"].withColumn(SPLIT, F.lit("test")), allowMissingColumns=True
    )
    buckets = {t.buckets for t in histories.values()}
    if len(buckets) > 1:
        raise ValueError(f"histories with different numbers of buckets: {sorted(buckets)}")
    n = buckets.pop() if buckets else int(spark.conf.get("spark.sql.shuffle.partitions"))
    out = joined(B.write_bucketed(both, f"{folder}/applicants", plan.key, n, heavy_rows), histories)
    out.write.mode("overwrite").partitionBy(SPLIT).parquet(f"{folder}/processed")
    back = spark.read.schema(out.schema).parquet(f"{folder}/processed")
    history_cols = [c for c in out.columns if c != SPLIT and c not in set(both.columns)]
    train, test = (back.where(F.col(SPLIT) == split).select(*own[split], *history_cols) for split in ("train", "test"))
    return PL.PipelineResult(train, test, plan)
