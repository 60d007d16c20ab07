"""Session helpers: one place for the configuration every job relies on."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(
    master: str | None = None,
    app_name: str = "riskfeat",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with AQE on and the UI off.

    On a cluster the master and most sizes come from spark-submit; only
    unset values are filled here.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.driver.memory": "8g",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared folder there; we only pick a local scratch
    folder when the setting is missing and the master is local (tests).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if not configured:
        if sc.master != "local" and not sc.master.startswith("local["):  # local-cluster has executors of its own
            raise RuntimeError(
                f"set {CHECKPOINT_CONF} to a shared folder (e.g. on the cluster file system); "
                "a machine-local folder does not survive the loss of an executor"
            )
        configured = tempfile.mkdtemp(prefix="riskfeat-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set(CHECKPOINT_CONF, configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_dir(spark: SparkSession, name: str) -> str:
    """A folder for tables that later sessions shall find, beside the checkpoints.

    It lies in the folder that ``spark.checkpoint.dir`` names; where that is
    unset (tests) it lives as long as the scratch folder picked here.
    """
    own = ensure_checkpoint_dir(spark)
    root = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF, None)
    return f"{(root or own).rstrip('/')}/{name}"


def checkpoint(df, eager: bool = True):
    """Reliable checkpoint into the shared checkpoint folder (set if missing)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


@contextmanager
def brief_shuffles(spark: SparkSession) -> Iterator[None]:
    """Inside, shuffle files go when their action ends, not when the driver next collects its garbage.

    For jobs of several steps that checkpoint whatever a later step reads.
    """
    before = spark.conf.get(CLEANUP_CONF, None)
    spark.conf.set(CLEANUP_CONF, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP_CONF)
        else:
            spark.conf.set(CLEANUP_CONF, before)
