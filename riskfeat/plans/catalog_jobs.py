"""Registered jobs with files in between: CSV in, processed frames and scores
out, the train + test pipeline, the monitoring stream.

What a job writes lies under the session's shared folder, in a folder of its
own, and what it returns is read back from there.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..sources import fixtures as FX
from ..sources import io as IO
from ..streaming import monitor as MON
from . import app_sql as A
from . import assembly as PL
from . import catalog as C
from . import colocated as CO


BUCKETS = 16  # of the co-located tables here; a cluster takes about history bytes / 256 MB


def _folder(spark, name: str) -> str:
    return C.shared_dir(spark, f"{name}-{uuid.uuid4().hex}")


# ------------------------------------------------------------------ CSV in
_CSV = ["SK_ID_CURR", "TARGET", "DAYS_EMPLOYED", "AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY", "CNT_CHILDREN", "EXT_SOURCE_2", "OCCUPATION_TYPE", "CODE_GENDER"]
_BAD = "SK_ID_CURR % 50 = 7"  # lines whose income is a word


def _ingested(spark, sf_dir):
    """The training applicants written as CSV, some incomes damaged, and read with a rejects table."""
    app = C.applicants(spark, sf_dir).where("IS_TRAIN = 1").select(*_CSV)
    income = F.when(F.expr(_BAD), "unknown").otherwise(F.col("AMT_INCOME_TOTAL").cast("string"))
    path = _folder(spark, "csv")
    app.withColumn("AMT_INCOME_TOTAL", income).write.option("header", True).csv(f"{path}/csv")
    return IO.ingest_csv(spark, f"{path}/csv", f"{path}/table", IO.APPLICATION_TYPES)


@C.register("csv_rows", FX.duckdb_with(["applicants"], f"SELECT {', '.join(_CSV)} FROM applicants WHERE IS_TRAIN = 1 AND NOT ({_BAD})".replace(
    "CNT_CHILDREN", "CAST(CNT_CHILDREN AS BIGINT) AS CNT_CHILDREN")))
def q_csv_rows(spark, sf_dir):
    return _ingested(spark, sf_dir)[0]


@C.register("csv_rejects", FX.duckdb_with(["applicants"], f"SELECT SK_ID_CURR, 'unknown' AS income FROM applicants WHERE IS_TRAIN = 1 AND ({_BAD})"))
def q_csv_rejects(spark, sf_dir):
    """Key and damaged cell of every rejected line, from the line's text."""
    cells = F.split("line", ",")
    return _ingested(spark, sf_dir)[1].select(cells[0].cast("long").alias("SK_ID_CURR"), cells[_CSV.index("AMT_INCOME_TOTAL")].alias("income"))


# --------------------------------------------------- train and test in one go
def _pipeline(spark, sf_dir):
    """Plan, histories and both frames of one pipeline run, written and read back."""
    train, test = C.split_train_test(C.applicants(spark, sf_dir))
    histories = {name: FX.load(spark, sf_dir, fixture) for name, fixture in C.HISTORY_FIXTURE.items()}
    res = PL.process_pipeline(train, test, histories)
    return [IO.read_table(spark, p) for p in IO.save_processed(res.train, res.test, _folder(spark, "processed"))]


C.register("pipeline_train", C._app_sql(A.joined_select("train"), "train", True, True))(lambda spark, sf_dir: _pipeline(spark, sf_dir)[0])
C.register("pipeline_test", C._app_sql(A.joined_select("test"), "test", True, True))(lambda spark, sf_dir: _pipeline(spark, sf_dir)[1])


def _colocated(spark, sf_dir):
    """The same frames from histories in buckets, opened again from where they were written."""
    train, test = C.split_train_test(C.applicants(spark, sf_dir))
    path = _folder(spark, "colocated")
    CO.write_histories({name: FX.load(spark, sf_dir, fixture) for name, fixture in C.HISTORY_FIXTURE.items()}, f"{path}/histories", BUCKETS)
    return CO.process(train, test, CO.open_histories(spark, f"{path}/histories"), f"{path}/run")


C.register("colocated_train", C.ORACLES["pipeline_train"])(lambda spark, sf_dir: _colocated(spark, sf_dir).train)
C.register("colocated_test", C.ORACLES["pipeline_test"])(lambda spark, sf_dir: _colocated(spark, sf_dir).test)


@C.register("score_file", C._scored_sql("SELECT SK_ID_CURR, SCORE AS TARGET FROM scored"))
def q_score_file(spark, sf_dir):
    """The score file, built once: the second call reads what the first one wrote."""
    path = _folder(spark, "scores")

    def build():
        IO.write_scores(C.scored(spark, sf_dir), f"{path}/csv")
        return spark.read.schema("SK_ID_CURR long, TARGET double").option("header", True).csv(f"{path}/csv")

    IO.load_or_build(spark, f"{path}/table", build)
    return IO.load_or_build(spark, f"{path}/table", build)


# ------------------------------------------------------------------ monitoring
@C.register("stream_daily", FX.duckdb_with(["decisions"], """
SELECT day, decisions, approved, approval_rate,
 CASE WHEN approval_rate < 0.5E0 OR approval_rate > 0.8E0 THEN 'ALERT'
      WHEN approval_rate < 0.6E0 OR approval_rate > 0.7E0 THEN 'WARN' ELSE 'OK' END AS status
FROM (SELECT date_trunc('day', TS) AS day, COUNT(*) AS decisions, COUNT(*) FILTER (WHERE SCORE < 0.35E0) AS approved,
        CAST(COUNT(*) FILTER (WHERE SCORE < 0.35E0) AS DOUBLE) / COUNT(*) AS approval_rate FROM decisions GROUP BY 1) d
WHERE day + INTERVAL 1 DAY <= (SELECT MAX(TS) FROM decisions) - INTERVAL 2 DAY"""))
def q_stream_daily(spark, sf_dir):
    """Days that a watermark of two days has closed, from a stream over all decisions."""
    rows = C.decisions(spark, sf_dir)
    path = _folder(spark, "monitor")
    rows.write.parquet(f"{path}/in")
    MON.run_daily_monitor(spark, f"{path}/in", rows.schema, f"{path}/days", f"{path}/state", watermark="2 days")
    return spark.read.parquet(f"{path}/days").withColumn("day", F.col("day").cast("timestamp_ntz"))


@C.register("retrain_rule", C.ORACLES["weekly_auc"].rsplit("\nSELECT week", 1)[0] + """
SELECT week, auc, auc_before, auc_before - auc AS auc_drop, COALESCE(auc_before - auc > 0.02E0, FALSE) AS retrain
FROM (SELECT week, auc, LAG(auc) OVER (ORDER BY week) AS auc_before FROM r) b""")
def q_retrain(spark, sf_dir):
    return MON.retrain_rule(C.QUERIES["weekly_auc"](spark, sf_dir))
