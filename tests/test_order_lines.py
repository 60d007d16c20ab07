"""The two histories of order lines: joined, shuffled and rolled up together."""

from pyspark.sql import functions as F

from conftest import SMALL_SF_DIR
from riskfeat.operators import history as H
from riskfeat.plans import catalog as C
from riskfeat.sources import fixtures as FX

INST = ["DAYS_INSTALMENT", "DAYS_ENTRY_PAYMENT", "AMT_INSTALMENT", "AMT_PAYMENT"]
POS = ["NAME_CONTRACT_STATUS", "SK_DPD", "SK_DPD_DEF", "CNT_INSTALMENT", "CNT_INSTALMENT_FUTURE"]


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_order_lines_hold_both_histories(spark):
    both = FX.load_order_lines(spark, SMALL_SF_DIR)
    assert _rows(both.select("SK_ID_CURR", *INST)) == _rows(FX.load(spark, SMALL_SF_DIR, "inst_like").select("SK_ID_CURR", *INST))
    assert _rows(both.where("IN_POS").select("SK_ID_CURR", *POS)) == _rows(FX.load(spark, SMALL_SF_DIR, "pos_like").select("SK_ID_CURR", *POS))


def test_one_aggregate_gives_the_rollups_of_both(spark):
    rows = [(k, k is not None and k != 2, float(k or 0), -3.0, 100.0 + i, None if i % 3 == 0 else 50.25 * i,
             ("Active", "Completed", "Signed")[i % 3], i, i % 2, 6.0, None if i % 2 else 1.0) for k in (1, 2, 2, 3, None) for i in range(4)]
    schema = ("SK_ID_CURR long, IN_POS boolean, DAYS_ENTRY_PAYMENT double, DAYS_INSTALMENT double, AMT_INSTALMENT double, AMT_PAYMENT double, "
              "NAME_CONTRACT_STATUS string, SK_DPD int, SK_DPD_DEF int, CNT_INSTALMENT double, CNT_INSTALMENT_FUTURE double")
    df = spark.createDataFrame(rows, schema)
    together = H.rollup_together(df, [H.INSTALLMENTS, H.POS_CASH], {H.POS_CASH.name: "IN_POS"})
    apart = {"installments": H.rollup(df, H.INSTALLMENTS), "pos_cash": H.rollup(df.where("IN_POS"), H.POS_CASH)}
    app = spark.createDataFrame([(1,), (2,), (4,), (None,)], "SK_ID_CURR long")
    one = H.attach_histories(app, {("installments", "pos_cash"): together})
    two = H.attach_histories(app, apart)
    assert one.dtypes == two.dtypes and _rows(one) == _rows(two)
    assert one.where("SK_ID_CURR = 2").first()["POS_NUM_RECORDS"] == 0 and one.where("SK_ID_CURR = 2").first()["INST_NUM_PAYMENTS"] == 8


def test_order_lines_are_read_and_joined_once(spark):
    plan = C.QUERIES["assemble_histories"](spark, SMALL_SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_orderkey") and sum("Relation" in line and "l_orderkey" in line for line in plan.splitlines()) == 1


def test_columns_keep_the_order_of_the_histories(spark):
    app = C.applicants(spark, SMALL_SF_DIR).select("SK_ID_CURR")
    apart = {n: H.rollup(FX.load(spark, SMALL_SF_DIR, f), H.PRESETS[n]) for n, f in C.HISTORY_FIXTURE.items()}
    one, two = H.attach_histories(app, C.history_rollups(spark, SMALL_SF_DIR)), H.attach_histories(app, apart)
    assert one.dtypes == two.dtypes and one.where(F.col("POS_NUM_RECORDS") > 0).count() == two.where(F.col("POS_NUM_RECORDS") > 0).count()
