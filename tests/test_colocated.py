"""Co-located histories: no exchange, heavy keys beside the buckets, the same
frames as the plain pipeline, layouts that a later job opens."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import SMALL_SF_DIR
from harness import _rows
from riskfeat.operators import history as H
from riskfeat.plans import assembly as PL
from riskfeat.plans import catalog as C
from riskfeat.plans import colocated as CO
from riskfeat.sources import bucketed as B
from riskfeat.sources import fixtures as FX


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _same(a, b):
    assert sorted(a.columns) == sorted(b.columns)
    cols = sorted(a.columns)
    assert dict(a.dtypes) == dict(b.dtypes)
    assert _rows([tuple(r) for r in a.select(*cols).collect()]) == _rows([tuple(r) for r in b.select(*cols).collect()])


@pytest.fixture(scope="module")
def inputs(spark):
    train, test = C.split_train_test(C.applicants(spark, SMALL_SF_DIR))
    histories = {name: FX.load(spark, SMALL_SF_DIR, f) for name, f in C.HISTORY_FIXTURE.items()}
    # one applicant holds a third of a history, and some rows have no applicant
    pos = histories["pos_cash"]
    hot = pos.where("SK_ID_CURR % 6 = 2").withColumn("SK_ID_CURR", F.lit(7).cast("long"))
    lost = pos.where("SK_ID_CURR % 6 = 3").withColumn("SK_ID_CURR", F.lit(None).cast("long"))
    histories["pos_cash"] = pos.unionByName(hot).unionByName(hot).unionByName(lost)
    return train, test, histories


def test_rollups_and_joins_need_no_exchange(spark, inputs, tmp_path):
    train, _, histories = inputs
    tables = CO.write_histories(histories, f"{tmp_path}/h", 4)
    app = B.write_bucketed(train, f"{tmp_path}/app", "SK_ID_CURR", 4)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name, t in tables.items():
            plan = _plan(H.rollup(t.rows, H.PRESETS[name]))
            assert "Exchange" not in plan and "Bucketed: true" in plan, (name, plan)
        no_nulls = {n: B.Bucketed(t.rows, None, t.key, t.buckets) for n, t in tables.items()}
        plan = _plan(CO.joined(app, no_nulls))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "Exchange" not in plan and plan.count("SortMergeJoin") == 5
    assert len(re.findall("FileScan parquet", plan)) == 6


@pytest.mark.parametrize("heavy_rows", [60, 1_000_000])
def test_frames_equal_the_plain_pipeline(spark, inputs, tmp_path, heavy_rows):
    train, test, histories = inputs
    want = PL.process_pipeline(train, test, histories, share_rollups="none")
    CO.write_histories(histories, f"{tmp_path}/h", 4, heavy_rows)
    tables = CO.open_histories(spark, f"{tmp_path}/h")
    assert {t.buckets for t in tables.values()} == {4}
    got = CO.process(train, test, tables, f"{tmp_path}/run", heavy_rows=heavy_rows)
    _same(got.train, want.train)
    _same(got.test, want.test)


def test_every_row_is_in_one_part(spark, inputs, tmp_path):
    pos = inputs[2]["pos_cash"]
    t = B.write_bucketed(pos, f"{tmp_path}/t", "SK_ID_CURR", 4, heavy_rows=100)
    n = {r["SK_ID_CURR"]: r["count"] for r in pos.groupBy("SK_ID_CURR").count().collect()}
    heavy = {k for k, v in n.items() if v >= 100 or k is None}
    assert {7, None} < heavy | {-1} and len(heavy) < len(n)
    count = lambda df: {r["SK_ID_CURR"]: r["count"] for r in df.groupBy("SK_ID_CURR").count().collect()}
    assert count(t.heavy) == {k: n[k] for k in heavy}
    assert count(t.rows) == {k: v for k, v in n.items() if k not in heavy}
    # many heavy keys are joined without a broadcast
    old, B.BROADCAST_KEYS = B.BROADCAST_KEYS, 0
    try:
        again = B.write_bucketed(pos, f"{tmp_path}/again", "SK_ID_CURR", 4, heavy_rows=100)
    finally:
        B.BROADCAST_KEYS = old
    assert count(again.heavy) == count(t.heavy) and count(again.rows) == {k: v for k, v in n.items() if k not in heavy}


def test_empty_tables_and_applicants_without_a_key(spark, inputs, tmp_path):
    train, test, histories = inputs
    none = {n: df.limit(0) for n, df in histories.items()}
    tables = CO.write_histories(none, f"{tmp_path}/h", 4)
    assert all(t.heavy is None and t.rows.count() == 0 for t in tables.values())
    train = train.unionByName(train.limit(3).withColumn("SK_ID_CURR", F.lit(None).cast("long")))
    got = CO.process(train, test, tables, f"{tmp_path}/run")
    _same(got.train, PL.process_pipeline(train, test, none, share_rollups="none").train)
    assert got.train.where("SK_ID_CURR IS NULL").count() == 3
    again = CO.process(train, test.limit(0), tables, f"{tmp_path}/run")  # a second run in the same place
    assert again.test.count() == 0 and again.train.count() == train.count()


def test_different_bucket_numbers_are_refused(spark, inputs, tmp_path):
    train, test, histories = inputs
    a = CO.write_histories({"bureau": histories["bureau"]}, f"{tmp_path}/a", 2)
    b = CO.write_histories({"pos_cash": histories["pos_cash"]}, f"{tmp_path}/b", 4)
    with pytest.raises(ValueError, match="buckets"):
        CO.process(train, test, a | b, f"{tmp_path}/run")
