"""CSV with rejects, the monitoring stream over several runs, the retrain rule."""

import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskfeat.sources import io as IO
from riskfeat.streaming import monitor as MON

TYPES = {"k": T.LongType(), "x": T.DoubleType(), "f": T.IntegerType()}


def test_damaged_lines_go_to_the_rejects(spark, tmp_path):
    src, out = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    (src / "a.csv").write_text('k,x,s,f\n1,1.5,"a, b",3\n2,oops,c,4\n3,NaN,,5\n4,2.5,d\n5,3.5,e,6,7\n6,,g,\n')
    (src / "b.csv").write_text("k,x,s,f\nseven,1,h,1\n8,1e3,i,2.5\n9,-1,j,0\n")
    rows, rejects = IO.ingest_csv(spark, str(src), out, TYPES)
    assert rows.dtypes == [("k", "bigint"), ("x", "double"), ("s", "string"), ("f", "int")]
    assert sorted(map(tuple, rows.collect())) == [(1, 1.5, "a, b", 3), (3, None, None, 5), (6, None, "g", None), (9, -1.0, "j", 0)]
    assert sorted(r["line"] for r in rejects.collect()) == ["2,oops,c,4", "4,2.5,d", "5,3.5,e,6,7", "8,1e3,i,2.5", "seven,1,h,1"]


def test_each_side_is_read_without_the_other(spark, tmp_path):
    src = tmp_path / "in.csv"
    src.write_text("k,x,s,f\n1,1,a,1\n")
    rows, rejects = IO.ingest_csv(spark, str(src), str(tmp_path / "out"), TYPES)
    assert rows.count() == 1 and rejects.count() == 0
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "rejected" in plan.split("PartitionFilters", 1)[1].split("]")[0]
    src.write_text("k,x,s,f\n")
    rows, rejects = IO.ingest_csv(spark, str(src), str(tmp_path / "none"), TYPES)
    assert rows.count() == 0 and rejects.count() == 0


def _events(spark, path, name, rows):
    df = spark.createDataFrame(rows, "TS string, SCORE double").select(F.col("TS").cast("timestamp").alias("TS"), "SCORE")
    df.coalesce(1).write.parquet(os.path.join(path, name))
    return df


def _day(day, share, n=10):
    """n decisions of which share are approved."""
    return [(f"2024-01-{day:02d} 10:{i:02d}:00", 0.1 if i < share * n else 0.9) for i in range(n)]


def test_the_stream_goes_on_where_it_stopped(spark, tmp_path):
    src, sink, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    os.makedirs(src)
    read = lambda: {r["day"].day: (r["decisions"], r["approved"], r["status"]) for r in spark.read.parquet(sink).collect()}
    first = _events(spark, src, "x1", _day(1, 0.65, 20) + _day(2, 0.9) + _day(3, 0.55, 20)[:10])
    run = lambda: MON.run_daily_monitor(spark, f"{src}/*", first.schema, sink, state, watermark="1 day")
    assert run() == {"rows": 40, "late_rows": 0}
    assert read() == {1: (20, 13, "OK")}  # the watermark has passed the first day only
    # a second run, as after a restart: the open days' counts come from the state
    _events(spark, src, "x2", _day(3, 0.55, 20)[10:] + _day(4, 0.3) + _day(6, 1.0))
    assert run()["rows"] == 30
    assert read() == {1: (20, 13, "OK"), 2: (10, 9, "ALERT"), 3: (20, 11, "WARN"), 4: (10, 3, "ALERT")}
    # a row of a closed day is counted as late and changes nothing
    _events(spark, src, "x3", [("2024-01-02 10:00:00", 0.1)])
    assert run() == {"rows": 1, "late_rows": 1}
    _events(spark, src, "x4", _day(9, 1.0))
    run()
    days = read()
    assert days[2] == (10, 9, "ALERT") and days[6] == (10, 10, "ALERT") and 9 not in days
    batch = {r["day"].day: (r["decisions"], r["approved"], r["status"]) for r in MON.daily_approval(spark.read.parquet(*[f"{src}/x{i}" for i in (1, 2, 4)])).collect()}
    assert days == {d: v for d, v in batch.items() if d < 9}


def test_retrain_by_comparison_with_the_week_before(spark):
    weeks = spark.createDataFrame([(1, 0.80), (2, 0.785), (3, 0.764), (4, None), (5, 0.70), (6, 0.90)], "week int, auc double")
    got = {r["week"]: (r["auc_before"], r["retrain"]) for r in MON.retrain_rule(weeks).collect()}
    assert got == {1: (None, False), 2: (0.80, False), 3: (0.785, True), 4: (0.764, False), 5: (0.764, True), 6: (0.70, False)}
