"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is forced with a ``noop`` write (full computation, nothing
collected) and timed best-of-$BENCH_REPEAT (default 2). The fit job (null
profile + exact medians + modes) is timed on its own and again inside
``train_features`` (plan cache cleared before every run). Prints one JSON line.

``BENCH_REPLICAS=24`` at sf0.1 times the whole train + test job instead, at the
baseline's row counts (360,000 applicants, about 34 million history rows): every
row of the fixture tables is repeated under a key of its own and written to
``BENCH_DIR`` first. Each time goes to stderr as soon as it is known.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
WITH_ML = os.environ.get("BENCH_ML", "0") == "1"
REPLICAS = int(os.environ.get("BENCH_REPLICAS", "0"))
REPEAT = max(1, int(os.environ.get("BENCH_REPEAT", "2")))  # best of N per query

HEADLINE = [
    "bureau_rollup", "prev_rollup", "inst_rollup", "cc_rollup", "pos_rollup",
    "assemble_histories", "train_features", "test_features", "app_only",
    "feature_summary", "roc_auc", "roc_points", "threshold_sweep", "stratified_folds",
    "top_reasons", "daily_monitor",
]
ML = ["cv_models"]


def _sf(path: str) -> str:
    name = os.path.basename(path)
    return name[2:] if name.startswith("sf") else name


def at_size(spark) -> dict[str, float]:
    """Seconds of the train + test job over ``REPLICAS`` copies of the fixture tables."""
    import tempfile

    from pyspark.sql import functions as F

    from riskfeat.plans import assembly as PL
    from riskfeat.plans import catalog as C
    from riskfeat.plans import colocated as CO
    from riskfeat.sources import fixtures as FX
    from riskfeat.sources import io as IO

    root = tempfile.mkdtemp(prefix="bench-", dir=os.environ.get("BENCH_DIR"))
    times: dict[str, float] = {}

    def timed(name, run):
        t = time.perf_counter()
        out = run()
        times[name] = round(time.perf_counter() - t, 1)
        print(name, times[name], file=sys.stderr, flush=True)
        return out

    def copies(df, name):
        copy = F.explode(F.sequence(F.lit(0), F.lit(REPLICAS - 1)))
        out = df.withColumn("_copy", copy).withColumn("SK_ID_CURR", F.col("SK_ID_CURR") + F.col("_copy") * 10_000_000)
        out.drop("_copy").write.parquet(f"{root}/{name}")
        return spark.read.parquet(f"{root}/{name}")

    def inputs():
        app = copies(C.applicants(spark, SF_DIR), "applicants")
        return app, {k: copies(FX.load(spark, SF_DIR, v), k) for k, v in C.HISTORY_FIXTURE.items()}

    app, histories = timed("write_inputs", inputs)
    times["applicants"] = app.count()
    times["history_rows"] = sum(df.count() for df in histories.values())
    train, test = C.split_train_test(app)

    def plain():
        res = PL.process_pipeline(train, test, histories)
        IO.save_processed(res.train, res.test, f"{root}/plain")

    timed("train_test_pipeline", plain)
    tables = timed("write_buckets", lambda: CO.write_histories(histories, f"{root}/histories", 4 * CPUS))
    timed("train_test_colocated", lambda: CO.process(train, test, tables, f"{root}/run"))
    return times


def main() -> None:
    from riskfeat.plans import catalog as C
    from riskfeat.session import build_session

    spark = build_session(master=f"local[{CPUS}]", app_name="riskfeat-bench", shuffle_partitions=max(8, 2 * CPUS))

    if REPLICAS:
        times = at_size(spark)
        print(json.dumps({"metric": "train_test_at_size", "value": times["train_test_pipeline"], "unit": "sec", "queries": times, "sf": _sf(SF_DIR), "cpus": CPUS, "replicas": REPLICAS}))
        spark.stop()
        return

    def force(df):
        df.write.format("noop").mode("overwrite").save()

    # warm the JVM (class loading, codegen caches) on the smallest folder
    warm = "/root/testdata/sf0.001"
    if os.path.isdir(warm):
        force(C.QUERIES["train_features"](spark, warm))
        C._PLANS.clear()

    from riskfeat.operators import fit as FIT

    def best(run) -> float:
        out = []
        for _ in range(REPEAT):
            C._PLANS.clear()  # every run includes its own fit
            t = time.perf_counter()
            run()
            out.append(time.perf_counter() - t)
        return round(min(out), 3)

    times: dict[str, float] = {}
    times["fit_job"] = best(lambda: FIT.fit_plan(C.split_train_test(C.applicants(spark, SF_DIR))[0]))
    names = HEADLINE + (ML if WITH_ML else [])
    for name in names:
        times[name] = best(lambda: force(C.QUERIES[name](spark, SF_DIR)))

    total = round(sum(times.values()), 3)
    print(json.dumps({
        "metric": "headline_total_wall",
        "value": total,
        "unit": "sec",
        "queries": times,
        "sf": _sf(SF_DIR),
        "cpus": CPUS,
        "spark": spark.version,
        "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"),
        "repeat": REPEAT,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
