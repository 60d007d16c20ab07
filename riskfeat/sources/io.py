"""Readers and sinks: application / history tables, processed outputs, score
files, and load-or-build materialisation.

Schemas are declared for the columns the library names; the types of other
columns are inferred (one more pass over a CSV), so that numbers arrive as
numbers. ``infer_rest=False`` reads them as ``default_type`` instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

L, D, I, S = T.LongType(), T.DoubleType(), T.IntegerType(), T.StringType()

# Declared types of the columns the pipeline uses (others pass through).
APPLICATION_TYPES = {
    "SK_ID_CURR": L, "TARGET": I, "DAYS_EMPLOYED": L, "DAYS_BIRTH": L, "DAYS_REGISTRATION": D,
    "DAYS_ID_PUBLISH": L, "AMT_CREDIT": D, "AMT_INCOME_TOTAL": D, "AMT_ANNUITY": D,
    "AMT_GOODS_PRICE": D, "CNT_CHILDREN": L, "CNT_FAM_MEMBERS": D, "EXT_SOURCE_1": D,
    "EXT_SOURCE_2": D, "EXT_SOURCE_3": D, "OCCUPATION_TYPE": S, "CODE_GENDER": S,
    "NAME_EDUCATION_TYPE": S, "CNT_PAYMENT": D,
    **{f"FLAG_DOCUMENT_{i}": I for i in range(2, 10)},
}
HISTORY_TYPES = {
    "bureau": {"SK_ID_CURR": L, "CREDIT_ACTIVE": S, "CREDIT_TYPE": S, "DAYS_CREDIT": L,
               "AMT_CREDIT_SUM": D, "AMT_CREDIT_SUM_DEBT": D, "AMT_CREDIT_SUM_OVERDUE": D,
               "AMT_CREDIT_MAX_OVERDUE": D},
    "prev_app": {"SK_ID_CURR": L, "NAME_CONTRACT_STATUS": S, "AMT_APPLICATION": D, "AMT_CREDIT": D,
                 "AMT_DOWN_PAYMENT": D, "DAYS_DECISION": L},
    "installments": {"SK_ID_CURR": L, "DAYS_INSTALMENT": D, "DAYS_ENTRY_PAYMENT": D,
                     "AMT_INSTALMENT": D, "AMT_PAYMENT": D},
    "credit_card": {"SK_ID_CURR": L, "AMT_BALANCE": D, "AMT_CREDIT_LIMIT_ACTUAL": D,
                    "AMT_DRAWINGS_CURRENT": D, "AMT_PAYMENT_CURRENT": D,
                    "AMT_PAYMENT_TOTAL_CURRENT": D, "AMT_INST_MIN_REGULARITY": D},
    "pos_cash": {"SK_ID_CURR": L, "NAME_CONTRACT_STATUS": S, "SK_DPD": L, "SK_DPD_DEF": L,
                 "CNT_INSTALMENT": D, "CNT_INSTALMENT_FUTURE": D},
}


def _header(spark: SparkSession, path: str) -> list[str]:
    """Column names from the header, quoted commas included."""
    return spark.read.option("header", True).csv(path).columns


def read_csv_table(spark: SparkSession, path: str, declared: dict[str, T.DataType],
                   default_type: T.DataType = S, infer_rest: bool = True) -> DataFrame:
    """CSV with header: declared columns get their type; the rest get inferred
    types (``default_type`` without ``infer_rest``). NaN literals in numeric
    columns become null (one missing-value state)."""
    if infer_rest:
        df = spark.read.option("header", True).option("inferSchema", True).option("nanValue", "NaN").csv(path)
        from pyspark.sql import functions as F

        return nan_to_null(df.select(*[F.col(c).cast(declared[c]).alias(c) if c in declared else F.col(c)
                                       for c in df.columns]))
    names = _header(spark, path)
    schema = T.StructType([T.StructField(n, declared.get(n, default_type), True) for n in names])
    df = (spark.read.schema(schema).option("header", True).option("nanValue", "NaN")
          .option("enforceSchema", False).option("mode", "FAILFAST").csv(path))
    return nan_to_null(df)


CORRUPT = "_corrupt_record"


def ingest_csv(spark: SparkSession, path: str, out: str, declared: dict[str, T.DataType],
               default_type: T.DataType = S) -> tuple[DataFrame, DataFrame]:
    """``(rows, rejects)`` of a CSV with header, from one pass over it.

    Every column has a declared type (others ``default_type``), so nothing is
    inferred. A line with too few or too many fields, or a value that is not of
    its column's type, stops nothing: it goes to the rejects with its text.
    Both sides are one Parquet table in ``out``, parted by ``rejected``, so that
    each is read without the other; NaN becomes null.
    """
    names = _header(spark, path)
    fields = [T.StructField(n, declared.get(n, default_type), True) for n in names] + [T.StructField(CORRUPT, S, True)]
    parsed = (spark.read.schema(T.StructType(fields)).option("header", True).option("nanValue", "NaN").option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", CORRUPT).csv(path))
    from pyspark.sql import functions as F

    nan_to_null(parsed).withColumn("rejected", F.col(CORRUPT).isNotNull()).write.mode("overwrite").partitionBy("rejected").parquet(out)
    table = spark.read.schema(T.StructType([*fields, T.StructField("rejected", T.BooleanType())])).parquet(out)
    return table.where(~F.col("rejected")).drop("rejected", CORRUPT), table.where("rejected").select(F.col(CORRUPT).alias("line"))


def nan_to_null(df: DataFrame) -> DataFrame:
    """One missing state: NaN in float columns becomes null (one projection)."""
    from pyspark.sql import functions as F

    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    if not floats:
        return df
    return df.select(*[F.when(F.isnan(F.col(c)), F.lit(None)).otherwise(F.col(c)).alias(c) if c in floats
                       else F.col(c) for c in df.columns])


def read_application(spark: SparkSession, path: str, **kw) -> DataFrame:
    return read_csv_table(spark, path, APPLICATION_TYPES, **kw)


def read_history(spark: SparkSession, path: str, kind: str, **kw) -> DataFrame:
    return read_csv_table(spark, path, HISTORY_TYPES[kind], **kw)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Parquet folder or file (the default storage for everything we write)."""
    return spark.read.parquet(path)


def save_processed(train: DataFrame, test: DataFrame, out_dir: str, fmt: str = "parquet") -> tuple[str, str]:
    """Write both processed frames (folders, written in parallel by tasks)."""
    paths = (f"{out_dir.rstrip('/')}/application_train_processed", f"{out_dir.rstrip('/')}/application_test_processed")
    for df, p in zip((train, test), paths):
        w = df.write.mode("overwrite")
        (w.option("header", True).csv(p) if fmt == "csv" else w.format(fmt).save(p))
    return paths


def write_scores(scores: DataFrame, path: str, key: str = "SK_ID_CURR", score: str = "SCORE",
                 fmt: str = "csv") -> str:
    """Score file ``(key, TARGET = probability)``."""
    out = scores.select(key, scores[score].alias("TARGET"))
    w = out.write.mode("overwrite")
    (w.option("header", True).csv(path) if fmt == "csv" else w.format(fmt).save(path))
    return path


def _exists(spark: SparkSession, path: str) -> bool:
    """True when a finished write left its ``_SUCCESS`` marker (resolving the
    path is enough: no job runs)."""
    from pyspark.errors import AnalysisException

    try:
        spark.read.format("text").load(path.rstrip("/") + "/_SUCCESS")
        return True
    except AnalysisException:
        return False


def load_or_build(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Read ``path`` if a finished write exists (``_SUCCESS``), else build it,
    write it, and return the re-read table (lineage cut at the write)."""
    if not _exists(spark, path):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
