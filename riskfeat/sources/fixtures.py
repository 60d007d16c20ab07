"""Fixture views: credit-risk shaped tables projected from the test tables.

Each view is one SQL text with two dialect hooks (table reference and a
day-difference function), so Spark and DuckDB read the very same rows.
Column names follow the application / history schema the library expects
(``SK_ID_CURR`` key, ``TARGET`` label, ``DAYS_*`` / ``AMT_*`` ...).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

TableRef = Callable[[str], str]
DaysFn = Callable[[str, str], str]

BASE_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


# Default: low external scores and a low balance (about one in eleven).
_DEFAULTED = "CASE WHEN c_acctbal + 8 * ((c_custkey * 7907) % 1000) + 5 * ((c_custkey * 6007) % 1000) < 5000 THEN 1 ELSE 0 END"
_OCCUPATION = """CASE WHEN c_custkey % 3 = 0 THEN NULL WHEN c_mktsegment = 'AUTOMOBILE' THEN 'Drivers'
      WHEN c_mktsegment = 'MACHINERY' THEN 'Laborers' ELSE c_mktsegment END"""


def _applicants(t: TableRef, days: DaysFn) -> str:
    return f"""
SELECT c_custkey AS SK_ID_CURR,
 CASE WHEN c_custkey % 5 = 0 THEN 0 ELSE 1 END AS IS_TRAIN,
 {_DEFAULTED} AS TARGET,
 CASE WHEN c_custkey % 6 = 0 THEN 365243 WHEN c_custkey % 11 = 0 THEN NULL
      ELSE -((c_custkey * 37) % 9000) - 1 END AS DAYS_EMPLOYED,
 -((c_custkey * 7919) % 18000) - 7300 AS DAYS_BIRTH,
 -((c_custkey * 31) % 6000) AS DAYS_REGISTRATION,
 -((c_custkey * 17) % 5000) AS DAYS_ID_PUBLISH,
 CAST((c_custkey * 613) % 300000 + 25000 AS DOUBLE) AS AMT_INCOME_TOTAL,
 CAST((c_custkey * 1009) % 900000 + 45000 AS DOUBLE) AS AMT_CREDIT,
 CASE WHEN c_custkey % 97 = 0 THEN NULL ELSE CAST((c_custkey * 211) % 50000 + 2000 AS DOUBLE) END AS AMT_ANNUITY,
 CASE WHEN c_custkey % 89 = 0 THEN NULL WHEN c_custkey % 83 = 0 THEN CAST(0 AS DOUBLE)
      ELSE CAST((c_custkey * 907) % 800000 + 40000 AS DOUBLE) END AS AMT_GOODS_PRICE,
 c_custkey % 4 AS CNT_CHILDREN,
 CASE WHEN c_custkey % 101 = 0 AND c_custkey % 5 <> 0 THEN NULL ELSE c_custkey % 5 + 1 END AS CNT_FAM_MEMBERS,
 CASE WHEN (c_custkey * 13) % 100 < 45 THEN NULL ELSE CAST((c_custkey * 104729) % 1000 AS DOUBLE) / 1000.0E0 END AS EXT_SOURCE_1,
 CASE WHEN (c_custkey * 29) % 100 < 2 THEN NULL ELSE CAST((c_custkey * 7907) % 1000 AS DOUBLE) / 1000.0E0 END AS EXT_SOURCE_2,
 CASE WHEN (c_custkey * 41) % 100 < 20 THEN NULL ELSE CAST((c_custkey * 6007) % 1000 AS DOUBLE) / 1000.0E0 END AS EXT_SOURCE_3,
 CASE WHEN c_custkey % 10 < 7 THEN NULL ELSE c_custkey % 60 END AS OWN_CAR_AGE,
 CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE c_custkey % 9 END AS HALF_MISSING,
 {_OCCUPATION} AS OCCUPATION_TYPE,
 CASE WHEN c_nationkey % 2 = 0 THEN 'F' ELSE 'M' END AS CODE_GENDER,
 CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE 0 END AS FLAG_DOCUMENT_2,
 CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 0 END AS FLAG_DOCUMENT_3,
 CASE WHEN c_custkey % 7 = 0 THEN 1 ELSE 0 END AS FLAG_DOCUMENT_4,
 CASE WHEN c_custkey % 13 = 0 THEN 1 ELSE 0 END AS FLAG_DOCUMENT_5,
 0 AS FLAG_DOCUMENT_6, 0 AS FLAG_DOCUMENT_7,
 CASE WHEN c_custkey % 17 = 0 THEN 1 ELSE 0 END AS FLAG_DOCUMENT_8, 0 AS FLAG_DOCUMENT_9
FROM {t('customer')}"""


def _bureau_like(t: TableRef, days: DaysFn) -> str:
    return f"""
SELECT o_custkey AS SK_ID_CURR,
 CASE o_orderstatus WHEN 'O' THEN 'Active' WHEN 'F' THEN 'Closed' ELSE 'Sold' END AS CREDIT_ACTIVE,
 CASE WHEN o_custkey % 19 = 0 THEN NULL ELSE o_totalprice END AS AMT_CREDIT_SUM,
 CASE WHEN o_orderstatus = 'O' AND o_custkey % 7 <> 0 THEN o_totalprice END AS AMT_CREDIT_SUM_DEBT,
 CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice ELSE CAST(0 AS DOUBLE) END AS AMT_CREDIT_SUM_OVERDUE,
 CASE WHEN o_orderpriority = '2-HIGH' THEN o_totalprice END AS AMT_CREDIT_MAX_OVERDUE,
 {days('o_orderdate', "TIMESTAMP '2001-08-02 00:00:00'")} AS DAYS_CREDIT,
 CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END AS CREDIT_TYPE
FROM {t('orders')} WHERE o_custkey % 4 <> 1"""


def _prev_like(t: TableRef, days: DaysFn) -> str:
    return f"""
SELECT o_custkey AS SK_ID_CURR,
 CASE o_orderstatus WHEN 'F' THEN 'Approved' WHEN 'P' THEN 'Refused' ELSE 'Canceled' END AS NAME_CONTRACT_STATUS,
 CASE WHEN o_orderkey % 50 = 0 THEN CAST(0 AS DOUBLE) ELSE o_totalprice END AS AMT_APPLICATION,
 o_totalprice * 0.5E0 AS AMT_CREDIT,
 CASE WHEN o_custkey % 9 = 0 OR o_orderkey % 2 = 0 THEN NULL ELSE o_totalprice * 0.25E0 END AS AMT_DOWN_PAYMENT,
 {days('o_orderdate', "TIMESTAMP '2001-08-02 00:00:00'")} AS DAYS_DECISION
FROM {t('orders')} WHERE o_custkey % 3 <> 2"""


def _inst_columns(days: DaysFn) -> str:
    return f"""
 {days('o_orderdate', "TIMESTAMP '2001-12-31 00:00:00'")} AS DAYS_INSTALMENT,
 CASE WHEN l_partkey % 40 = 0 THEN NULL ELSE {days('l_shipdate', "TIMESTAMP '2001-12-31 00:00:00'")} END AS DAYS_ENTRY_PAYMENT,
 l_extendedprice AS AMT_INSTALMENT,
 CASE WHEN l_partkey % 40 = 0 THEN NULL WHEN l_returnflag = 'R' THEN l_extendedprice * 0.5E0
      ELSE l_extendedprice END AS AMT_PAYMENT"""


def _inst_like(t: TableRef, days: DaysFn) -> str:
    return f"""
SELECT o_custkey AS SK_ID_CURR,{_inst_columns(days)}
FROM {t('lineitem')} JOIN {t('orders')} ON l_orderkey = o_orderkey"""


def _cc_like(t: TableRef, days: DaysFn) -> str:
    return f"""
SELECT user_id AS SK_ID_CURR,
 CASE WHEN event_type = 'error' THEN CAST(0 AS DOUBLE) ELSE value END AS AMT_BALANCE,
 CASE WHEN user_id % 12 = 0 THEN 0 ELSE event_id % 500 END AS AMT_CREDIT_LIMIT_ACTUAL,
 CASE WHEN user_id % 8 = 0 THEN NULL WHEN event_type = 'purchase' THEN value ELSE CAST(0 AS DOUBLE) END AS AMT_DRAWINGS_CURRENT,
 CASE WHEN event_type = 'click' THEN value END AS AMT_PAYMENT_CURRENT,
 value AS AMT_PAYMENT_TOTAL_CURRENT,
 CASE WHEN event_id % 3 = 0 THEN NULL ELSE value * 0.5E0 END AS AMT_INST_MIN_REGULARITY
FROM {t('events')}"""


_IN_POS = "o_custkey % 6 <> 4"


def _pos_columns(days: DaysFn) -> str:
    dpd = days("l_shipdate", "o_orderdate")
    return f"""
 CASE WHEN l_returnflag = 'N' THEN 'Signed' WHEN l_linestatus = 'O' THEN 'Active' ELSE 'Completed' END AS NAME_CONTRACT_STATUS,
 CASE WHEN {dpd} > 0 THEN {dpd} ELSE 0 END AS SK_DPD,
 CASE WHEN {dpd} > 1000 THEN 1 ELSE 0 END AS SK_DPD_DEF,
 l_quantity AS CNT_INSTALMENT,
 CASE WHEN l_suppkey % 10 = 0 THEN NULL ELSE CAST(l_linenumber AS DOUBLE) END AS CNT_INSTALMENT_FUTURE"""


def _pos_like(t: TableRef, days: DaysFn) -> str:
    return f"""
SELECT o_custkey AS SK_ID_CURR,{_pos_columns(days)}
FROM {t('lineitem')} JOIN {t('orders')} ON l_orderkey = o_orderkey WHERE {_IN_POS}"""


def _scored(t: TableRef, days: DaysFn) -> str:
    # Score contract of the evaluation queries: key, label, groups, score.
    return f"""
SELECT c_custkey AS SK_ID_CURR,
 {_DEFAULTED} AS TARGET,
 CASE WHEN c_nationkey % 2 = 0 THEN 'F' ELSE 'M' END AS CODE_GENDER,
 {_OCCUPATION} AS OCCUPATION_TYPE,
 CAST(CASE WHEN {_DEFAULTED} = 1 THEN 300 + (c_custkey * 613) % 700 ELSE (c_custkey * 613) % 750 END AS DOUBLE) / 1000.0E0 AS SCORE
FROM {t('customer')}"""


def _decisions(t: TableRef, days: DaysFn) -> str:
    # Timestamped scoring decisions for monitoring: every event is one
    # application scored at event time. The share of the applicant's own risk
    # in the score differs by week, the level of the scores by day.
    share = "CASE EXTRACT(WEEK FROM ts) % 3 WHEN 0 THEN 1 WHEN 1 THEN 4 ELSE 9 END"
    return f"""
SELECT event_id AS DECISION_ID, ts AS TS, user_id AS SK_ID_CURR,
 CAST((({share}) * (999 - (user_id * 7907) % 1000) + (10 - ({share})) * ((event_id * 7907) % 1000))
      * (9 + EXTRACT(DAY FROM ts) % 8) AS DOUBLE) / 200000.0E0 AS SCORE,
 CASE WHEN user_id % 2 = 0 THEN 'F' ELSE 'M' END AS CODE_GENDER
FROM {t('events')}"""


FIXTURES: dict[str, Callable[[TableRef, DaysFn], str]] = {
    "applicants": _applicants,
    "bureau_like": _bureau_like,
    "prev_like": _prev_like,
    "inst_like": _inst_like,
    "cc_like": _cc_like,
    "pos_like": _pos_like,
    "scored": _scored,
    "decisions": _decisions,
}


def _spark_days(a: str, b: str) -> str:
    return f"CAST(datediff(CAST({a} AS DATE), CAST({b} AS DATE)) AS BIGINT)"


def _duck_days(a: str, b: str) -> str:
    return f"date_diff('day', CAST({b} AS DATE), CAST({a} AS DATE))"


def duckdb_view_sql(name: str) -> str:
    """The fixture as DuckDB SQL over the pre-registered base tables."""
    return FIXTURES[name](lambda x: x, _duck_days)


def duckdb_with(names: list[str], body: str) -> str:
    """``WITH`` header defining the named fixtures, then ``body``."""
    ctes = ",\n".join(f"{n} AS ({duckdb_view_sql(n)}\n)" for n in names)
    return f"WITH {ctes}\n{body}"


def base_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one fixture view over the parquet tables in ``sf_dir``.

    Only the referenced base tables are read, and Catalyst prunes their
    columns to those the projection names.
    """
    used: dict[str, DataFrame] = {}

    def ref(table: str) -> str:
        used[table] = base_table(spark, sf_dir, table)
        return "{" + table + "}"

    text = FIXTURES[name](ref, _spark_days)
    return spark.sql(text, **used)


def load_order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``inst_like`` and ``pos_like`` side by side: their order lines meet their orders once.

    ``IN_POS`` tells the rows of ``pos_like``. Dates and remainders are taken
    before the join, so that its shuffle carries no more than they need.
    """
    lines = """(SELECT l_orderkey, CAST(l_shipdate AS DATE) AS l_shipdate, l_extendedprice, l_returnflag, l_linestatus, l_quantity,
 l_linenumber, l_partkey % 40 AS l_partkey, l_suppkey % 10 AS l_suppkey FROM {lineitem})"""
    orders = "(SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS o_orderdate FROM {orders})"
    text = f"""SELECT o_custkey AS SK_ID_CURR, {_IN_POS} AS IN_POS,{_inst_columns(_spark_days)},{_pos_columns(_spark_days)}
FROM {lines} JOIN {orders} ON l_orderkey = o_orderkey"""
    return spark.sql(text, **{t: base_table(spark, sf_dir, t) for t in ("lineitem", "orders")})
