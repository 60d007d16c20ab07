"""Hand-written DuckDB SQL for the application pipeline on the fixtures.

Which columns are dropped or imputed is decided by the fixture's null shares
(written down here); medians and modes are computed by the SQL itself.
"""

from __future__ import annotations

from . import catalog_fixture as CF
from . import sqlbits as S

FEATURES_SQL = """
 CAST(DAYS_BIRTH AS DOUBLE) / -365.25E0 AS AGE_YEARS,
 CAST(DAYS_EMPLOYED AS DOUBLE) / -365.25E0 AS EMPLOYMENT_YEARS,
 CAST(DAYS_REGISTRATION AS DOUBLE) / -365.25E0 AS REGISTRATION_YEARS,
 CAST(DAYS_ID_PUBLISH AS DOUBLE) / -365.25E0 AS ID_PUBLISH_YEARS,
 {r_ci} AS CREDIT_TO_INCOME_RATIO,
 {r_ai} AS ANNUITY_TO_INCOME_RATIO,
 {r_ltv} AS LOAN_TO_VALUE_RATIO,
 {r_dp} AS DOWN_PAYMENT_RATIO,
 {r_ipc} AS INCOME_PER_CHILD,
 {r_cpp} AS CREDIT_PER_PERSON,
 {r_ita} AS INCOME_TO_AGE_RATIO,
 EXT_SOURCE_2 * EXT_SOURCE_3 AS EXT_SOURCE_2x3,
 EXT_SOURCE_1 * EXT_SOURCE_2 AS EXT_SOURCE_1x2,
 EXT_SOURCE_1 * EXT_SOURCE_3 AS EXT_SOURCE_1x3,
 (EXT_SOURCE_1 + EXT_SOURCE_2 + EXT_SOURCE_3) / 3 AS EXT_SOURCE_MEAN,
 EXT_SOURCE_1 + EXT_SOURCE_2 + EXT_SOURCE_3 AS EXT_SOURCE_SUM,
 CASE WHEN CAST(DAYS_BIRTH AS DOUBLE) / -365.25E0 < 30 THEN 'Young'
      WHEN CAST(DAYS_BIRTH AS DOUBLE) / -365.25E0 < 50 THEN 'Middle' ELSE 'Senior' END AS AGE_GROUP,
 CASE WHEN AMT_INCOME_TOTAL < 100000 THEN 'Low' WHEN AMT_INCOME_TOTAL < 200000 THEN 'Medium'
      ELSE 'High' END AS INCOME_GROUP,
 CASE WHEN OCCUPATION_TYPE IN ('Drivers', 'Laborers', 'Low-skill Laborers', 'Waiters/barmen staff')
      THEN 1 ELSE 0 END AS FLAG_HIGH_RISK_OCCUPATION,
 FLAG_DOCUMENT_2 + FLAG_DOCUMENT_3 + FLAG_DOCUMENT_4 + FLAG_DOCUMENT_5 + FLAG_DOCUMENT_6
   + FLAG_DOCUMENT_7 + FLAG_DOCUMENT_8 + FLAG_DOCUMENT_9 AS DOCUMENT_COMPLETENESS_SCORE,
 {total_missing} AS TOTAL_MISSING_FEATURES""".format(
    r_ci=S.ratio("AMT_CREDIT", "AMT_INCOME_TOTAL"),
    r_ai=S.ratio("AMT_ANNUITY", "AMT_INCOME_TOTAL"),
    r_ltv=S.ratio("AMT_CREDIT", "AMT_GOODS_PRICE"),
    r_dp=S.ratio("(AMT_GOODS_PRICE - AMT_CREDIT)", "AMT_GOODS_PRICE"),
    r_ipc=S.ratio("AMT_INCOME_TOTAL", "(CNT_CHILDREN + 1)"),
    r_cpp=S.ratio("AMT_CREDIT", "(CNT_FAM_MEMBERS + 1)"),
    r_ita=S.ratio("AMT_INCOME_TOTAL", "(CAST(DAYS_BIRTH AS DOUBLE) / -365.25E0)"),
    total_missing=" + ".join(f"FLAG_MISSING_{c}" for c in CF.FLAGGED_COLUMNS),
)


def raw_fix_ctes(frame: str) -> list[str]:
    """``{frame}_raw`` (split of applicants) and ``{frame}_fix`` (drop + sentinel)."""
    where = "IS_TRAIN = 1" if frame == "train" else "IS_TRAIN = 0"
    exclude = "IS_TRAIN" if frame == "train" else "IS_TRAIN, TARGET"
    return [
        f"{frame}_raw AS (SELECT * EXCLUDE ({exclude}) FROM applicants WHERE {where})",
        f"""{frame}_fix AS (SELECT * EXCLUDE ({', '.join(CF.DROPPED)}, DAYS_EMPLOYED),
   CASE WHEN DAYS_EMPLOYED > 15000 THEN NULL ELSE DAYS_EMPLOYED END AS DAYS_EMPLOYED,
   CAST(DAYS_EMPLOYED > 15000 AS INTEGER) AS FLAG_UNEMPLOYED_UNKNOWN
 FROM {frame}_raw)""",
    ]


def clean_cte(frame: str) -> str:
    """``{frame}_clean``: train medians / modes filled in, missing flags added."""
    imputed = list(CF.EXT) + list(CF.NUM_IMPUTE) + list(CF.CAT_IMPUTE)
    fills = ",\n ".join(
        [f"COALESCE(t.{c}, m.{c}) AS {c}" for c in CF.EXT + CF.NUM_IMPUTE]
        + [f"COALESCE(t.{c}, md_{c}.v) AS {c}" for c in CF.CAT_IMPUTE]
        + [f"CAST(t.{c} IS NULL AS INTEGER) AS FLAG_MISSING_{c}" for c in CF.FLAGGED_COLUMNS]
    )
    joins = " ".join(f"CROSS JOIN mode_{c} md_{c}" for c in CF.CAT_IMPUTE)
    return f"""{frame}_clean AS (SELECT t.* EXCLUDE ({', '.join(imputed)}),
 {fills}
 FROM {frame}_fix t CROSS JOIN train_medians m {joins})"""


def train_stats_ctes() -> str:
    meds = ", ".join(f"median({c}) AS {c}" for c in CF.EXT + CF.NUM_IMPUTE)
    parts = [f"train_medians AS (SELECT {meds} FROM train_fix)"]
    for c in CF.CAT_IMPUTE:
        parts.append(
            f"""mode_{c} AS (SELECT COALESCE(v, 'Missing') AS v FROM (
  SELECT {c} AS v, COUNT(*) AS n FROM train_fix GROUP BY {c}
  ORDER BY n DESC, v ASC NULLS LAST LIMIT 1) x)"""
        )
    return ",\n".join(parts)


def history_ctes(names=("bureau", "prev_app", "installments", "credit_card", "pos_cash")) -> str:
    from .catalog import ROLLUP_SQL

    return ",\n".join(f"agg_{n} AS ({ROLLUP_SQL[n][1]})" for n in names)


def history_columns(names=("bureau", "prev_app", "installments", "credit_card", "pos_cash")) -> list[str]:
    return [c for n in names for c in CF.HISTORY_COLUMNS[n]]


def feat_cte(frame: str) -> str:
    return f"{frame}_feat AS (SELECT *, {FEATURES_SQL} FROM {frame}_clean)"


def joined_select(frame: str) -> str:
    """Engineered frame left-joined to the five rollups, gaps filled with 0."""
    names = ["bureau", "prev_app", "installments", "credit_card", "pos_cash"]
    joins = " ".join(f"LEFT JOIN agg_{n} USING (SK_ID_CURR)" for n in names)
    fills = ", ".join(f"COALESCE({c}, 0) AS {c}" for c in history_columns(names))
    return f"SELECT f.*, {fills} FROM {frame}_feat f {joins}"


def with_ctes(fixtures: list[str], ctes: list[str], select: str) -> str:
    from ..sources.fixtures import duckdb_view_sql

    parts = [f"{n} AS ({duckdb_view_sql(n)}\n)" for n in fixtures] + ctes
    return "WITH " + ",\n".join(parts) + "\n" + select


HISTORY_FIXTURES = ["bureau_like", "prev_like", "inst_like", "cc_like", "pos_like"]


def app_ctes(frame: str, engineered: bool = True) -> list[str]:
    """Raw -> fixed -> train stats -> cleaned (-> engineered) CTEs for a frame."""
    ctes = raw_fix_ctes("train") + [train_stats_ctes()]
    if frame != "train":
        ctes += raw_fix_ctes(frame)
    ctes.append(clean_cte(frame))
    if engineered:
        ctes.append(feat_cte(frame))
    return ctes
