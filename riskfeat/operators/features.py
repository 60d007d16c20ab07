"""Row-level application features (ages, ratios, interactions, bins).

Each function returns ``{name: Column}`` so the pipeline can add everything
in one projection. Divisions go through ``ratio`` (IEEE rule).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import exprs as X

# Fixed values that must equal the reference's for identical results.
# Occupation labels treated as high risk:
HIGH_RISK_OCCUPATIONS = ("Drivers", "Laborers", "Low-skill Laborers", "Waiters/barmen staff")
# Age bins in years: < 30 Young, < 50 Middle, else Senior.
AGE_CUTS, AGE_LABELS = (30, 50), ("Young", "Middle", "Senior")
# Income bins: < 100000 Low, < 200000 Medium, else High.
INCOME_CUTS, INCOME_LABELS = (100000, 200000), ("Low", "Medium", "High")
# Document flags summed into the completeness score.
DOCUMENT_FLAGS = tuple(f"FLAG_DOCUMENT_{i}" for i in range(2, 10))
EXT_SOURCES = ("EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3")

# Names of the engineered columns (all three scores present, no CNT_PAYMENT).
FEATURE_NAMES = (
    "AGE_YEARS", "EMPLOYMENT_YEARS", "REGISTRATION_YEARS", "ID_PUBLISH_YEARS",
    "CREDIT_TO_INCOME_RATIO", "ANNUITY_TO_INCOME_RATIO", "LOAN_TO_VALUE_RATIO", "DOWN_PAYMENT_RATIO",
    "INCOME_PER_CHILD", "CREDIT_PER_PERSON", "INCOME_TO_AGE_RATIO",
    "EXT_SOURCE_2x3", "EXT_SOURCE_1x2", "EXT_SOURCE_1x3", "EXT_SOURCE_MEAN", "EXT_SOURCE_SUM",
    "AGE_GROUP", "INCOME_GROUP", "FLAG_HIGH_RISK_OCCUPATION", "DOCUMENT_COMPLETENESS_SCORE",
    "TOTAL_MISSING_FEATURES",
)


def demographic(columns: Sequence[str]) -> dict[str, Column]:
    return {
        "AGE_YEARS": X.years_from_days("DAYS_BIRTH"),
        "EMPLOYMENT_YEARS": X.years_from_days("DAYS_EMPLOYED"),
        "REGISTRATION_YEARS": X.years_from_days("DAYS_REGISTRATION"),
        "ID_PUBLISH_YEARS": X.years_from_days("DAYS_ID_PUBLISH"),
    }


def financial_ratios(columns: Sequence[str]) -> dict[str, Column]:
    out = {
        "CREDIT_TO_INCOME_RATIO": X.ratio("AMT_CREDIT", "AMT_INCOME_TOTAL"),
        "ANNUITY_TO_INCOME_RATIO": X.ratio("AMT_ANNUITY", "AMT_INCOME_TOTAL"),
        "LOAN_TO_VALUE_RATIO": X.ratio("AMT_CREDIT", "AMT_GOODS_PRICE"),
        "DOWN_PAYMENT_RATIO": X.ratio(F.col("AMT_GOODS_PRICE") - F.col("AMT_CREDIT"), "AMT_GOODS_PRICE"),
        "INCOME_PER_CHILD": X.ratio("AMT_INCOME_TOTAL", F.col("CNT_CHILDREN") + 1),
        "CREDIT_PER_PERSON": X.ratio("AMT_CREDIT", F.col("CNT_FAM_MEMBERS") + 1),
        "INCOME_TO_AGE_RATIO": X.ratio("AMT_INCOME_TOTAL", X.years_from_days("DAYS_BIRTH")),
    }
    if "CNT_PAYMENT" in columns:
        out["PAYMENT_TO_CREDIT_RATIO"] = X.ratio(
            F.col("AMT_ANNUITY").cast("double") * F.col("CNT_PAYMENT").cast("double"), "AMT_CREDIT"
        )
    return out


def interactions(columns: Sequence[str], high_risk: Sequence[str] = HIGH_RISK_OCCUPATIONS) -> dict[str, Column]:
    ext = [c for c in EXT_SOURCES if c in columns]
    out: dict[str, Column] = {}
    pairs = [("EXT_SOURCE_2", "EXT_SOURCE_3", "2x3"), ("EXT_SOURCE_1", "EXT_SOURCE_2", "1x2"),
             ("EXT_SOURCE_1", "EXT_SOURCE_3", "1x3")]
    for a, b, tag in pairs:
        if a in ext and b in ext:
            out[f"EXT_SOURCE_{tag}"] = F.col(a) * F.col(b)
    if ext:
        total = X.row_sum(ext)
        out["EXT_SOURCE_MEAN"] = total / F.lit(len(ext))
        out["EXT_SOURCE_SUM"] = total
    out["AGE_GROUP"] = X.bucketize(X.years_from_days("DAYS_BIRTH"), AGE_CUTS, AGE_LABELS)
    out["INCOME_GROUP"] = X.bucketize("AMT_INCOME_TOTAL", INCOME_CUTS, INCOME_LABELS)
    out["FLAG_HIGH_RISK_OCCUPATION"] = X.in_set_flag("OCCUPATION_TYPE", high_risk)
    out["DOCUMENT_COMPLETENESS_SCORE"] = X.row_sum(list(DOCUMENT_FLAGS))
    return out


def missing_total(columns: Sequence[str]) -> dict[str, Column]:
    flags = [c for c in columns if c.startswith("FLAG_MISSING_")]
    if not flags:
        return {}
    return {"TOTAL_MISSING_FEATURES": X.row_sum_skip_null(flags)}


def application_features(columns: Sequence[str]) -> dict[str, Column]:
    """All engineered application columns, in the reference's order."""
    out: dict[str, Column] = {}
    for part in (demographic, financial_ratios, interactions, missing_total):
        out.update(part(columns))
    return out
