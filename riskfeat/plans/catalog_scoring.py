"""Registered queries of linear scorers (scores, contributions, attribution,
reasons), of candidate ranking and of the processed frame's summary.

The SQL-checked ones apply an exported scorecard (a coefficient table, as a
policy states it) to the whole training frame; ``linear_model`` fits one.
"""

from __future__ import annotations

import uuid

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..operators import attribution as AT
from ..operators import explain as XP
from ..operators import features as FE
from . import app_sql as A
from . import catalog as C
from . import catalog_fixture as CF
from . import lifecycle as LC
from . import modeling as ML
from . import search as SE

# An exported scorecard: log-odds of default per unit of each feature.
SCORECARD = {
    "EXT_SOURCE_1": -0.9, "EXT_SOURCE_2": -3.1, "EXT_SOURCE_3": -2.4, "AGE_YEARS": -0.02, "EMPLOYMENT_YEARS": -0.012,
    "CREDIT_TO_INCOME_RATIO": 0.05, "ANNUITY_TO_INCOME_RATIO": 0.09, "BUREAU_TOTAL_CREDIT": -1e-7,
    "INST_LATE_PAYMENT_RATE": 0.4, "FLAG_HIGH_RISK_OCCUPATION": 0.05,
}
INTERCEPT = 2.5
DENY_AT = 0.35
DIGITS = 9  # means are double sums, whose last digits depend on the order of the rows

_KEY = ["SK_ID_CURR"]


def scorecard_frame(spark, sf_dir):
    """The scorer and ``(key, contributions, values, logit, SCORE)`` of the training frame."""
    frame = C.feature_frame(spark, sf_dir, "train").select(*_KEY, *SCORECARD)
    frame = C.checkpoint(frame)  # read twice: means, then rows
    scorer = AT.from_scorecard(frame, SCORECARD, INTERCEPT)
    return scorer, AT.attribute(frame.withColumn("values", AT.values_of(scorer)), scorer, [*_KEY, "values"], F.col("values"))


def _sql(select: str, more: tuple[str, ...] = ()) -> str:
    """CTEs: j (frame), m (means), p (one row per applicant and feature)."""
    means = ", ".join(f"AVG({c}) AS {c}" for c in SCORECARD)
    parts = "\nUNION ALL\n".join(
        f"SELECT j.SK_ID_CURR, '{c}' AS feature, CAST(j.{c} AS DOUBLE) AS x, m.{c} AS mean, {w!r}::DOUBLE AS w FROM j CROSS JOIN m" for c, w in SCORECARD.items())
    ctes = A.app_ctes("train") + [A.history_ctes(), f"j AS ({A.joined_select('train')})", f"m AS (SELECT {means} FROM j)",
                                   f"p AS (SELECT *, (x - mean) * w AS contribution FROM ({parts}) q)",
                                   f"s AS (SELECT SK_ID_CURR, {INTERCEPT!r}::DOUBLE + SUM(w * x) AS logit, {INTERCEPT!r}::DOUBLE + SUM(w * mean) AS base, SUM(contribution) AS pushed FROM p GROUP BY 1)", *more]
    return A.with_ctes(["applicants"] + A.HISTORY_FIXTURES, ctes, select)


def _rounded(c) -> F.Column:
    return F.round(c, DIGITS)


@C.register("linear_contributions", _sql(f"SELECT SK_ID_CURR, feature, ROUND(contribution, {DIGITS}) AS contribution FROM p"))
def q_contributions(spark, sf_dir):
    scorer, rows = scorecard_frame(spark, sf_dir)
    return AT.per_feature(rows, scorer, _KEY).select(*_KEY, "feature", _rounded("contribution").alias("contribution"))


@C.register("linear_scores", _sql(f"""SELECT SK_ID_CURR, ROUND(base, {DIGITS}) AS base_logit, ROUND(pushed, {DIGITS}) AS pushed,
 ROUND(logit, {DIGITS}) AS logit, ROUND(1 / (1 + EXP(-logit)), {DIGITS}) AS SCORE FROM s"""))
def q_scores(spark, sf_dir):
    """Base and contributions add up to the log-odds, which the SQL sums from coefficients and values."""
    scorer, rows = scorecard_frame(spark, sf_dir)
    pushed = AT.total(F.col("contributions"))
    return rows.select(*_KEY, _rounded(F.lit(scorer.base)).alias("base_logit"), _rounded(pushed).alias("pushed"),
                       _rounded("logit").alias("logit"), _rounded("SCORE").alias("SCORE"))


@C.register("linear_attribution", _sql(f"""SELECT feature, ROUND(AVG(ABS(contribution)), {DIGITS}) AS mean_abs,
 CAST(ROW_NUMBER() OVER (ORDER BY AVG(ABS(contribution)) DESC, feature) AS INTEGER) AS rank FROM p GROUP BY feature
 ORDER BY rank LIMIT 10"""))
def q_attribution(spark, sf_dir):
    scorer, rows = scorecard_frame(spark, sf_dir)
    return AT.ranking(rows, scorer, 10).select("feature", _rounded("mean_abs").alias("mean_abs"), "rank")


def _reasons_sql() -> str:
    text = " ".join(f"WHEN '{r.feature}' THEN '{r.text}'" for r in XP.REASON_MAP)
    low = ", ".join(f"'{r.feature}'" for r in XP.REASON_MAP if r.direction == "low")
    high = ", ".join(f"'{r.feature}'" for r in XP.REASON_MAP if r.direction == "high")
    return _sql("""SELECT SK_ID_CURR, reason_rank, CASE WHEN reason_rank = 1 THEN 'primary' ELSE 'secondary' END AS reason_kind, feature, reason,
 ROUND(contribution, 9) AS contribution FROM r WHERE reason_rank <= 5""", (f"""r AS (SELECT p.SK_ID_CURR, feature, CASE feature {text} END AS reason, contribution,
  CAST(ROW_NUMBER() OVER (PARTITION BY p.SK_ID_CURR ORDER BY contribution DESC, feature) AS INTEGER) AS reason_rank
 FROM p JOIN s USING (SK_ID_CURR) WHERE contribution > 0 AND 1 / (1 + EXP(-logit)) >= {DENY_AT}
  AND ((feature IN ({low}) AND x < mean) OR (feature IN ({high}) AND x > mean)))""",))


@C.register("adverse_reasons", _reasons_sql())
def q_adverse(spark, sf_dir):
    scorer, rows = scorecard_frame(spark, sf_dir)
    out = AT.signed_reasons(rows.where(F.col("SCORE") >= DENY_AT), scorer, _KEY)
    return out.withColumn("contribution", _rounded("contribution"))


# ------------------------------------------------------------- fitted scorer
def fit_linear(matrix, features, regularisation: float = 1e-4):
    """A standardised logistic regression on the matrix, and its scorer."""
    est = LogisticRegression(labelCol=ML.LABEL, featuresCol="features", regParam=regularisation, maxIter=200, tol=1e-8)
    model = est.fit(matrix)
    return model, AT.from_model(model, matrix, features)


@C.register("linear_model")
def q_linear_model(spark, sf_dir):
    """Every feature of a model fitted on the whole matrix: coefficient, mean, mean contributions, rank."""
    m, plan = C.train_matrix(spark, sf_dir)
    _, scorer = fit_linear(m, plan.features)
    rows = AT.attribute(m, scorer, [ML.KEY], vector_to_array("features"))
    return scorer.table(spark).join(AT.ranking(rows, scorer, None), "feature")




# ------------------------------------- candidates ranked over the same folds
def univariate_fits(spark, sf_dir):
    """``(candidate, fold, auc)``: every imputed numeric column, on its own, as a score on each held-out fold.

    All columns and folds are scored by one grouped AUC job.
    """
    frame = C.cleaned(spark, sf_dir, "train").select("SK_ID_CURR", "TARGET", *CF.NUMERIC_FIT)
    folds = C.R.stratified_folds(frame, "TARGET", "SK_ID_CURR", 3, 42)
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("candidate"), F.col(c).cast("double").alias("SCORE")) for c in CF.NUMERIC_FIT]))
    long = folds.select("TARGET", "fold", pairs.alias("p")).select("TARGET", F.struct("p.candidate", "fold").alias("fit"), "p.SCORE")
    return C.V.roc_auc_by(long, "fit").select("fit.candidate", "fit.fold", "auc")


_FITS_CTES = A.app_ctes("train", engineered=False) + [
    f"fo AS (SELECT *, CAST(({C._class_rank_sql(42)} - 1) % 3 AS INTEGER) AS fold FROM train_clean)",
    "lg AS (" + "\nUNION ALL\n".join(f"SELECT '{c}' AS candidate, fold, TARGET, CAST({c} AS DOUBLE) AS score FROM fo" for c in CF.NUMERIC_FIT) + ")",
    """g AS (SELECT candidate, fold, score, COUNT(*) FILTER (WHERE TARGET = 1) AS pos, COUNT(*) FILTER (WHERE TARGET <> 1) AS neg
      FROM lg WHERE score IS NOT NULL GROUP BY ALL)""",
    """c AS (SELECT *, COALESCE(SUM(neg) OVER (PARTITION BY candidate, fold ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g)""",
    """fits AS (SELECT candidate, fold, CAST(SUM(pos * (2 * below + neg)) AS DOUBLE) / (2.0E0 * CAST(SUM(pos) AS DOUBLE) * CAST(SUM(neg) AS DOUBLE)) AS auc
      FROM c GROUP BY candidate, fold)""",
    """w AS (SELECT candidate, MAX(auc) FILTER (WHERE fold = 0) AS a, MAX(auc) FILTER (WHERE fold = 1) AS b, MAX(auc) FILTER (WHERE fold = 2) AS c
      FROM fits GROUP BY candidate)""",
    """ranked AS (SELECT candidate, 3 AS folds, m AS mean_auc, sqrt(((a - m) * (a - m) + (b - m) * (b - m) + (c - m) * (c - m)) / 3.0E0) AS std_auc,
      CAST(RANK() OVER (ORDER BY m DESC) AS INTEGER) AS rank FROM (SELECT *, (a + b + c) / 3.0E0 AS m FROM w) v)""",
]


@C.register("univariate_folds", A.with_ctes(["applicants"], _FITS_CTES, "SELECT candidate, fold, auc FROM fits"))
def q_univariate_folds(spark, sf_dir):
    return univariate_fits(spark, sf_dir)


@C.register("univariate_ranking", A.with_ctes(["applicants"], _FITS_CTES, "SELECT * FROM ranked"))
def q_univariate_ranking(spark, sf_dir):
    """Mean, spread and competition rank of candidates, as the search ranks its own."""
    return SE.rank_fits(univariate_fits(spark, sf_dir))


@C.register("univariate_top", A.with_ctes(["applicants"], _FITS_CTES, "SELECT * FROM ranked ORDER BY rank, candidate LIMIT 5"))
def q_univariate_top(spark, sf_dir):
    return SE.rank_fits(univariate_fits(spark, sf_dir)).orderBy("rank", "candidate").limit(5)


# ------------------------------------------- summary of the processed frame
NUMERIC = [c for c in dict.fromkeys(
    [c for c in CF.APPLICANT_COLUMNS if c != "IS_TRAIN" and c not in CF.DROPPED and c not in CF.STRING_FIT]
    + ["FLAG_UNEMPLOYED_UNKNOWN"] + [f"FLAG_MISSING_{c}" for c in CF.FLAGGED_COLUMNS] + list(FE.FEATURE_NAMES) + A.history_columns()
) if c not in ("AGE_GROUP", "INCOME_GROUP")]


def _frame_sql(select: str) -> str:
    ctes = A.app_ctes("train") + [A.history_ctes(), f"pt AS ({A.joined_select('train')})"]
    return A.with_ctes(["applicants"] + A.HISTORY_FIXTURES, ctes, select)


def _summary_sql(columns) -> str:
    """Mean and spread to six digits behind the point (see DIGITS); all else as it is."""
    return _frame_sql("\nUNION ALL\n".join(f"""
SELECT '{c}' AS column_name, COUNT(v) AS count, COUNT(*) - COUNT(v) AS null_count, ROUND(AVG(v), 6) AS mean, ROUND(STDDEV_SAMP(v), 6) AS std,
 MIN(v) AS min, MAX(v) AS max, ROUND(QUANTILE_CONT(v, 0.25), 9) AS q25, ROUND(QUANTILE_CONT(v, 0.5), 9) AS q50, ROUND(QUANTILE_CONT(v, 0.75), 9) AS q75
FROM (SELECT CASE WHEN isfinite(CAST({c} AS DOUBLE)) THEN CAST({c} AS DOUBLE) END AS v FROM pt) x""" for c in columns))


def _rounded_summary(df):
    digits = {"mean": 6, "std": 6, "q25": 9, "q50": 9, "q75": 9}
    return df.withColumns({c: F.round(c, n) for c, n in digits.items()})


@C.register("processed_summary", _summary_sql(NUMERIC))
def q_processed_summary(spark, sf_dir):
    """Every numeric column of the processed training frame, histories included."""
    return _rounded_summary(C.P.processed_summary(C.checkpoint(C.feature_frame(spark, sf_dir, "train"))))


@C.register("preview_statistics", _summary_sql(C.P.PREVIEW_FEATURES))
def q_preview_statistics(spark, sf_dir):
    frame = C.feature_frame(spark, sf_dir, "train")
    return _rounded_summary(C.P.preview_statistics(C.checkpoint(frame.select(*C.P.PREVIEW_FEATURES))))


@C.register("preview_rows", _frame_sql(f"SELECT {', '.join(C.P.PREVIEW_FEATURES)} FROM pt ORDER BY SK_ID_CURR LIMIT 10"))
def q_preview_rows(spark, sf_dir):
    return C.P.preview_rows(C.feature_frame(spark, sf_dir, "train"))


# -------------------------------------------------------- a model's whole life
# Two settings of the search space, few rounds: the rule is the same for any list.
FINAL_CANDIDATES = (
    {"n_estimators": 12, "max_depth": 3, "learning_rate": 0.2, "subsample": 1.0, "colsample_bytree": 1.0, "min_child_samples": 20},
    {"n_estimators": 20, "max_depth": 2, "learning_rate": 0.1, "subsample": 1.0, "colsample_bytree": 1.0, "min_child_samples": 20},
)
EARLY_ROUNDS = 40


@C.register("final_scores")
def q_final_scores(spark, sf_dir):
    """Choose, fit on all rows, write, load the written model and score the test frame with it."""
    matrix, plan = C.train_matrix(spark, sf_dir)
    frame, test = C.model_frames(spark, sf_dir)
    model, _, _ = LC.choose_and_fit(frame, C.tuning_sample(matrix), plan, FINAL_CANDIDATES, C.shared_dir(spark, "search"))
    path = LC.save(model, C.shared_dir(spark, f"final-{uuid.uuid4().hex}"))
    return LC.score(LC.load(path), test).select("SK_ID_CURR", F.col("SCORE").alias("TARGET"))


@C.register("early_stopping")
def q_early_stopping(spark, sf_dir):
    """Loss per kept round, on the training and the validation rows; fewer rounds than allowed."""
    matrix, _ = C.train_matrix(spark, sf_dir)
    model = LC.fit_early_stopping(matrix, EARLY_ROUNDS, tolerance=0.001)
    return LC.validation_curve(model, matrix).withColumn("allowed", F.lit(EARLY_ROUNDS))
