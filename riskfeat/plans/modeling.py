"""Model training, validation and tuning as Spark ML jobs.

The feature frame becomes ``(key, label, features, fold)``: string columns
one-hot encoded with train categories, NaN/inf set to null and filled with
exact train medians, then assembled. Cross-validation is an explicit loop
over folds so resampling (weights, undersampling, SMOTE) touches only the
training part of each fold. Each fit is a distributed Spark ML job; fits of
different folds/candidates can run concurrently from a small driver pool.
AUC is the exact rank statistic from ``evaluate.roc_auc``.
"""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor, as_completed
from dataclasses import dataclass, field
from functools import partial

from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import boost as B
from ..operators import encode as E
from ..operators import evaluate as V
from ..operators import imbalance as IMB
from ..operators import quantiles
from ..operators import ranks as R
from ..operators import smote as SM
from ..session import checkpoint
from . import search

KEY, LABEL = "SK_ID_CURR", "TARGET"
SEED = 42
ROWS_PER_TASK = 10_000  # a learner's partitions hold this many rows at least


# ------------------------------------------------------------------ matrix
@dataclass(frozen=True)
class MatrixPlan:
    onehot: E.OneHotPlan
    numeric: tuple[str, ...]
    medians: dict[str, float]
    features: tuple[str, ...]


def fit_matrix(df: DataFrame, key: str = KEY, label: str = LABEL, exclude_prefixes: Sequence[str] = ()) -> MatrixPlan:
    """Learn categories and fill medians from the training frame."""
    skip = {key, label}

    def keep(c: str) -> bool:
        return c not in skip and not any(c.startswith(p) for p in exclude_prefixes)

    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and keep(f.name)]
    numeric = [f.name for f in df.schema.fields
               if isinstance(f.dataType, (T.NumericType, T.BooleanType)) and keep(f.name)]
    oh = E.fit_one_hot(df, strings)
    clean = E.nonfinite_to_null(df.select(*numeric), numeric)
    med = quantiles.exact_medians(clean, numeric)
    medians = {c: (v if v is not None else 0.0) for c, v in med.items()}
    return MatrixPlan(oh, tuple(numeric), medians, tuple(numeric) + tuple(oh.indicator_names()))


def to_matrix(df: DataFrame, plan: MatrixPlan, key: str = KEY, label: str = LABEL,
              extra: Sequence[str] = ()) -> DataFrame:
    """``(key, [label], *extra, features)``; one projection + assembler."""
    num = [
        F.coalesce(
            F.when(F.isnan(F.col(c).cast("double")) | (F.abs(F.col(c).cast("double")) == float("inf")), None)
            .otherwise(F.col(c).cast("double")),
            F.lit(float(plan.medians.get(c, 0.0))),
        ).alias(c)
        for c in plan.numeric
    ]
    ind = [c.cast("double") for c in E.one_hot_columns(plan.onehot)]
    head = [key] + ([F.col(label).cast("double").alias(label)] if label in df.columns else []) + list(extra)
    wide = df.select(*head, *num, *ind)
    assembled = VectorAssembler(inputCols=list(plan.features), outputCol="features", handleInvalid="error").transform(wide)
    keep = [key] + ([label] if label in df.columns else []) + [c if isinstance(c, str) else c for c in extra]
    return assembled.select(*keep, "features")


# ------------------------------------------------------------------ models
def _n(df: DataFrame) -> int:
    return df.count()


def model_zoo() -> dict[str, Callable[[int], object]]:
    """Model arms of the reference (sklearn ``C`` mapped to ``regParam=1/(C n)``)."""
    return {
        "simple_tree": lambda n: DecisionTreeClassifier(maxDepth=3, minInstancesPerNode=50, seed=SEED),
        "logreg_l2_c1": lambda n: LogisticRegression(regParam=1.0 / (1.0 * n), elasticNetParam=0.0,
                                                     standardization=False, maxIter=1000),
        "logreg_l1_c0.1": lambda n: LogisticRegression(regParam=1.0 / (0.1 * n), elasticNetParam=1.0,
                                                       standardization=False, maxIter=1000),
        "logreg_l2_c0.01": lambda n: LogisticRegression(regParam=1.0 / (0.01 * n), elasticNetParam=0.0,
                                                        standardization=False, maxIter=1000),
        "random_forest": lambda n: RandomForestClassifier(numTrees=100, maxDepth=10, minInstancesPerNode=50, seed=SEED),
        "boosted_d7": lambda n: gbt(100, 7, 0.1, 0.8, 0.8),
        "boosted_d6": lambda n: gbt(100, 6, 0.1, 0.8, 0.8),
    }


def plain_boosting(n: int):
    """Fixed setting of the imbalance arms and the ablation: depth 7, no subsampling."""
    return gbt(100, 7, 0.1)


def gbt(rounds: int, depth: int, lr: float, subsample: float = 1.0, colsample: float = 1.0,
        min_child: int = 1) -> GBTClassifier:
    return GBTClassifier(
        maxIter=int(rounds), maxDepth=int(min(depth, 30)), stepSize=float(lr),
        subsamplingRate=float(subsample), featureSubsetStrategy=str(float(colsample)) if colsample < 1 else "all",
        minInstancesPerNode=int(min_child), checkpointInterval=10, seed=SEED,
    )


def _configure(est, label: str, weight: str | None):
    est = est.copy()
    est.setLabelCol(label)
    est.setFeaturesCol("features")
    if weight is not None:
        est.setWeightCol(weight)
    return est


def score(model, df: DataFrame, key: str = KEY, label: str = LABEL) -> DataFrame:
    """``(key, [label], SCORE)`` with SCORE = P(class 1)."""
    cols = [key] + ([label] if label in df.columns else [])
    if isinstance(model, B.Model):
        return model.score(df, cols)
    return model.transform(df).select(*cols, vector_to_array("probability")[1].alias("SCORE"))


def fit_learner(est, train: DataFrame, n: int):
    """``est`` fitted on the ``n`` rows of ``train``; boosting of few rows by one task, as MLlib does it to rounding."""
    settings = B.settings_of(est) if n <= B.MAX_ROWS else None
    if settings is None or n * vector_width(train) > B.MAX_CELLS:
        return est.fit(train)
    return B.fit(train, settings, est.getLabelCol(), est.getWeightCol() if est.isDefined("weightCol") else None)


def vector_width(df: DataFrame, features: str = "features") -> int:
    """Entries of the feature vector, from the assembler's note or else from a row."""
    known = df.schema[features].metadata.get("ml_attr", {}).get("num_attrs")
    row = None if known else df.select(F.size(vector_to_array(features)).alias("n")).first()
    return known or (row["n"] if row else 0)


def for_learning(df: DataFrame, n: int | None = None) -> DataFrame:
    """The same rows in the partitions a learner can use: one per core at most, fewer for a few rows.

    A tree learner shuffles the counts of all features, bins and nodes of every
    partition in every round, whatever rows that holds, and a round of a small
    sample is mostly the start of its tasks. ``n`` spares the count.
    """
    rows = _n(df) if n is None else n
    return df.coalesce(max(1, min(df.sparkSession.sparkContext.defaultParallelism, -(-rows // ROWS_PER_TASK))))


def auc_of(scored: DataFrame, label: str = LABEL) -> float:
    auc = V.roc_auc(scored, label, "SCORE").first()["auc"]
    return math.nan if auc is None else float(auc)  # a fold of one class has none


# ------------------------------------------------------------ resampling
Resampler = Callable[[DataFrame], DataFrame]


def resample_none(df: DataFrame) -> DataFrame:
    return df


def resample_undersample(df: DataFrame) -> DataFrame:
    return R.undersample(df, LABEL, KEY, SEED)


def resample_smote(df: DataFrame) -> DataFrame:
    return SM.smote(df, LABEL, KEY, "features", 5, SEED)


ARMS: dict[str, tuple[Resampler, bool]] = {
    "baseline": (resample_none, False),
    "smote": (resample_smote, False),
    "class_weights": (resample_none, True),
    "undersample": (resample_undersample, False),
}


# ------------------------------------------------------- cross-validation
@dataclass
class CVResult:
    name: str
    fold_aucs: list[float]
    params: dict = field(default_factory=dict)

    @property
    def mean(self) -> float:
        known = [a for a in self.fold_aucs if not math.isnan(a)]
        return sum(known) / len(known) if known else math.nan

    @property
    def std(self) -> float:  # population std, like numpy
        m, known = self.mean, [a for a in self.fold_aucs if not math.isnan(a)]
        return math.sqrt(sum((a - m) ** 2 for a in known) / len(known)) if known else math.nan


def with_folds(matrix: DataFrame, k: int = 3, seed: int = SEED) -> DataFrame:
    return R.stratified_folds(matrix, LABEL, KEY, k, seed)


def fit_fold(matrix: DataFrame, fold: int, make: Callable[[int], object], resample: Resampler = resample_none,
             weighted: bool = False, n_train: int | None = None, one_task: bool = False) -> float:
    """``n_train`` spares the count of a training part that is not resampled; ``one_task``: see ``run_grid``."""
    train = matrix.where(F.col("fold") != fold).drop("fold")
    valid = matrix.where(F.col("fold") == fold).drop("fold")
    if resample is not resample_none:  # a learner reads its rows many times
        train = checkpoint(resample(train))
        n_train = _n(train)
        train = for_learning(train, n_train)
    weight = None
    if weighted:
        train = IMB.with_weights(train, LABEL, "w")
        weight = "w"
    n = _n(train) if n_train is None else n_train
    est = _configure(make(n), LABEL, weight)
    model = fit_learner(est, train, n) if one_task else est.fit(train)
    return auc_of(score(model, valid))


def training_sizes(matrix: DataFrame, k: int) -> list[int]:
    """Rows outside each fold, from one count."""
    sizes = {r["fold"]: r["n"] for r in matrix.groupBy("fold").agg(F.count(F.lit(1)).alias("n")).collect()}
    return [sum(sizes.values()) - sizes.get(f, 0) for f in range(k)]


def cross_validate(matrix: DataFrame, make: Callable[[int], object], k: int = 3, resample: Resampler = resample_none,
                   weighted: bool = False, name: str = "", parallelism: int = 3, params: dict | None = None) -> CVResult:
    """Per-fold exact AUC; folds are fitted concurrently (``parallelism``)."""
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        aucs = list(pool.map(lambda f: fit_fold(matrix, f, make, resample, weighted), range(k)))
    return CVResult(name, aucs, params or {})


def results_frame(spark, results: Sequence[CVResult], baseline: float | None = None) -> DataFrame:
    rows = [(r.name, [float(a) for a in r.fold_aucs], float(r.mean), float(r.std),
             float(r.mean - baseline) if baseline is not None else None, str(r.params) if r.params else None)
            for r in results]
    return spark.createDataFrame(rows, "model string, fold_aucs array<double>, mean_auc double, std_auc double, "
                                       "delta_vs_baseline double, params string")


def majority_result(matrix: DataFrame) -> CVResult:
    return CVResult("majority_class", [0.5, 0.5, 0.5])


def run_grid(matrix: DataFrame, arms: Sequence[tuple[str, Callable[[int], object], Resampler, bool, dict]],
             k: int = 3, parallelism: int = 6, ledger: search.Ledger | None = None, one_task: bool = False) -> list[CVResult]:
    """All (arm, fold) fits through one driver pool of ``parallelism`` jobs.

    With a ``ledger``, fits found there are not made again and each fit is
    recorded when it ends; after an error no further fit starts. ``one_task``
    lets a task of its own make a boosted fit of few rows (``fit_learner``):
    equal to MLlib's up to rounding, which may decide between equal gains.
    """
    aucs: dict[tuple[int, int], float] = ledger.finished() if ledger else {}
    jobs = [(i, f) for i in range(len(arms)) for f in range(k) if (i, f) not in aucs]
    sizes = training_sizes(matrix, k) if jobs else []
    fit = partial(fit_fold, one_task=True) if one_task else fit_fold

    def one(i: int, fold: int) -> None:
        _, make, res, weighted, params = arms[i]
        auc = fit(matrix, fold, make, res, weighted, sizes[fold])
        if ledger:
            ledger.record(i, fold, auc, params)
        aucs[i, fold] = auc

    pool = ThreadPoolExecutor(max_workers=max(1, parallelism))
    try:
        for done in as_completed([pool.submit(one, *j) for j in jobs]):
            done.result()
    finally:
        pool.shutdown(cancel_futures=True)
    return [CVResult(a[0], [aucs[i, f] for f in range(k)], a[4]) for i, a in enumerate(arms)]


def compare_models(matrix: DataFrame, names: Sequence[str] | None = None, k: int = 3,
                   parallelism: int = 6) -> list[CVResult]:
    zoo = model_zoo()
    names = list(names or zoo)
    arms = [(n, zoo[n], resample_none, False, {}) for n in names]
    return [majority_result(matrix)] + run_grid(matrix, arms, k, parallelism)


def imbalance_arms(matrix: DataFrame, make: Callable[[int], object], arms: Sequence[str] = tuple(ARMS), k: int = 3,
                   parallelism: int = 6, one_task: bool = False) -> list[CVResult]:
    spec = [(a, make, ARMS[a][0], ARMS[a][1], {}) for a in arms]
    return run_grid(matrix, spec, k, parallelism, one_task=one_task)


# ------------------------------------------------------------ random search
# Reference search space (fixed values): (kind, a, b) with randint(a, b) drawing
# a <= x < b and uniform(a, b) drawing a <= x < a + b.
SEARCH_SPACE = {
    "n_estimators": ("randint", 100, 500),
    "max_depth": ("randint", 3, 10),
    "learning_rate": ("uniform", 0.01, 0.2),
    "num_leaves": ("randint", 20, 100),
    "min_child_samples": ("randint", 10, 50),
    "subsample": ("uniform", 0.6, 0.4),
    "colsample_bytree": ("uniform", 0.6, 0.4),
    "reg_alpha": ("uniform", 0.0, 1.0),
    "reg_lambda": ("uniform", 0.0, 1.0),
}


def draw_params(n_iter: int, seed: int = SEED, space: dict = SEARCH_SPACE) -> list[dict]:
    rng = random.Random(seed)
    out = []
    for _ in range(n_iter):
        p = {}
        for name, (kind, a, b) in space.items():
            p[name] = rng.randrange(a, b) if kind == "randint" else a + b * rng.random()
        out.append(p)
    return out


def params_to_gbt(p: dict) -> Callable[[int], object]:
    # num_leaves, reg_alpha and reg_lambda have no MLlib counterpart (kept in the report)
    return lambda n: gbt(p["n_estimators"], p["max_depth"], p["learning_rate"], p["subsample"],
                         p["colsample_bytree"], p["min_child_samples"])


def random_search(matrix: DataFrame, n_iter: int = 20, k: int = 3, seed: int = SEED,
                  space: dict = SEARCH_SPACE, parallelism: int = 4, ledger_root: str | None = None,
                  make_of: Callable[[dict], Callable[[int], object]] = params_to_gbt) -> list[CVResult]:
    """Seeded draws; each candidate scored by k-fold CV. Candidates and their
    folds are fitted concurrently (``parallelism`` Spark jobs at a time). With
    a ``ledger_root`` (a shared folder) a stopped search goes on where it was."""
    cands = draw_params(n_iter, seed, space)
    arms = [(f"candidate_{i}", make_of(p), resample_none, False, p) for i, p in enumerate(cands)]
    ledger = None
    if ledger_root:
        ledger = search_ledger(matrix, cands, k, ledger_root)
    return run_grid(matrix, arms, k, parallelism, ledger, one_task=True)


def search_ledger(matrix: DataFrame, cands: Sequence[dict], k: int, root: str) -> search.Ledger:
    """The ledger of these draws and folds on this data."""
    name = search.fingerprint(cands, k, search.data_signature(matrix, KEY, LABEL))
    return search.Ledger(matrix.sparkSession, root, name)


def ranked_candidates(spark, results: Sequence[CVResult]) -> DataFrame:
    """``rank_test_score`` style competition rank (1 = best mean AUC)."""
    from pyspark.sql import Window

    df = results_frame(spark, results)
    return df.withColumn("rank", F.rank().over(Window.orderBy(F.col("mean_auc").desc())))


# ------------------------------------------------------------ final model
def choose_final(candidates: Sequence[CVResult], arms: Sequence[CVResult]) -> tuple[Callable[[int], object], bool]:
    """Learner of the best candidate, and whether to weight classes: only if
    the weighted arm did better than the plain one."""
    best = max(candidates, key=lambda c: (c.mean, c.name))
    mean = {a.name: a.mean for a in arms}
    return params_to_gbt(best.params), mean["class_weights"] > mean["baseline"]


def fit_final(matrix: DataFrame, make: Callable[[int], object], weighted: bool = False,
              early_stopping_pct: int = 0):
    """Fit on all rows. ``early_stopping_pct`` > 0 holds out that share (by a
    seeded key hash) as the validation set of a boosted model, which then
    stops when the validation error stops improving."""
    train = matrix.drop("fold") if "fold" in matrix.columns else matrix
    weight = None
    if weighted:
        train = IMB.with_weights(train, LABEL, "w")
        weight = "w"
    est = _configure(make(_n(train)), LABEL, weight)
    if early_stopping_pct and isinstance(est, GBTClassifier):
        train = train.withColumn("_valid", F.pmod(F.xxhash64(KEY, F.lit(SEED)), F.lit(100)) < early_stopping_pct)
        est.setValidationIndicatorCol("_valid")
    return est.fit(train)


def importance_frame(spark, model, features: Sequence[str]) -> DataFrame:
    imp = model.featureImportances.toArray().tolist()
    return spark.createDataFrame([(f, float(v)) for f, v in zip(features, imp)], "feature string, importance double")
