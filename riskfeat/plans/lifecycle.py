"""A model's life: chosen by cross-validation, fitted, written, loaded, scored.

The written model is a whole ``PipelineModel``: the fills and indicators of the
matrix plan are a SQL stage in front of the assembler and the classifier, so a
later session scores a processed frame with nothing but the folder.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import imbalance as IMB
from . import modeling as ML


def _text(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _name(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


def matrix_stages(plan: ML.MatrixPlan) -> list:
    """The matrix preparation as two ML stages; they add columns and keep all others."""
    parts = []
    for c in plan.numeric:
        x = f"CAST({_name(c)} AS DOUBLE)"
        parts.append(f"COALESCE(CASE WHEN ABS({x}) < DOUBLE('Infinity') THEN {x} END, {float(plan.medians.get(c, 0.0))!r}D)")
    for c, values in plan.onehot.categories.items():
        parts += [f"CASE WHEN {_name(c)} = {_text(v)} THEN 1.0D ELSE 0.0D END" for v in (values[1:] if plan.onehot.drop_first else values)]
    names = [f"_f{i}" for i in range(len(parts))]
    sql = SQLTransformer(statement="SELECT *, " + ", ".join(f"{p} AS {n}" for p, n in zip(parts, names)) + " FROM __THIS__")
    return [sql, VectorAssembler(inputCols=names, outputCol="features", handleInvalid="error")]


def fit_pipeline(frame: DataFrame, plan: ML.MatrixPlan, make: Callable[[int], object], weighted: bool = False) -> PipelineModel:
    """Fit on all rows of a processed training frame."""
    n = frame.count()
    train = ML.for_learning(frame, n).withColumn(ML.LABEL, F.col(ML.LABEL).cast("double"))
    if weighted:
        train = IMB.with_weights(train, ML.LABEL, "_w")
    est = ML._configure(make(n), ML.LABEL, "_w" if weighted else None)
    return Pipeline(stages=[*matrix_stages(plan), est]).fit(train)


def save(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score(model: PipelineModel, frame: DataFrame, key: str = ML.KEY) -> DataFrame:
    """``(key, SCORE)`` of a processed frame, with or without the label."""
    return model.transform(frame).select(key, vector_to_array("probability")[1].alias("SCORE"))


def choose_and_fit(frame: DataFrame, matrix: DataFrame, plan: ML.MatrixPlan, candidates: Sequence[dict],
                   ledger_root: str | None = None, parallelism: int = 9) -> tuple[PipelineModel, dict, bool]:
    """The best candidate by mean AUC, with class weights only if they did better than none.

    ``matrix`` carries the folds (a bounded sample, as in the search); the final
    fit takes every row of ``frame``. Returns the model, its setting and whether
    it is weighted.
    """
    arms = [(f"candidate_{i}", ML.params_to_gbt(p), ML.resample_none, False, p) for i, p in enumerate(candidates)]
    ledger = ML.search_ledger(matrix, candidates, 3, ledger_root) if ledger_root else None
    found = ML.run_grid(matrix, arms, 3, parallelism, ledger)
    best = max(found, key=lambda c: (c.mean, c.name))
    make = ML.params_to_gbt(best.params)
    make, weighted = ML.choose_final(found, ML.imbalance_arms(matrix, make, ("baseline", "class_weights"), 3, parallelism))
    return fit_pipeline(frame, plan, make, weighted), best.params, weighted


# ------------------------------------------------------------ early stopping
def split_validation(matrix: DataFrame, percent: int = 20) -> DataFrame:
    """Adds ``_valid``: the share of rows, by a seeded hash of the key, that only judges."""
    return matrix.withColumn("_valid", F.pmod(F.xxhash64(ML.KEY, F.lit(ML.SEED)), F.lit(100)) < percent)


def fit_early_stopping(matrix: DataFrame, rounds: int, depth: int = 3, learning_rate: float = 0.1, percent: int = 20,
                       tolerance: float = 0.01):
    """A boosted model that stops when a round no longer helps on the validation rows.

    A round counts if it lowers the validation loss by more than ``tolerance``
    times the loss (0.01 at least); the model keeps the rounds up to the best.
    """
    rows = split_validation(matrix, percent)
    est = ML._configure(ML.gbt(rounds, depth, learning_rate), ML.LABEL, None)
    est.setValidationIndicatorCol("_valid")
    est.set(est.validationTol, float(tolerance))
    return est.fit(rows)


def validation_curve(model, matrix: DataFrame, percent: int = 20) -> DataFrame:
    """``(round, train_loss, validation_loss)`` of every round the model kept."""
    rows = split_validation(matrix, percent)
    sides = [model.evaluateEachIteration(rows.where(cond)) for cond in (~F.col("_valid"), F.col("_valid"))]
    table = [(i + 1, float(a), float(b)) for i, (a, b) in enumerate(zip(*sides))]
    return matrix.sparkSession.createDataFrame(table, "round int, train_loss double, validation_loss double")
