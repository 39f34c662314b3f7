"""Models, predictions, scores and tuning on Spark MLlib."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from itertools import takewhile

from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import (
    Evaluator,
    MulticlassClassificationEvaluator,
    RegressionEvaluator,
)
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pixelframe.functions.hashing import key_fraction
from pixelframe.operators.regression import SparseLinearRegression
from pixelframe.operators.sampling import SEED
from pixelframe.storage import materialize

MAX_TREE_DEPTH = 30
FOLD = "fold"

# Fixed value: up to here MLlib solves normal equations; its other solvers hold as many numbers in every task.
DRIVER_WIDTH = 4096
# Settings of MLlib's solvers that do not change what least squares without an L1 penalty minimize.
LIBRARY_ONLY = ("aggregationDepth", "elasticNetParam", "epsilon", "loss", "maxBlockSizeInMB", "solver")

# The search grid; depths above MLlib's limit are left to the caller.
FOREST_GRID = {
    "numTrees": (10, 50, 100, 150, 200, 300),
    "maxDepth": (4, 16),
    "minInstancesPerNode": (2, 8, 16, 32),
}


def forest(label: str = "label", features: str = "features", seed: int = SEED, **params):
    """Random-forest classifier with MLlib's defaults, seeded."""
    return RandomForestClassifier(labelCol=label, featuresCol=features, seed=seed, **params)


def linear_regression(
    label: str, features: str = "features", one_hot: Sequence[int] = (), **params
) -> LinearRegression | SparseLinearRegression:
    """MLlib's linear regression, or one of any width for vectors that begin with wide one-hot blocks.

    ``one_hot`` are the widths of these blocks. Above ``DRIVER_WIDTH`` in all, least squares
    without an L1 penalty keep their coefficients in a table. What only MLlib's solvers
    can do, the Huber loss, an L1 penalty or a solver by name, stays with them at any width.
    """
    lasso = params.get("regParam", 0.0) * params.get("elasticNetParam", 0.0)
    by_name = params.get("loss", "squaredError") != "squaredError" or params.get("solver", "auto") != "auto"
    if sum(one_hot) <= DRIVER_WIDTH or lasso or by_name or "weightCol" in params:
        return LinearRegression(labelCol=label, featuresCol=features, **params)
    own = {k: v for k, v in params.items() if k not in LIBRARY_ONLY}
    return SparseLinearRegression(labelCol=label, featuresCol=features, sizes=list(one_hot), **own)


def fit(stages: Sequence, train: DataFrame) -> PipelineModel:
    return Pipeline(stages=list(stages)).fit(train)


def predict(
    model: PipelineModel, df: DataFrame, columns: Sequence[str] = ("label", "prediction")
) -> DataFrame:
    return model.transform(df).select(*columns)


def accuracy_of(label: str = "label", prediction: str = "prediction") -> Column:
    """Share of equal pairs, as an aggregate."""
    return F.avg((F.col(label) == F.col(prediction)).cast("double"))


def rmse_of(label: str, prediction: str = "prediction") -> Column:
    """Root of the mean squared error, as an aggregate."""
    error = F.col(prediction) - F.col(label)
    return F.sqrt(F.avg(error * error))


def accuracy_by(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy per group in one pass, so train and test need no separate scan."""
    return df.groupBy(*by).agg(
        accuracy_of().alias("accuracy"), F.count(F.lit(1)).alias("rows")
    )


def accuracy_evaluator(label: str = "label") -> MulticlassClassificationEvaluator:
    return MulticlassClassificationEvaluator(
        labelCol=label, predictionCol="prediction", metricName="accuracy"
    )


def rmse_evaluator(label: str) -> RegressionEvaluator:
    return RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName="rmse")


def check_grid(grid: Mapping[str, Sequence]) -> None:
    too_deep = [d for d in grid.get("maxDepth", ()) if d > MAX_TREE_DEPTH]
    if too_deep:
        raise ValueError(f"maxDepth {too_deep} is above {MAX_TREE_DEPTH}")


def with_folds(df: DataFrame, group: str, folds: int, salt: str = "") -> DataFrame:
    """Adds ``fold``, from 0, by a hash of the group: rows of a group share it, however they are partitioned."""
    return df.withColumn(FOLD, F.floor(key_fraction(group, salt) * folds).cast("int"))


def grouped_accuracy(
    vectors: DataFrame, classifier: RandomForestClassifier, group: str, folds: int = 3, salt: str = ""
) -> DataFrame:
    """(fold, accuracy, rows): each fold scored by a model trained on the others, all in one pass.

    ``vectors`` are stored with their folds once.
    """
    stored = materialize(with_folds(vectors, group, folds, salt), "fold-vectors")
    scored: DataFrame | None = None
    for fold in range(folds):
        model = classifier.fit(stored.where(F.col(FOLD) != fold))
        own = model.transform(stored.where(F.col(FOLD) == fold)).select(FOLD, "label", "prediction")
        scored = own if scored is None else scored.unionByName(own)
    return accuracy_by(scored, [FOLD])


@dataclass
class TunedForest:
    """The best model with all its stages, and the search that found it."""

    model: PipelineModel
    search: CrossValidatorModel


def tune_forest(
    train: DataFrame,
    stages: Sequence,
    classifier: RandomForestClassifier,
    evaluator: Evaluator,
    grid: Mapping[str, Sequence] = FOREST_GRID,
    folds: int = 3,
    parallelism: int = 1,
    seed: int = SEED,
    group: str | None = None,
) -> TunedForest:
    """Grid search by k-fold cross-validation over ``stages`` and the classifier.

    With ``group``, a column that the stages carry along, all rows of a group are
    in one fold, so that pixels of a patch never score a model trained on others of it.

    The stages that learn nothing from the data run once and their output is
    stored, so that no fold or grid point decodes or computes features again.
    """
    check_grid(grid)
    fixed = list(takewhile(lambda stage: isinstance(stage, Transformer), stages))
    ready = PipelineModel(fixed).transform(train)
    prepared = materialize(with_folds(ready, group, folds) if group else ready, "tuning")
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(classifier.getParam(name), list(values))
    search = CrossValidator(
        estimator=Pipeline(stages=[*stages[len(fixed) :], classifier]),
        estimatorParamMaps=builder.build(),
        evaluator=evaluator,
        numFolds=folds,
        parallelism=parallelism,
        seed=seed,
        foldCol=FOLD if group else "",
    ).fit(prepared)
    return TunedForest(PipelineModel([*fixed, *search.bestModel.stages]), search)
