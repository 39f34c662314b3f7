"""Linear regression on one-hot categories of any width, its coefficients a stored table.

MLlib's solvers keep several arrays as long as a vector is wide on the driver and in
every task. Here only the numbers' part of the normal equations is on the driver; what
belongs to a category is a row of a table, from the first sum to the prediction.
"""

from __future__ import annotations

from itertools import accumulate, combinations_with_replacement
from math import sqrt

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import (
    HasFeaturesCol,
    HasFitIntercept,
    HasLabelCol,
    HasMaxIter,
    HasPredictionCol,
    HasRegParam,
    HasStandardization,
    HasTol,
)
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pixelframe.storage import discard, materialize

INDEX, COEFFICIENT = "index", "coefficient"


def sparse_field(features: str, field: str) -> Column:
    """``size``, ``indices`` or ``values`` of a sparse vector; other vectors and NULL raise."""
    vector = F.unwrap_udt(F.col(features))
    return F.when(vector["type"] == 0, vector[field]).otherwise(F.raise_error(F.lit(f"{features}: no sparse vector")))


def _block_entries(features: str, begin: int, end: int) -> Column:
    """Indices of entries from ``begin`` on, before ``end``."""
    return F.filter(sparse_field(features, "indices"), lambda i: (i >= begin) & (i < end))


def sparse_value(features: str, index: int) -> Column:
    """The element of a sparse vector at ``index``."""
    place = F.array_position(sparse_field(features, "indices"), F.lit(index)).cast("int") - 1
    return F.coalesce(F.get(sparse_field(features, "values"), place), F.lit(0.0))


def _total(terms) -> Column:
    return sum(terms, F.lit(0.0))


def _sums(df: DataFrame, columns: list[Column]) -> list[float]:
    """Sums over all rows, 0 where there are none."""
    row = df.agg(*(F.sum(c).alias(f"s{i}") for i, c in enumerate(columns))).first() if columns else ()
    return [float(x or 0.0) for x in row]


class _SparseParams(HasFeaturesCol, HasPredictionCol):
    sizes = Param(
        Params._dummy(), "sizes", "widths of the one-hot blocks a vector begins with; numbers follow", TypeConverters.toListInt
    )


class SparseLinearRegression(
    Estimator,
    _SparseParams,
    HasLabelCol,
    HasMaxIter,
    HasTol,
    HasRegParam,
    HasFitIntercept,
    HasStandardization,
    DefaultParamsReadable,
    DefaultParamsWritable,
):
    """Least squares, plain or with an L2 penalty, by conjugate gradients on the normal equations.

    Minimizes what MLlib's ``LinearRegression`` does, in the same standardized columns and
    from 0, so it tends to the same solution where categories and intercept leave several.
    ``tol`` bounds the gradient's length relative to that at the start.

    The equations are made in a few passes over the rows: a row of sums per category, a row per
    pair of categories that meet, and the numbers' products on the driver. An iteration reads
    and writes these tables only.
    """

    @keyword_only
    def __init__(
        self, *, sizes=None, featuresCol=None, labelCol=None, predictionCol=None, maxIter=None, tol=None, regParam=None,
        fitIntercept=None, standardization=None,
    ):
        super().__init__()
        self._setDefault(sizes=[], maxIter=100, tol=1e-6, regParam=0.0, fitIntercept=True, standardization=True)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame) -> SparseLinearModel:
        features, sizes = self.getOrDefault("featuresCol"), self.getOrDefault("sizes")
        first = df.select(sparse_field(features, "size")).first()
        if first is None:
            raise ValueError("no rows to fit")
        wide = sum(sizes)
        numbers = [f"x{i}" for i in range(first[0] - wide)]
        y = F.col(self.getOrDefault("labelCol")).cast("double")
        unfit = y.isNull() | F.isnan(y) | (F.abs(y) == float("inf"))
        rows = df.select(
            _block_entries(features, 0, wide).alias("codes"),
            F.when(unfit, F.raise_error(F.lit("a label is no finite number"))).otherwise(y).alias("y"),
            *(sparse_value(features, wide + i).alias(x) for i, x in enumerate(numbers)),
        )
        return _Equations(self, rows, numbers).solve()


class _Equations:
    """The normal equations of standardized columns, and their solution."""

    def __init__(self, params: SparseLinearRegression, rows: DataFrame, numbers: list[str]):
        self.params = params
        own = ["y", *numbers]
        moments = rows.agg(
            F.count(F.lit(1)).alias("rows"),
            *(F.avg(c).alias(f"mean_{c}") for c in own),
            *(F.stddev_samp(c).alias(f"deviation_{c}") for c in own),
        ).first()
        self.rows = moments["rows"]
        self.centred = params.getOrDefault("fitIntercept")
        self.mean = moments["mean_y"]
        self.means = np.array([moments[f"mean_{c}"] for c in numbers])
        self.deviation = moments["deviation_y"] or 0.0
        deviations = np.array([moments[f"deviation_{c}"] or 0.0 for c in numbers])
        self.constant = not self.deviation and (self.centred or not self.mean)
        if not self.deviation:
            if not self.constant and params.getOrDefault("regParam"):
                raise ValueError("a constant label without intercept cannot be regularized")
            self.deviation = abs(self.mean) or 1.0
        # A column without deviation has no coefficient, as in MLlib.
        self.inverse = np.divide(1.0, deviations, out=np.zeros_like(deviations), where=deviations > 0)
        self.penalty = params.getOrDefault("regParam") / self.deviation
        self.sums = [f"sum_{x}" for x in numbers]
        centred = rows
        if self.centred:  # Sums of centred numbers: large means cost no digits.
            centred = rows.withColumns({c: F.col(c) - F.lit(moments[f"mean_{c}"]) for c in own})
        pairs = list(combinations_with_replacement(range(len(numbers)), 2))
        products = [F.col(numbers[i]) * F.col(numbers[j]) for i, j in pairs]
        found = _sums(centred, [*products, *(F.col(x) * F.col("y") for x in numbers)])
        self.products = np.zeros((len(numbers), len(numbers)))
        for (i, j), value in zip(pairs, found):
            self.products[i, j] = self.products[j, i] = value
        self.residual = np.array(found[len(pairs) :]) * self.inverse / (self.rows * self.deviation)
        self.state = self._categories(centred, numbers)
        self.met = self._pairs(rows) if len(params.getOrDefault("sizes")) > 1 else None

    def _categories(self, centred: DataFrame, numbers: list[str]) -> DataFrame:
        """A row per category: its rows, deviation and sums, and its places in the solver's vectors."""
        entries = centred.select(F.explode("codes").alias(INDEX), "y", *numbers)
        counted = entries.groupBy(INDEX).agg(
            F.count(F.lit(1)).cast("double").alias("n"),
            F.sum("y").alias("sum_y"),
            *(F.sum(x).alias(s) for x, s in zip(numbers, self.sums)),
        )
        # One that all rows have does not deviate, and has no coefficient.
        varying = counted.where(F.col("n") < self.rows)
        deviation = F.sqrt(F.col("n") * (F.lit(1.0) - F.col("n") / self.rows) / (self.rows - 1.0))
        state = varying.withColumn("deviation", deviation).select(
            INDEX,
            "n",
            "deviation",
            *self.sums,
            F.lit(0.0).alias("solution"),
            (F.col("sum_y") / (F.col("deviation") * self.rows * self.deviation)).alias("residual"),
            F.lit(0.0).alias("direction"),
        )
        return materialize(state, "regression-categories")

    def _pairs(self, rows: DataFrame) -> DataFrame:
        """(index, other, met): how many rows have both of two categories."""
        entries = rows.select(F.explode("codes").alias(INDEX), "codes").select(INDEX, F.explode("codes").alias("other"))
        counted = entries.where(F.col(INDEX) != F.col("other")).groupBy(INDEX, "other")
        return materialize(counted.agg(F.count(F.lit(1)).cast("double").alias("met")), "regression-pairs")

    def _replace(self, state: DataFrame, name: str) -> None:
        """Store the next state; the one before is read no more."""
        before, self.state = self.state, materialize(state, name)
        discard(before)

    def _turn(self, share: float) -> None:
        """The next direction, with what the categories that meet a category add to its product."""
        turned = self.state.withColumn("direction", F.col("residual") + F.lit(share) * F.col("direction"))
        if self.met is None:
            self.turned = turned.withColumn("crossed", F.lit(0.0))
            return
        others = turned.select(F.col(INDEX).alias("other"), (F.col("direction") / F.col("deviation")).alias("raw"))
        crossed = self.met.join(others, "other").groupBy(INDEX).agg(F.sum(F.col("met") * F.col("raw")).alias("crossed"))
        self._replace(turned.drop("crossed").join(crossed, INDEX, "left").fillna(0.0, ["crossed"]), "regression-direction")
        self.turned = self.state

    def _gradient(self) -> float:
        """Square of the gradient's length."""
        return _sums(self.state, [F.col("residual") * F.col("residual")])[0] + float(self.residual @ self.residual)

    def solve(self) -> SparseLinearModel:
        """Conjugate gradients, in the order of Hestenes and Stiefel."""
        params, rows, evenly = self.params, float(self.rows), self.params.getOrDefault("standardization")
        solution, direction = np.zeros_like(self.residual), np.zeros_like(self.residual)
        start = square = self._gradient()
        share, history = 0.0, [1.0]
        for _ in range(0 if self.constant or not start else params.getOrDefault("maxIter")):
            self._turn(share)
            direction = self.residual + share * direction
            column, n, crossed, deviation = (F.col(c) for c in ("direction", "n", "crossed", "deviation"))
            raw, raw_numbers = column / deviation, direction * self.inverse
            penalized = column * column if evenly else raw * raw
            found = _sums(self.turned, [n * raw, raw * (n * raw + crossed), penalized, *(F.col(s) * raw for s in self.sums)])
            (counts, square_sum, penalty_sum), by_number = found[:3], np.array(found[3:])
            # A column's mean is its share of the rows; numbers are centred already.
            mean = counts / rows if self.centred else 0.0
            of_numbers = (self.products @ raw_numbers + by_number) / rows
            penalized_numbers = direction if evenly else raw_numbers * self.inverse
            curvature = (square_sum + by_number @ raw_numbers - mean * counts) / rows + of_numbers @ raw_numbers
            curvature += self.penalty * (penalty_sum + penalized_numbers @ direction)
            if not curvature > 0:
                break
            step = square / float(curvature)
            met_numbers = _total(F.col(s) * F.lit(float(v)) for s, v in zip(self.sums, raw_numbers))
            product = (n * (raw - F.lit(mean)) + met_numbers + crossed) / F.lit(rows) / deviation
            product += F.lit(self.penalty) * (column if evenly else raw / deviation)
            moved = self.turned.withColumns(
                {
                    "solution": F.col("solution") + F.lit(step) * column,
                    "residual": F.col("residual") - F.lit(step) * product,
                }
            )
            self._replace(moved.drop("crossed"), "regression-state")
            solution = solution + step * direction
            self.residual = self.residual - step * (of_numbers * self.inverse + self.penalty * penalized_numbers)
            before, square = square, self._gradient()
            share = square / before
            history.append(sqrt(square / start))
            if history[-1] <= params.getOrDefault("tol"):
                break
        coefficient = F.col("solution") * F.lit(self.deviation) / F.col("deviation")
        of_numbers = solution * self.deviation * self.inverse
        counts = _sums(self.state, [coefficient * F.col("n")])[0] / rows
        table = materialize(self.state.select(INDEX, coefficient.alias(COEFFICIENT)), "regression-coefficients")
        for df in (self.state, self.met):
            if df is not None:
                discard(df)
        model = SparseLinearModel(table, history)
        params._copyValues(model)
        intercept = self.mean - float(of_numbers @ self.means) - counts if self.centred else 0.0
        return model._set(intercept=intercept, numeric=[float(v) for v in of_numbers])


class SparseLinearModel(Model, _SparseParams, MLReadable, MLWritable):
    """A line whose one-hot coefficients are a table (index, coefficient); those it lacks are 0.

    ``history`` has the gradient's relative length after each iteration; it is not saved.
    """

    intercept = Param(Params._dummy(), "intercept", "prediction where all features are 0", TypeConverters.toFloat)
    numeric = Param(Params._dummy(), "numeric", "coefficients of the numbers", TypeConverters.toListFloat)

    def __init__(self, coefficients: DataFrame | None = None, history: list[float] = ()):
        super().__init__()
        self._setDefault(sizes=[], intercept=0.0, numeric=[])
        self.coefficients = coefficients
        self.history = list(history)

    def _transform(self, df: DataFrame) -> DataFrame:
        features, sizes = self.getOrDefault("featuresCol"), self.getOrDefault("sizes")
        numbers = enumerate(self.getOrDefault("numeric"), sum(sizes))
        line = F.lit(self.getOrDefault("intercept")) + _total(F.lit(c) * sparse_value(features, i) for i, c in numbers)
        output = self.getOrDefault("predictionCol")
        df = df.withColumn(output, line)
        for size, end in zip(sizes, accumulate(sizes)):
            own = (F.col(INDEX) >= end - size) & (F.col(INDEX) < end)
            table = self.coefficients.where(own).select(F.col(INDEX).alias("__index"), F.col(COEFFICIENT).alias("__part"))
            entry = F.get(_block_entries(features, end - size, end), F.lit(0))
            df = df.withColumn("__index", entry).join(table, "__index", "left")
            df = df.withColumn(output, F.col(output) + F.coalesce("__part", F.lit(0.0))).drop("__index", "__part")
        return df

    def write(self) -> MLWriter:
        return _LineWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _LineReader()


def _table_path(path: str) -> str:
    return f"{path.rstrip('/')}/coefficients"


class _LineWriter(MLWriter):
    def __init__(self, model: SparseLinearModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.model.coefficients.write.parquet(_table_path(path))


class _LineReader(MLReader):
    def load(self, path: str) -> SparseLinearModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = SparseLinearModel()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        model.coefficients = self.sparkSession.read.parquet(_table_path(path))
        return model
