"""Linear regression whose coefficients are a table, beside MLlib's on the same vectors."""

import os

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.linalg import DenseVector, SparseVector
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from pixelframe.operators import categories, models
from pixelframe.operators.regression import SparseLinearModel, SparseLinearRegression
from pixelframe.plans import jobs


def mixed_rows(spark):
    """Two text columns, one with NULLs, two numbers, of which one is far from 0, and a label with noise."""
    noise = F.conv(F.substring(F.md5(F.col("id").cast("string")), 1, 6), 16, 10).cast("double") / 2**24
    return spark.range(600).select(
        F.concat(F.lit("a"), (F.col("id") % 37).cast("string")).alias("a"),
        F.when(F.col("id") % 5 != 0, F.concat(F.lit("b"), (F.col("id") * 7 % 11).cast("string"))).alias("b"),
        (F.col("id") % 17).cast("double").alias("m"),
        (F.col("id") * 31 % 101 + 10_000).cast("double").alias("n"),
        (F.col("id") % 37 + 2.0 * (F.col("id") * 7 % 11) + 0.5 * (F.col("id") % 17) + 10 * noise).alias("y"),
    )


def vectors_of(spark, rows, text, numbers):
    index = categories.CategoryIndexer(inputCols=text).fit(rows)
    stages = PipelineModel([index, categories.sparse_assembler(index, rows, numbers)])
    other = [("new", "b1", 3.0, 10_050.0, 0.0), ("a1", "new", 1.0, 10_001.0, 0.0), (None, None, 0.0, 0.0, 0.0)]
    unseen = spark.createDataFrame(other, "a string, b string, m double, n double, y double")
    return index.getOrDefault("known"), stages.transform(rows), stages.transform(rows.unionByName(unseen))


def predictions(model, df):
    return [r[-1] for r in sorted(model.transform(df).select("a", "b", "m", "n", "y", "prediction").collect(), key=str)]


@pytest.mark.parametrize(
    "text, numbers, params",
    [
        (["a"], ["m"], {}),
        (["a", "b"], ["m", "n"], {}),
        (["a", "b"], ["n"], {"regParam": 0.3, "standardization": False}),
        (["b"], [], {"regParam": 0.1, "fitIntercept": False}),
    ],
)
def test_the_solution_of_the_library(spark, text, numbers, params):
    """Also for unseen values, whose prediction depends on which of several solutions is taken."""
    sizes, train, every = vectors_of(spark, mixed_rows(spark), text, numbers)
    exact = {"labelCol": "y", "tol": 1e-10, "maxIter": 500}
    library = LinearRegression(solver="l-bfgs", **exact, **params).fit(train)
    own = SparseLinearRegression(sizes=sizes, **exact, **params).fit(train)
    assert own.history[-1] <= 1e-10
    assert predictions(own, every) == pytest.approx(predictions(library, every), rel=1e-4, abs=1e-4)
    assert own.getOrDefault("intercept") == pytest.approx(library.intercept, rel=1e-4, abs=1e-4)
    expected = library.coefficients.toArray()
    assert own.getOrDefault("numeric") == pytest.approx(list(expected[sum(sizes) :]), rel=1e-4, abs=1e-5)
    got = {r["index"]: r["coefficient"] for r in own.coefficients.collect()}
    assert [got.get(i, 0.0) for i in range(sum(sizes))] == pytest.approx(list(expected[: sum(sizes)]), rel=1e-4, abs=1e-4)


def test_constant_labels_and_columns(spark):
    rows = mixed_rows(spark)
    rows = rows.withColumns({"y": F.lit(4.0), "b": F.lit("one"), "m": F.lit(2.0)})
    sizes, train, _ = vectors_of(spark, rows, ["a", "b"], ["m", "n"])
    flat = SparseLinearRegression(sizes=sizes, labelCol="y").fit(train)
    assert {r.prediction for r in flat.transform(train).collect()} == {4.0}
    sloped = train.withColumn("y", F.col("n") * 3.0)
    line = SparseLinearRegression(sizes=sizes, labelCol="y", tol=1e-12).fit(sloped)
    error = F.max(F.abs(F.col("prediction") - F.col("y")))
    assert line.transform(sloped).agg(error).first()[0] < 1e-6
    assert line.getOrDefault("numeric")[0] == 0.0


def test_vectors_wider_than_memory(spark, tmp_path):
    """A billion categories, of which few occur: nothing is as long as a vector is wide."""
    width = 2**30
    data = [(SparseVector(width + 1, [i % 7 * 150_000_000, width], [1.0, float(i)]), 100.0 * (i % 7) + 2.0 * i) for i in range(50)]
    rows = spark.createDataFrame(data, ["features", "y"])
    line = models.linear_regression("y", one_hot=[width], tol=1e-12).fit(rows)
    Pipeline(stages=[models.linear_regression("y", one_hot=[width])]).save(str(tmp_path / "estimator"))
    PipelineModel([line]).save(str(tmp_path / "model"))
    loaded = PipelineModel.load(str(tmp_path / "model"))
    for model in (line, loaded):
        got = model.transform(rows).select("y", "prediction").collect()
        assert [r.prediction for r in got] == pytest.approx([r.y for r in got], abs=1e-6)
    assert Pipeline.load(str(tmp_path / "estimator")).getStages()[0].getOrDefault("sizes") == [width]


def test_wide_job_keeps_coefficients_in_a_table(spark):
    """The job's model has no vector of coefficients, and its scratch tables are those that are still read."""
    rows = spark.range(40_000).select(
        F.concat(F.lit("v"), (F.col("id") % 5_000).cast("string")).alias("c"),
        (F.col("id") % 13).cast("double").alias("n"),
        (F.col("id") % 5_000 + 3.0 * (F.col("id") % 13)).alias("y"),
        "id",
    )
    before = set(os.listdir(scratch(spark)))
    result = jobs.regression_job(rows, "y", keys=["id"], tol=1e-12)
    line = result.model.stages[-1]
    assert isinstance(line, SparseLinearModel)
    assert line.coefficients.count() == sum(result.model.stages[0].getOrDefault("known")) > models.DRIVER_WIDTH
    assert result.rmse < 1e-4
    left = {name.rsplit("-", 1)[0] for name in set(os.listdir(scratch(spark))) - before}
    assert not left & {"regression-state", "regression-direction", "regression-categories", "regression-pairs"}


def scratch(spark):
    folder = spark.conf.get("spark.checkpoint.dir") + "/pixelframe"
    os.makedirs(folder, exist_ok=True)
    return folder


def test_what_only_the_library_solves(spark):
    wide = [models.DRIVER_WIDTH + 1]
    for params in ({"loss": "huber"}, {"regParam": 0.1, "elasticNetParam": 0.5}, {"solver": "l-bfgs"}):
        assert isinstance(models.linear_regression("y", one_hot=wide, **params), LinearRegression)
    assert isinstance(models.linear_regression("y", one_hot=[3]), LinearRegression)
    assert isinstance(models.linear_regression("y", one_hot=wide, regParam=0.1, aggregationDepth=3), SparseLinearRegression)
    with pytest.raises(TypeError):
        models.linear_regression("y", one_hot=wide, unknown=1)


def test_refused_rows(spark):
    dense = spark.createDataFrame([(DenseVector([1.0, 0.0, 3.0]), 1.0)], ["features", "y"])
    with pytest.raises(Exception, match="no sparse vector"):
        SparseLinearRegression(sizes=[2], labelCol="y").fit(dense)
    missing = spark.createDataFrame([(SparseVector(3, [0], [1.0]), None)], dense.schema)
    with pytest.raises(Exception, match="a label is no finite number"):
        SparseLinearRegression(sizes=[2], labelCol="y").fit(missing)
    with pytest.raises(ValueError, match="no rows"):
        SparseLinearRegression(sizes=[2], labelCol="y").fit(missing.where("false"))
