"""Models and pipeline stages."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pixelframe.functions import indices
from pixelframe.operators import features, labels, models, sampling
from pixelframe.operators.stages import FeatureAssembler, IndexBuilder, LabelRecoder, PixelExploder
from pixelframe.plans.checks.registry import query
from pixelframe.plans.checks.standins import (
    COUNT_SCALE,
    FEATURES_SQL,
    HASH_SQL,
    PIXELS_SQL,
    RECODED_SQL,
    SPLIT_SQL,
    as_count,
    band_arrays,
    nation_dictionary,
    pixel_rows,
    table,
)
from pixelframe.plans.jobs import regression_job
from pixelframe.schemas import FEATURE_COLUMNS, PIXEL_BANDS
from pixelframe.storage import materialize, scratch_path

LINEAR_SQL = """line AS (
  SELECT regr_slope(l_extendedprice, l_quantity) AS slope,
    regr_intercept(l_extendedprice, l_quantity) AS intercept FROM lineitem)"""


def price_model(spark: SparkSession, sf_dir: str):
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"
    )
    stages = [
        features.assembler(["l_quantity"], handle_invalid="error"),
        models.linear_regression("l_extendedprice"),
    ]
    return models.fit(stages, rows), rows


@query(
    "linear_fit",
    f"""WITH {LINEAR_SQL}
    SELECT round(any_value(slope), 4) AS slope, round(any_value(intercept), 3) AS intercept,
      round(sqrt(avg(power(slope * l_quantity + intercept - l_extendedprice, 2))), 4) AS rmse
    FROM lineitem, line""",
)
def linear_fit(spark, sf_dir):
    model, rows = price_model(spark, sf_dir)
    line = model.stages[-1]
    predicted = models.predict(model, rows, ["l_extendedprice", "prediction"])
    return predicted.agg(
        F.round(F.lit(float(line.coefficients[0])), 4).alias("slope"),
        F.round(F.lit(float(line.intercept)), 3).alias("intercept"),
        F.round(models.rmse_of("l_extendedprice"), 4).alias("rmse"),
    )


@query(
    "batch_prediction",
    f"""WITH {LINEAR_SQL}
    SELECT l_orderkey, l_linenumber, round(slope * l_quantity + intercept, 2) AS prediction
    FROM lineitem, line""",
)
def batch_prediction(spark, sf_dir):
    model, rows = price_model(spark, sf_dir)
    predicted = models.predict(model, rows, ["l_orderkey", "l_linenumber", "prediction"])
    return predicted.withColumn("prediction", F.round("prediction", 2))


@query(
    "accuracy",
    f"""SELECT {SPLIT_SQL} AS split,
      round(avg((label = floor(list_max([abs(v::DOUBLE) for v in embedding]) * 20))::INTEGER), 6) AS accuracy,
      count(*) AS rows FROM embeddings GROUP BY split""",
)
def accuracy(spark, sf_dir):
    """The largest value of the whole vector guesses the label."""
    largest = F.array_max(F.transform("embedding", lambda v: F.abs(v.cast("double"))))
    predicted = table(spark, sf_dir, "embeddings").select(
        F.expr(SPLIT_SQL).alias("split"), "label", F.floor(largest * F.lit(20.0)).cast("double").alias("prediction")
    )
    return models.accuracy_by(predicted, ["split"]).withColumn("accuracy", F.round("accuracy", 6))


@query(
    "mixed_regression",
    f"""WITH rows AS (
      SELECT l_orderkey, l_linenumber, l_returnflag AS flag, l_quantity AS x, l_extendedprice AS y,
        {HASH_SQL.format("l_orderkey")} < 0.8::DOUBLE AS train FROM lineitem),
    means AS (SELECT flag, avg(x) AS mx, avg(y) AS my FROM rows WHERE train GROUP BY flag),
    line AS (SELECT sum((x - mx) * (y - my)) / sum((x - mx) * (x - mx)) AS slope
      FROM rows JOIN means USING (flag) WHERE train)
    SELECT l_orderkey, l_linenumber, round(my + slope * (x - mx), 3) AS prediction
    FROM rows JOIN means USING (flag), line WHERE NOT train""",
)
def mixed_regression(spark, sf_dir):
    """One category and one number: least squares has a closed form to compare with."""
    keys = ["l_orderkey", "l_linenumber"]
    rows = table(spark, sf_dir, "lineitem").select(
        *keys, "l_returnflag", "l_quantity", "l_extendedprice"
    )
    result = regression_job(rows, "l_extendedprice", keys=keys, tol=1e-12, maxIter=1000)
    return result.predictions.select(*keys, F.round("prediction", 3).alias("prediction"))


@query(
    "wide_regression",
    f"""WITH rows AS (
      SELECT l_orderkey * 8 + l_linenumber AS line, 'order ' || l_orderkey AS category, l_quantity AS x,
        l_extendedprice AS y, {HASH_SQL.format("(l_orderkey * 8 + l_linenumber)")} < 0.8::DOUBLE AS train FROM lineitem),
    means AS (SELECT category, avg(x) AS mx, avg(y) AS my FROM rows WHERE train GROUP BY category),
    slope AS (SELECT sum((x - mx) * (y - my)) / sum((x - mx) * (x - mx)) AS slope
      FROM rows JOIN means USING (category) WHERE train)
    SELECT line, round(my + slope * (x - mx), -2) AS prediction
    FROM rows JOIN means USING (category), slope WHERE NOT train""",
)
def wide_regression(spark, sf_dir):
    """A category per order, a quarter as many as rows, through the saved and loaded model."""
    rows = table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("line"),
        F.concat(F.lit("order "), F.col("l_orderkey").cast("string")).alias("category"),
        "l_quantity",
        "l_extendedprice",
    )
    result = regression_job(rows, "l_extendedprice", keys=["line"], tol=1e-12, maxIter=200)
    path = scratch_path(spark, "wide-model")
    result.model.save(path)
    loaded = PipelineModel.load(path)
    index = loaded.stages[0]
    seen = F.col("category_index") < index.getOrDefault("known")[0]
    predicted = loaded.transform(result.predictions.select("line", "category", "l_quantity")).where(seen)
    return predicted.select("line", F.round("prediction", -2).alias("prediction"))


def stored_dictionary(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "dictionary")
    nation_dictionary(spark, sf_dir).write.csv(path, header=True)
    return path


@query(
    "feature_stages",
    f"""WITH {PIXELS_SQL}, {FEATURES_SQL}, {RECODED_SQL}
    SELECT label, {", ".join(f"{c}::DOUBLE AS {c}" for c in FEATURE_COLUMNS)} FROM recoded
    WHERE {" AND ".join(f"{c} IS NOT NULL" for c in FEATURE_COLUMNS)}""",
)
def feature_stages(spark, sf_dir):
    """Explode, indices, labels and vectors as one saved-form pipeline."""
    bands = [
        F.transform(b, lambda v: as_count(v, COUNT_SCALE[b])) if b in COUNT_SCALE else F.col(b)
        for b in PIXEL_BANDS
    ]
    patches = band_arrays(spark, sf_dir).select(
        F.struct(*[c.alias(b) for b, c in zip(PIXEL_BANDS, bands)]).alias("pixel_arrays")
    )
    stages = [
        PixelExploder(),
        IndexBuilder(),
        LabelRecoder(path=stored_dictionary(spark, sf_dir)),
        FeatureAssembler(),
    ]
    vectors = models.fit(stages, patches).transform(patches)
    return features.vector_elements(vectors, "features", FEATURE_COLUMNS, ["label"])


def training_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Split, features and label of all pixels."""
    rows = indices.add_indices(pixel_rows(spark, sf_dir).drop("pos", "vec_id"))
    recoded = labels.recode_labels(rows, nation_dictionary(spark, sf_dir))
    return recoded.select("split", *FEATURE_COLUMNS, "label")


def training_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature vectors, from rows written once so that training does not redo them."""
    return features.assemble(materialize(training_rows(spark, sf_dir), "training"), keep=["split"])


@query("forest")
def forest(spark, sf_dir):
    vectors = training_vectors(spark, sf_dir)
    model = models.fit([models.forest()], sampling.split_rows(vectors, "train"))
    return models.accuracy_by(
        models.predict(model, vectors, ["split", "label", "prediction"]), ["split"]
    )


@query(
    "forest_stump",
    f"""WITH {PIXELS_SQL}, {FEATURES_SQL}, {RECODED_SQL},
    complete AS (SELECT split, label FROM recoded
      WHERE {" AND ".join(f"{c} IS NOT NULL" for c in FEATURE_COLUMNS)}),
    majority AS (SELECT label AS guess FROM complete WHERE split = 'train'
      GROUP BY label ORDER BY count(*) DESC, label LIMIT 1)
    SELECT split, avg((label = guess)::INTEGER) AS accuracy, count(*) AS rows
    FROM complete, majority GROUP BY split""",
)
def forest_stump(spark, sf_dir):
    """One tree without splits guesses the most frequent class of the training pixels."""
    vectors = training_vectors(spark, sf_dir)
    classifier = models.forest(numTrees=1, maxDepth=0, bootstrap=False)
    model = models.fit([classifier], sampling.split_rows(vectors, "train"))
    return models.accuracy_by(
        models.predict(model, vectors, ["split", "label", "prediction"]), ["split"]
    )


@query("tuning")
def tuning(spark, sf_dir):
    rows = training_rows(spark, sf_dir)
    tuned = models.tune_forest(
        sampling.split_rows(rows, "train"),
        [FeatureAssembler(keep=["split"])],
        models.forest(),
        models.accuracy_evaluator(),
        {"numTrees": [3, 6], "maxDepth": [4]},
        folds=2,
        parallelism=2,
    )
    return models.accuracy_by(
        models.predict(tuned.model, rows, ["split", "label", "prediction"]), ["split"]
    )


RULE_SQL = """CASE WHEN l_linenumber <= 3 AND l_returnflag = 'R' THEN 1
    WHEN l_linenumber <= 3 THEN 0 WHEN l_quantity <= 25 THEN 2 ELSE 3 END::DOUBLE"""
#: Trees that see all rows and columns: a rule over few values is then learned exactly.
WHOLE = {"numTrees": 3, "bootstrap": False, "featureSubsetStrategy": "all"}


def rule_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with three features of few values and a label that is a rule over them."""
    line, returned = F.col("l_linenumber"), F.col("l_returnflag") == "R"
    few = F.col("l_quantity") <= 25
    label = F.when((line <= 3) & returned, 1).when(line <= 3, 0).when(few, 2).otherwise(3)
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order"),
        line.cast("double").alias("line"),
        returned.cast("double").alias("returned"),
        few.cast("double").alias("few"),
        label.cast("double").alias("label"),
    )


@query("forest_exact", f"SELECT l_orderkey AS \"order\", {RULE_SQL} AS prediction FROM lineitem")
def forest_exact(spark, sf_dir):
    """A forest of whole trees predicts a rule over its features for every row."""
    rows = materialize(rule_rows(spark, sf_dir), "rule-rows")
    vectors = features.assemble(rows, exclude=["order"], keep=["order"])
    model = models.fit([models.forest(maxDepth=5, **WHOLE)], vectors)
    return models.predict(model, vectors, ["order", "prediction"])


@query(
    "tuning_exact",
    "SELECT 5 AS depth, 1.0::DOUBLE AS accuracy, count(*) AS rows FROM lineitem",
)
def tuning_exact(spark, sf_dir):
    """Three folds choose the only depth that can hold the rule."""
    vectors = features.assemble(rule_rows(spark, sf_dir), exclude=["order"], keep=["order"])
    tuned = models.tune_forest(
        vectors, [], models.forest(**WHOLE), models.accuracy_evaluator(), {"maxDepth": [0, 5]}
    )
    depth = F.lit(tuned.model.stages[-1].getOrDefault("maxDepth")).alias("depth")
    scored = models.predict(tuned.model, vectors)
    return scored.agg(models.accuracy_of().alias("accuracy"), F.count(F.lit(1)).alias("rows")).select(
        depth, "accuracy", "rows"
    )


@query(
    "grouped_folds",
    f"""SELECT floor({HASH_SQL.format("l_orderkey")} * 3)::INTEGER AS fold, 1.0::DOUBLE AS accuracy, count(*) AS rows
    FROM lineitem GROUP BY fold""",
)
def grouped_folds(spark, sf_dir):
    """Items of an order are in one fold; each fold is scored by a forest of the other two."""
    vectors = features.assemble(rule_rows(spark, sf_dir), exclude=["order"], keep=["order"])
    return models.grouped_accuracy(vectors, models.forest(maxDepth=5, **WHOLE), "order")
