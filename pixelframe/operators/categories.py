"""Category features of any width as saved pipeline stages.

The index of a column is a stored table of its values and codes, joined where it
is applied: neither the fit nor the transform brings values to the driver. One-hot
categories and scaled numbers go straight into one sparse vector, which holds as
many entries as a row has features, however wide it is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
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
from pyspark.sql import types as T

from pixelframe.operators.features import category_codes
from pixelframe.storage import materialize

SUFFIX = "_index"
VALUE, CODE = "value", "code"


def _strings(name: str, doc: str) -> Param:
    return Param(Params._dummy(), name, doc, TypeConverters.toListString)


class _IndexParams(Params):
    inputCols = _strings("inputCols", "columns of categories")
    suffix = Param(Params._dummy(), "suffix", "added to a column's name", TypeConverters.toString)

    def output_columns(self) -> list[str]:
        return [c + self.getOrDefault("suffix") for c in self.getOrDefault("inputCols")]


class CategoryIndexer(Estimator, _IndexParams, DefaultParamsReadable, DefaultParamsWritable):
    """Codes by frequency, ties by value, for columns with any number of values.

    NULL and values that the fit has not seen get one extra code, the number of
    known values, as with MLlib's indexer and ``keep``.
    """

    @keyword_only
    def __init__(self, *, inputCols=None, suffix=None):
        super().__init__()
        self._setDefault(inputCols=[], suffix=SUFFIX)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame) -> CategoryIndexModel:
        codes = []
        for c in self.getOrDefault("inputCols"):
            values = df.select(F.col(c).alias(VALUE))
            codes.append(materialize(category_codes(values, VALUE, CODE), "category-table"))
        model = CategoryIndexModel(codes)
        self._copyValues(model)
        return model._set(known=[table.count() for table in codes])


class CategoryIndexModel(Model, _IndexParams, MLReadable, MLWritable):
    """A fitted index: a table (value, code) per column, in the order of ``inputCols``."""

    known = Param(Params._dummy(), "known", "values per column", TypeConverters.toListInt)

    def __init__(self, codes: Sequence[DataFrame] = ()):
        super().__init__()
        self._setDefault(inputCols=[], suffix=SUFFIX, known=[])
        self.codes = list(codes)

    def _transform(self, df: DataFrame) -> DataFrame:
        columns = zip(self.getOrDefault("inputCols"), self.output_columns(), self.codes, self.getOrDefault("known"))
        for column, output, codes, known in columns:
            table = codes.select(F.col(VALUE).alias("__value"), F.col(CODE).alias("__code"))
            joined = df.join(table, df[column] == table["__value"], "left")
            code = F.coalesce("__code", F.lit(float(known)))
            df = joined.withColumn(output, code).drop("__value", "__code")
        return df

    def write(self) -> MLWriter:
        return _IndexWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _IndexReader()


def _codes_path(path: str, i: int) -> str:
    return f"{path.rstrip('/')}/codes/{i}"


class _IndexWriter(MLWriter):
    def __init__(self, model: CategoryIndexModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        for i, codes in enumerate(self.model.codes):
            codes.write.parquet(_codes_path(path, i))


class _IndexReader(MLReader):
    def load(self, path: str) -> CategoryIndexModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = CategoryIndexModel()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        count = len(model.getOrDefault("known"))
        model.codes = [self.sparkSession.read.parquet(_codes_path(path, i)) for i in range(count)]
        return model


def sparse_vector(size: int, indices: Column, values: Column) -> Column:
    """A sparse vector of ``size`` from ascending indices and their values.

    The vector type is a struct to Spark, and reading JSON is what turns a plain
    struct into it inside the JVM.
    """
    fields = F.struct(
        F.lit(0).cast("byte").alias("type"), F.lit(size).alias("size"), indices.alias("indices"), values.alias("values")
    )
    kind = T.StructType([T.StructField("v", VectorUDT())])
    return F.from_json(F.to_json(F.struct(fields.alias("v"))), kind)["v"]


class SparseAssembler(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """One-hot categories and scaled numbers as one sparse vector.

    A code at or above its column's size, which is what NULL and unseen values
    have, sets no entry. Numbers are divided by their scale, or are 0 where that is
    0. A row with a missing number raises, or is left out with ``skip``.
    """

    indexCols = _strings("indexCols", "columns of category codes")
    sizes = Param(Params._dummy(), "sizes", "known values per column", TypeConverters.toListInt)
    numericCols = _strings("numericCols", "columns of numbers")
    scales = Param(Params._dummy(), "scales", "divisor per column", TypeConverters.toListFloat)
    outputCol = Param(Params._dummy(), "outputCol", "vector column", TypeConverters.toString)
    handleInvalid = Param(Params._dummy(), "handleInvalid", "error or skip", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, indexCols=None, sizes=None, numericCols=None, scales=None, outputCol=None, handleInvalid=None):
        super().__init__()
        self._setDefault(indexCols=[], sizes=[], numericCols=[], scales=[], outputCol="features", handleInvalid="error")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, df: DataFrame) -> DataFrame:
        sizes, numeric = self.getOrDefault("sizes"), self.getOrDefault("numericCols")
        indices, values, offset = [], [], 0
        for column, size in zip(self.getOrDefault("indexCols"), sizes):
            code, known = F.col(column).cast("int"), F.col(column) < size
            indices.append(F.when(known, F.array(code + offset)).otherwise(F.array().cast("array<int>")))
            values.append(F.when(known, F.array(F.lit(1.0))).otherwise(F.array().cast("array<double>")))
            offset += size
        if numeric:
            scaled = [
                F.col(c).cast("double") / F.lit(s) if s else F.col(c).cast("double") * 0.0
                for c, s in zip(numeric, self.getOrDefault("scales"))
            ]
            indices.append(F.array(*(F.lit(offset + i) for i in range(len(numeric)))))
            values.append(F.array(*scaled))
        width = offset + len(numeric)
        output = self.getOrDefault("outputCol")
        complete = F.lit(True)
        for c in numeric:
            complete &= F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
        vector = sparse_vector(width, F.concat(*indices), F.concat(*values))
        if self.getOrDefault("handleInvalid") == "skip":
            df = df.where(complete)
        else:
            vector = F.when(complete, vector).otherwise(F.raise_error(F.lit(f"a number is missing in {numeric}")))
        named = {"ml_attr": {"num_attrs": width}}
        return df.withColumn(output, vector).withMetadata(output, named)


def sparse_assembler(
    index: CategoryIndexModel, df: DataFrame, numerical: Sequence[str], output: str = "features"
) -> SparseAssembler:
    """An assembler for the codes of ``index`` and the numbers, scaled by their deviation in ``df``; one pass."""
    scales = df.agg(*(F.stddev_samp(c).alias(c) for c in numerical)).first() if numerical else ()
    return SparseAssembler(
        indexCols=index.output_columns(),
        sizes=index.getOrDefault("known"),
        numericCols=list(numerical),
        scales=[s or 0.0 for s in scales],
        outputCol=output,
    )
