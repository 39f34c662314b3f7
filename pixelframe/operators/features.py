"""Feature columns and vectors."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.ml import Transformer
from pyspark.ml.base import Estimator
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pixelframe.storage import materialize

# The column types that count as numbers.
NUMERIC_TYPES = ("int", "double")


def feature_columns(df: DataFrame, exclude: Sequence[str] = ("label",)) -> list[str]:
    return [c for c in df.columns if c not in exclude]


def columns_by_type(
    df: DataFrame, label: str, numeric: Sequence[str] = NUMERIC_TYPES
) -> tuple[list[str], list[str]]:
    """(categorical, numerical) columns by type; the label is in neither."""
    categorical = [c for c, t in df.dtypes if t == "string" and c != label]
    numerical = [c for c, t in df.dtypes if t in numeric and c != label]
    return categorical, numerical


def drop_incomplete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a number in every column: neither NULL nor NaN."""
    return df.dropna(subset=list(columns))


def assembler(
    columns: Sequence[str], output: str = "features", handle_invalid: str = "skip"
) -> VectorAssembler:
    return VectorAssembler(
        inputCols=list(columns), outputCol=output, handleInvalid=handle_invalid
    )


def assemble(
    df: DataFrame,
    label: str = "label",
    exclude: Sequence[str] = (),
    keep: Sequence[str] = (),
    output: str = "features",
) -> DataFrame:
    """Feature vector, label and ``keep``; rows with a missing feature are skipped.

    Gives what the assembler gives for plain number columns, vector metadata
    included, but tests and packs the columns in generated code, which took about
    a third of the time on 4 million pixels.
    """
    columns = feature_columns(df, (label, *exclude, *keep))
    values = F.array(*[F.col(c).cast("double") for c in columns])
    names = [{"idx": i, "name": c} for i, c in enumerate(columns)]
    attributes = {"ml_attr": {"attrs": {"numeric": names}, "num_attrs": len(columns)}}
    vector = array_to_vector(values).alias(output, metadata=attributes)
    return drop_incomplete(df, columns).select(*keep, vector, label)


class TooManyCategories(ValueError):
    """A column has more values than a category index may hold on the driver."""


def check_categories(df: DataFrame, columns: Sequence[str], limit: int) -> None:
    """Raise if a column has clearly more than ``limit`` values; one pass over the data.

    The MLlib indexer brings the distinct values of a column to the driver, so
    the check bounds what it may collect. ``index_categories`` has no such bound.
    """
    if not columns:
        return
    counts = df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns]).first()
    above = {c: counts[c] for c in columns if counts[c] > limit}
    if above:
        raise TooManyCategories(f"more than {limit} categories: {above}")


def category_indexer(columns: Sequence[str], suffix: str = "_index") -> StringIndexer:
    """Frequency-ordered category indices; unseen values get one extra index.

    One estimator for all columns: it counts them in a single pass.
    """
    return StringIndexer(
        inputCols=list(columns),
        outputCols=[c + suffix for c in columns],
        handleInvalid="keep",
    )


def one_hot_encoder(
    columns: Sequence[str], source: str = "_index", suffix: str = "_ohe"
) -> OneHotEncoder:
    return OneHotEncoder(
        inputCols=[c + source for c in columns], outputCols=[c + suffix for c in columns]
    )


def category_codes(df: DataFrame, column: str, output: str) -> DataFrame:
    """Each value of ``column`` with its index: most frequent first, ties by value.

    The distributed form of the category index, for any number of values: the
    values are sorted by range across partitions, and the index is the number of
    values in earlier partitions plus the place within the own one.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("__n"))
    ordered = counts.orderBy(F.desc("__n"), column)
    # Stored, because sizes and places must come from one and the same sort: the
    # bounds of its ranges are sampled and could differ if it ran twice.
    stored = materialize(
        ordered.select(column, F.monotonically_increasing_id().alias("__id")), "category-codes"
    )
    ordered = stored.select(
        column,
        F.shiftright("__id", 33).alias("__part"),
        F.col("__id").bitwiseAND(F.lit((1 << 33) - 1)).alias("__row"),
    )
    # One row per partition of the sort: bounded by the number of partitions.
    sizes = ordered.groupBy("__part").agg(F.count(F.lit(1)).alias("__size"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "__part", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__before")
    )
    return ordered.join(F.broadcast(offsets), "__part").select(
        column, (F.col("__before") + F.col("__row")).cast("double").alias(output)
    )


class CategoryIndex(NamedTuple):
    """A fitted index without a limit on values: a stored code table per column.

    As in the indexer with ``keep``, NULL and values that the fit has not seen
    get one extra index, the number of known values.
    """

    codes: Mapping[str, DataFrame]
    known: Mapping[str, int]
    suffix: str

    def transform(self, df: DataFrame) -> DataFrame:
        for c, codes in self.codes.items():
            output = c + self.suffix
            extra = F.lit(float(self.known[c]))
            df = df.join(codes, c, "left").withColumn(output, F.coalesce(output, extra))
        return df


def fit_categories(
    df: DataFrame, columns: Sequence[str], suffix: str = "_index"
) -> CategoryIndex:
    """Codes of each column's values; neither values nor codes come to the driver."""
    codes = {c: category_codes(df, c, c + suffix) for c in columns}
    return CategoryIndex(codes, {c: t.count() for c, t in codes.items()}, suffix)


def index_categories(df: DataFrame, columns: Sequence[str], suffix: str = "_index") -> DataFrame:
    """Add a category index per column without bringing the values to the driver."""
    return fit_categories(df, columns, suffix).transform(df)


def scaler(input: str, output: str) -> StandardScaler:
    """Division by the sample standard deviation, without centring."""
    return StandardScaler(inputCol=input, outputCol=output)


def mixed_feature_stages(
    categorical: Sequence[str], numerical: Sequence[str], output: str = "features"
) -> list[Estimator | Transformer]:
    """Index and one-hot the categories, scale the numbers, assemble both."""
    stages: list[Estimator | Transformer] = []
    if categorical:
        stages += [category_indexer(categorical), one_hot_encoder(categorical)]
    inputs = [c + "_ohe" for c in categorical]
    if numerical:
        stages.append(assembler(numerical, "numerical_features", "error"))
        stages.append(scaler("numerical_features", "scaled_numerical_features"))
        inputs.append("scaled_numerical_features")
    stages.append(assembler(inputs, output, "error"))
    return stages


def vector_elements(
    df: DataFrame, vector: str, names: Sequence[str], keep: Sequence[str] = ()
) -> DataFrame:
    """Vector elements as scalar columns."""
    elements = df.select(*keep, vector_to_array(vector).alias("__v"))
    return elements.select(*keep, *[F.get("__v", F.lit(i)).alias(n) for i, n in enumerate(names)])

