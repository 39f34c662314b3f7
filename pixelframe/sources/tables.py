"""Parquet and CSV readers."""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema

from pixelframe.schemas import CATALOG, LABEL_DICTIONARY_CSV
from pixelframe.sources.remote import TaskStorage
from pixelframe.storage import materialize


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet scan; a narrower ``schema`` prunes columns at the scan."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` to the fields of ``schema``, in order and cast to its types."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns missing from the table: {missing}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def read_metadata(
    spark: SparkSession, path: str, schema: T.StructType = CATALOG
) -> DataFrame:
    """Catalogue scan with every field brought to its declared type."""
    return conform(read_table(spark, path), schema)


#: Shapes of files that a drifting table is read in; more mean that it is not one table.
MOST_SHAPES = 1000
FOOTERS = "path string, shape string, problem string"


class Drift(NamedTuple):
    """rows: those of all files that can be brought to the schema; rejects: (path, reason) of the others."""

    rows: DataFrame
    rejects: DataFrame


def read_footers(files: DataFrame, path: str = "path") -> DataFrame:
    """(path, shape, problem) of Parquet files: the schema as JSON, read from each footer in the tasks."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        storage = TaskStorage()
        for batch in batches:
            paths, shapes, problems = batch.column(0).to_pylist(), [], []
            for p in paths:
                try:
                    source = storage.open(p)
                    if source is None:
                        raise ValueError("no such file")
                    shapes.append(from_arrow_schema(pq.read_schema(source)).json())
                    problems.append(None)
                except (ValueError, pa.ArrowException, TypeError) as problem:
                    shapes.append(None)
                    problems.append(f"unreadable footer: {problem}")
            columns = [pa.array(c, pa.string()) for c in (paths, shapes, problems)]
            yield pa.RecordBatch.from_arrays(columns, ["path", "shape", "problem"])

    return files.select(path).mapInArrow(rows, FOOTERS)


def _mismatch(shape: T.StructType, schema: T.StructType) -> str | None:
    """Why a file of this shape cannot be brought to the schema; None if it can.

    Numbers, booleans and strings are cast where no value can be lost: to a wider
    number, or to a string. Anything else, such as a string for an array, is not.
    """
    wider = ["tinyint", "smallint", "int", "bigint", "float", "double"]
    found = {f.name: f.dataType for f in shape.fields}
    for f in schema.fields:
        if f.name not in found:
            return f"column {f.name} is missing"
        have, want = found[f.name].simpleString(), f.dataType.simpleString()
        exact = {("int", "float"), ("bigint", "float"), ("bigint", "double")}
        widened = have in wider and want in wider and wider.index(have) < wider.index(want) and (have, want) not in exact
        if have != want and not widened and not (want == "string" and have in (*wider[:4], "boolean")):
            return f"column {f.name} is {have}, not {want}"
    return None


def read_drifting(spark: SparkSession, files: DataFrame, schema: T.StructType) -> Drift:
    """Parquet files whose types have drifted, brought to one schema; files of another shape are rejects.

    Footers are read in the tasks and grouped by shape. Files of one shape are read
    together with that shape and cast; columns the schema lacks are not read.
    """
    footers = materialize(read_footers(files), "footers")
    shapes = [r["shape"] for r in footers.where("shape is not null").select("shape").distinct().limit(MOST_SHAPES + 1).collect()]
    if len(shapes) > MOST_SHAPES:
        raise ValueError(f"files of more than {MOST_SHAPES} shapes")
    fits, reasons = [], []
    for text in sorted(shapes):
        shape = T.StructType.fromJson(json.loads(text))
        reason = _mismatch(shape, schema)
        if reason is None:
            fits.append((text, T.StructType([shape[f.name] for f in schema.fields])))
        reasons.append((text, reason))
    rows = spark.createDataFrame([], schema)
    for text, shape in fits:
        own = [r["path"] for r in footers.where(F.col("shape") == text).select("path").collect()]  # Spark lists files on the driver
        rows = rows.unionByName(conform(spark.read.schema(shape).parquet(*own), schema))
    known = spark.createDataFrame(reasons, "shape string, reason string")
    judged = footers.join(F.broadcast(known), "shape", "left")
    rejects = judged.select("path", F.coalesce("problem", "reason").alias("reason")).where("reason is not null")
    return Drift(rows, rejects)


def read_csv_strings(
    spark: SparkSession, path: str, schema: T.StructType | None = None, sep: str = ","
) -> DataFrame:
    """CSV with a header, all columns strings."""
    reader = spark.read.option("header", True).option("sep", sep)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def read_csv_inferred(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """CSV with a header and inferred types; inference is one more pass over the files."""
    return spark.read.csv(path, sep=sep, header=True, inferSchema=True)


def read_label_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """Label dictionary ``ID, ID_NEW, DESC`` as strings, with the header checked."""
    raw = read_csv_strings(spark, path)
    expected = LABEL_DICTIONARY_CSV.fieldNames()
    if raw.columns != expected:
        raise ValueError(f"label dictionary has columns {raw.columns}, not {expected}")
    return raw

