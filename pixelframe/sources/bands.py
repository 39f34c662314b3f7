"""Bands as tables of their own, bucketed alike, so that they meet without a shuffle.

A band's table has a row per block of a patch. All bands are written in the same
buckets of (keys, first pixel), sorted; joining any of them reads matching
buckets side by side. Bands can so be added or replaced one at a time.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from pixelframe.schemas import PIXEL_BANDS
from pixelframe.sources.rasters import FIRST_PIXEL


def table_name(name: str, band: str) -> str:
    return f"{name}_{band.lower()}"


def write_bands(
    decoded: DataFrame,
    path: str,
    name: str,
    keys: Sequence[str],
    buckets: int,
    bands: Sequence[str] = PIXEL_BANDS,
) -> None:
    """Store the arrays of ``decoded`` (keys, first_pixel, a column per band), a table per band below ``path``.

    ``decoded`` is read once for each band: store it first. Rows are dealt by the
    buckets before they are written, so a bucket is one file.
    """
    by = [*keys, FIRST_PIXEL]
    for band in bands:
        dealt = decoded.select(*by, band).repartition(buckets, *by)
        writer = dealt.write.mode("overwrite").format("parquet").bucketBy(buckets, *by).sortBy(*by)
        writer.option("path", f"{path}/{band}").saveAsTable(table_name(name, band))


def register_bands(
    spark: SparkSession,
    path: str,
    name: str,
    keys: Sequence[str],
    buckets: int,
    bands: Sequence[str] = PIXEL_BANDS,
) -> None:
    """Name stored bands in a session whose catalogue does not know them."""
    by = ", ".join([*keys, FIRST_PIXEL])
    for band in bands:
        schema = spark.read.parquet(f"{path}/{band}").schema
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(
            f"CREATE TABLE {table_name(name, band)} ({columns}) USING parquet"
            f" CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{path}/{band}'"
        )


def join_bands(
    spark: SparkSession, name: str, keys: Sequence[str], bands: Sequence[str] = PIXEL_BANDS
) -> DataFrame:
    """(keys, first_pixel, a column per band): the bands' rows of one block side by side, none moved."""
    tables = [spark.table(table_name(name, b)) for b in bands]
    return reduce(lambda left, right: left.join(right.hint("merge"), [*keys, FIRST_PIXEL]), tables)
