"""Counts and summaries of tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))


def dataset_shapes(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and columns of each table, all counted in one query."""
    shapes = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("dataset"), "rows", F.lit(len(df.columns)).alias("columns")
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.union, shapes)


def split_share(df: DataFrame, split: str = "split", digits: int = 2) -> DataFrame:
    """Share of rows per value, as a rounded fraction of all rows with a value."""
    counts = df.where(F.col(split).isNotNull()).groupBy(split).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.select(split, F.round(F.col("n") / total, digits).alias("share"))


def label_count(df: DataFrame, label: str = "labels", split: str = "split") -> DataFrame:
    """Rows with a label per split."""
    return df.groupBy(split).agg(F.count(label).alias("n"))


def column_summary(df: DataFrame) -> DataFrame:
    """Name, position, type and non-null count of each column, in one pass."""
    counts = df.agg(*[F.count(f"`{c}`").alias(f"n{i}") for i, c in enumerate(df.columns)])
    rows = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(field.name).alias("column"),
            F.lit(field.dataType.simpleString()).alias("type"),
            F.col(f"n{i}").alias("non_null"),
        )
        for i, field in enumerate(df.schema.fields)
    ]
    return counts.select(F.inline(F.array(*rows)))
