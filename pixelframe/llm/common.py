"""Helpers that several operators share: stored stages, running totals, components."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pixelframe.storage import scratch_path, temporary_setting

#: Drops the shuffle files of a query when it ends; set only while a stage is written.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Keys of documents are sent to all executors up to this size, so that texts need not move.
BROADCAST_BYTES = 32 << 20

#: The tables that were stored within ``stored_alone``.
_PASSING: ContextVar[list[str] | None] = ContextVar("passing", default=None)


#: Holds the columns of a table that an operator carries along.
ASIDE = "columns set aside"


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The result has no lineage, so a lost executor only re-reads files; its size
    is known, so Spark broadcasts it in joins only where it is small; and the
    shuffle files of the stage are gone once it is written.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with temporary_setting(spark, CLEANUP, "true"):
        df.write.parquet(path)
    if (passing := _PASSING.get()) is not None:
        passing.append(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove the files of a stored table that no later step reads."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        _remove(df.sparkSession, folder)


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stored_alone(make: Callable[[], DataFrame], name: str) -> DataFrame:
    """The table that ``make`` builds, stored; all tables it stored on the way are removed then."""
    outer = _PASSING.get()
    token = _PASSING.set([])
    try:
        result = store(make(), name)
        *passing, kept = _PASSING.get()
    finally:
        _PASSING.reset(token)
    for folder in passing:
        _remove(result.sparkSession, folder)
    if outer is not None:
        outer.append(kept)
    return result


def hinted(stored: DataFrame, bytes_each: int, weight: Column | None = None) -> DataFrame:
    """A stored table, marked for broadcast where its counted size is below ``BROADCAST_BYTES``.

    ``weight`` counts for a row what ``bytes_each`` is the size of; one by default.
    Larger tables are joined by a shuffle.
    """
    size = stored.agg(F.sum(F.lit(1) if weight is None else weight)).first()[0] or 0
    return F.broadcast(stored) if size * bytes_each <= BROADCAST_BYTES else stored


def fingerprint(text: str | Column) -> Column:
    """Tells rows with one id and different texts apart; the id stays part of every key."""
    return F.xxhash64(text)


def same_row(docs: DataFrame, keys: DataFrame) -> Column:
    """Joins ``docs`` to ``keys`` (_id, _print) of its rows; a null id equals a null id."""
    return docs["doc_id"].eqNullSafe(keys["_id"]) & (fingerprint(docs["text"]) == keys["_print"])


def without_repeats(docs: DataFrame, repeated: DataFrame) -> DataFrame:
    """``docs`` with one row for each key in ``repeated`` (_id, _print); only those rows move."""
    once = docs.join(repeated, same_row(docs, repeated), "left_anti")
    again = docs.join(repeated, same_row(docs, repeated), "left_semi")
    return once.unionByName(again.dropDuplicates(["doc_id", "text"]))


def set_aside(docs: DataFrame, used: Sequence[str]) -> DataFrame:
    """The columns ``used`` that ``docs`` has, and all others in one whose name no operator uses."""
    others = [quoted(c) for c in docs.columns if c not in used]
    aside = [F.struct(*others).alias(ASIDE)] if others else []
    return docs.select(*(c for c in used if c in docs.columns), *aside)


def put_back(df: DataFrame, docs: DataFrame, own: DataFrame, added: Sequence[str] = ()) -> DataFrame:
    """The columns of ``docs`` in their order, from ``df``, made of ``own``; then ``added``, which replace those of their name."""
    columns = [
        F.col(quoted(c)) if c in own.columns else F.col(quoted(ASIDE)).getField(c).alias(c) for c in docs.columns if c not in added
    ]
    return df.select(*columns, *added)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def root_of(n: int) -> int:
    """Bucket count that keeps both the buckets and the rows per bucket near the square root."""
    return max(1, math.isqrt(max(0, n - 1)) + 1)


def running_total(
    df: DataFrame, key: str, bucket: str, order: Sequence[Column], value: str
) -> DataFrame:
    """Adds ``before``, the sum of ``value`` over the earlier rows of the key, and ``nth``.

    Buckets follow the order. Their totals are summed first, so no task holds
    all rows of a hot key: one holds a row per bucket, the others one bucket each.
    ``nth`` counts rows within the bucket.
    """
    totals = df.groupBy(key, bucket).agg(F.sum(value).alias("_sum"))
    over = Window.partitionBy(key).orderBy(bucket)
    starts = totals.select(key, bucket, (F.sum("_sum").over(over) - F.col("_sum")).alias("_start"))
    inside = Window.partitionBy(key, bucket).orderBy(*order)
    earlier = F.sum(value).over(inside.rowsBetween(Window.unboundedPreceding, -1))
    return (
        df.join(starts, [key, bucket])
        .withColumn("before", F.col("_start") + F.coalesce(earlier, F.lit(0)))
        .withColumn("nth", F.row_number().over(inside))
        .drop("_start")
    )


def ranked(df: DataFrame, group: str, order: Sequence[str], name: str) -> DataFrame:
    """``df`` with ``rank``, from 0 in its group, nulls first; ranges are numbered apart and summed up."""
    by = [F.col(group).asc_nulls_first(), *(F.col(c).asc_nulls_first() for c in order)]
    spread = df.withColumn("_row", F.monotonically_increasing_id())  # equal rows need not share a range
    dealt = spread.repartitionByRange(*by, "_row").sortWithinPartitions(*by, "_row").drop("_row")
    nth = F.monotonically_increasing_id()
    placed = store(dealt.withColumn("_part", F.shiftright(nth, 33)).withColumn("_nth", nth), f"{name}-sorted")
    spans = placed.groupBy(F.col(group).alias("_group"), F.col("_part").alias("_of")).agg(
        F.min("_nth").alias("_low"), F.count(F.lit(1)).alias("_rows")
    )
    before = Window.partitionBy("_group").orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    starts = store(spans.withColumn("_start", F.coalesce(F.sum("_rows").over(before), F.lit(0))), f"{name}-starts")
    same = placed[group].eqNullSafe(F.col("_group")) & (placed["_part"] == F.col("_of"))
    joined = placed.join(starts, same).withColumn("rank", F.col("_start") + F.col("_nth") - F.col("_low"))
    return joined.select(*df.columns, "rank")


def components(edges: DataFrame, name: str) -> DataFrame:
    """Connected components of edges (a, b): rows (node, component), the smallest node.

    Every round maps each node to the least of itself and its neighbours and
    contracts the edges to those; the maps are stored and composed. Minima are
    combined before the shuffle, so a node with very many edges is no hot key.
    """
    current = store(edges.where("a <> b").select("a", "b").distinct(), f"{name}-edges")
    labels: DataFrame | None = None
    while not current.isEmpty():
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = store(
            both.groupBy(F.col("a").alias("node")).agg(
                F.least(F.col("node"), F.min("b")).alias("to")
            ),
            f"{name}-least",
        )
        if labels is None:
            labels = least.withColumnRenamed("to", "component")
        else:
            labels = store(
                labels.join(least, labels["component"] == least["node"], "left").select(
                    labels["node"], F.coalesce(least["to"], labels["component"]).alias("component")
                ),
                f"{name}-labels",
            )
        left = least.select(F.col("node").alias("a"), F.col("to").alias("x"))
        right = least.select(F.col("node").alias("b"), F.col("to").alias("y"))
        mapped = current.join(left, "a").join(right, "b").where("x <> y")
        current = store(
            mapped.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(),
            f"{name}-edges",
        )
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("a").alias("component")).limit(0)
    return labels
