"""Parquet writers."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pixelframe.sources.rasters import ERROR
from pixelframe.storage import unsorted_writes

# Partition column of the pixel table, and its two values.
STATE = "state"
DECODED, REJECTED = "decoded", "rejected"


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Overwrite ``path`` with ``df``.

    With ``partition_by`` the rows are rebalanced first: small slices are merged
    into whole files and a value that holds most rows is split over many tasks.
    """
    if partition_by:
        columns = [F.col(c) for c in partition_by]
        writer = df.hint("rebalance", *columns).write.mode("overwrite")
        with unsorted_writes(df.sparkSession):
            writer.partitionBy(*partition_by).parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)


def write_catalog(catalog: DataFrame, path: str) -> None:
    """Full catalogue, stored by split so that split filters prune directories."""
    write_table(catalog, path, ["split"])


def write_slim_catalog(catalog: DataFrame, path: str) -> None:
    """Patch id, split and path bundle, as the pixel job reads them."""
    write_table(catalog.select("patch_id", "split", "patch_path_array"), path)


def write_audit(audit: DataFrame, path: str) -> None:
    """Audit rows with their file counts per sensor.

    Most audited patches are complete, so the few rows left over from many
    tasks are merged into whole files.
    """
    write_table(audit.hint("rebalance"), path)


def write_pixels(pixels: DataFrame, path: str, above: Sequence[str] = ()) -> None:
    """Pixel table stored by split, with rejected patches in a directory of their own.

    Rows are not shuffled: the pixel job orders the far smaller patch table by
    split before it decodes, so each task meets one or two splits. ``above`` names
    columns whose values part the table first.
    """
    state = F.when(F.col(ERROR).isNull(), DECODED).otherwise(REJECTED)
    stated = pixels.withColumn(STATE, state)
    with unsorted_writes(pixels.sparkSession):
        stated.write.mode("overwrite").partitionBy(*above, STATE, "split").parquet(path)


def read_pixels(spark: SparkSession, path: str) -> DataFrame:
    """Pixel rows; the directory of rejects is pruned."""
    return spark.read.parquet(path).where(F.col(STATE) == DECODED).drop(STATE, ERROR)


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """Patches that gave no pixels, with the reason."""
    return spark.read.parquet(path).where(F.col(STATE) == REJECTED).select(
        "patch_id", "split", ERROR
    )


# A pixel table that is built in batches: its data and, for each batch that is whole,
# the patches in it. A batch without an entry in the manifest is not part of the table.
DATA, MANIFEST, BATCH = "data", "manifest", "batch"
#: A catalogue row and which of its equal copies, as the manifest names them.
ROW_KEY, COPY = "row_key", "copy"


def committed(spark: SparkSession, path: str) -> DataFrame:
    """(row_key, copy, patch_id, split, batch) of all patches that the table holds."""
    fields = f"{ROW_KEY} long, {COPY} long, patch_id string, split string, {BATCH} string"
    entries = f"{path}/{MANIFEST}"
    if not _exists(spark, entries):
        return spark.createDataFrame([], fields)
    return spark.read.schema(fields).parquet(entries)


def commit_pixels(pixels: DataFrame, patches: DataFrame, path: str) -> list[str]:
    """Write batches of pixels, then their ``patches`` (row_key, copy, patch_id, split) to the manifest.

    Both tables say in ``batch`` which batch a row belongs to. All batches are
    written by one job, out of readers' sight; each then gets a folder and an entry
    of its own, the entry by one rename. Where that does not happen, what was
    written is no part of the table and the batch's patches are still to be done.
    """
    spark = pixels.sparkSession
    run = uuid.uuid4().hex
    data, entries = f"{path}/{DATA}/.{run}", f"{path}/{MANIFEST}/.{run}"
    named = F.concat(F.lit(f"{run}-"), F.col(BATCH).cast("string"))
    write_pixels(pixels.withColumn(BATCH, named), data, [BATCH])
    with unsorted_writes(spark):
        listed = patches.select(ROW_KEY, COPY, "patch_id", "split", named.alias(BATCH))
        spread = listed.repartition(spark.sparkContext.defaultParallelism, BATCH)
        spread.write.partitionBy(BATCH).parquet(entries)
    files, (written,) = _file_system(spark, entries)
    folders = sorted(s.getPath().getName() for s in files.listStatus(written) if s.isDirectory())
    for folder in folders:
        for hidden, shown in ((data, DATA), (entries, MANIFEST)):
            _, (old, new) = _file_system(spark, f"{hidden}/{folder}", f"{path}/{shown}/{folder}")
            if not files.rename(old, new):
                raise OSError(f"{folder} could not be committed")
    for hidden in (data, entries):
        files.delete(_file_system(spark, hidden)[1][0], True)
    return [f.removeprefix(f"{BATCH}=") for f in folders]


def read_committed(spark: SparkSession, path: str) -> DataFrame:
    """All rows of the committed batches, rejects included; other batches are pruned."""
    batches = [r[BATCH] for r in committed(spark, path).select(BATCH).distinct().collect()]  # one per commit
    folders = [f"{path}/{DATA}/{BATCH}={b}" for b in sorted(batches)]
    if not folders:
        raise FileNotFoundError(f"no batch is committed below {path}")
    return spark.read.option("basePath", f"{path}/{DATA}").parquet(*folders).drop(BATCH)


def read_committed_pixels(spark: SparkSession, path: str) -> DataFrame:
    return read_committed(spark, path).where(F.col(STATE) == DECODED).drop(STATE, ERROR)


def drop_uncommitted(spark: SparkSession, path: str) -> int:
    """Remove the data of batches that were not committed; how many. No writer may be at work."""
    kept = {r[BATCH] for r in committed(spark, path).select(BATCH).distinct().collect()}
    if not _exists(spark, f"{path}/{DATA}"):
        return 0
    files, (folder,) = _file_system(spark, f"{path}/{DATA}")
    found = [s.getPath() for s in files.listStatus(folder)]
    left = [p for p in found if p.getName().removeprefix(f"{BATCH}=") not in kept]
    for place in left:
        files.delete(place, True)
    return len(left)


def _file_system(spark: SparkSession, *paths: str):
    jvm = spark.sparkContext._jvm
    places = [jvm.org.apache.hadoop.fs.Path(p) for p in paths]
    return places[0].getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), places


def _exists(spark: SparkSession, path: str) -> bool:
    files, (place,) = _file_system(spark, path)
    return files.exists(place)
