"""Completeness audit: files per patch and sensor against what a patch must have."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pixelframe.functions.paths import directory_of, location
from pixelframe.schemas import COMPLETE_FILES
from pixelframe.sources.files import SENSOR_PATHS

COUNT_COLUMNS = {"s2": "ns2bands", "s1": "ns1bands", "label": "nlabelbands"}


def count_files(
    files: DataFrame,
    key: str = "patch_id",
    sensor: str = "sensor",
    columns: Mapping[str, str] = COUNT_COLUMNS,
) -> DataFrame:
    """Files per key and sensor, one row per key.

    One aggregation with a conditional count per sensor: rows are counted on the
    map side first, so a key that holds most files costs one row per task.
    """
    return files.groupBy(key).agg(
        *[
            F.count(F.when(F.col(sensor) == name, 1)).cast("int").alias(column)
            for name, column in columns.items()
        ]
    )


def with_file_counts(
    catalog: DataFrame,
    counts: DataFrame,
    key: str = "patch_id",
    columns: Mapping[str, str] = COUNT_COLUMNS,
) -> DataFrame:
    """Catalogue rows with their counts; a patch without files counts 0."""
    joined = catalog.join(counts, key, "left")
    return joined.withColumns({c: F.coalesce(c, F.lit(0)) for c in columns.values()})


def is_incomplete(
    expected: Mapping[str, int] = COMPLETE_FILES, columns: Mapping[str, str] = COUNT_COLUMNS
) -> Column:
    """True when any sensor has another number of files than expected."""
    condition = F.lit(False)
    for sensor, n in expected.items():
        condition = condition | (F.col(columns[sensor]) != n)
    return condition


def incomplete_patches(
    catalog: DataFrame,
    counts: DataFrame,
    key: str = "patch_id",
    expected: Mapping[str, int] = COMPLETE_FILES,
    columns: Mapping[str, str] = COUNT_COLUMNS,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Catalogue rows of incomplete patches with their counts."""
    rows = catalog if keep is None else catalog.select(*keep)
    return with_file_counts(rows, counts, key, columns).where(is_incomplete(expected, columns))


def _above(directory: str) -> Column:
    """A location and all directories above it."""
    parts = F.split(directory, "/")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))


def count_by_directory(files: DataFrame, path: str = "path") -> DataFrame:
    """Files below each directory of an inventory; a location as ``with_directory_counts`` expects.

    Nested files count for all directories above them, as when these are listed.
    One location is one row, whatever scheme its paths are written with. Files are
    summed up by their own directory first, so few rows go up the tree.
    """
    own = files.groupBy(location(directory_of(path)).alias("__own")).agg(F.count(F.lit(1)).alias("files"))
    spread = own.select(F.explode(_above("__own")).alias("directory"), "files")
    return spread.groupBy("directory").agg(F.sum("files").alias("files"))


def inventory_delta(before: DataFrame, after: DataFrame, path: str = "path", length: str = "length") -> DataFrame:
    """(location, change, old_length, new_length) of files added, removed or of another length.

    Two snapshots are merged by location, whatever schemes they are written with;
    each has a file once.
    """
    old = before.select(location(path).alias("location"), F.col(length).alias("old_length"), F.lit(True).alias("__old"))
    new = after.select(location(path).alias("location"), F.col(length).alias("new_length"), F.lit(True).alias("__new"))
    change = F.when(F.col("__old").isNull(), "added").when(F.col("__new").isNull(), "removed")
    same = F.col("old_length").eqNullSafe(F.col("new_length"))
    merged = old.join(new, "location", "full").withColumn("change", F.coalesce(change, F.when(~same, "changed")))
    return merged.where("change is not null").select("location", "change", "old_length", "new_length")


def updated_counts(counts: DataFrame, delta: DataFrame) -> DataFrame:
    """Files below each directory after ``delta``; directories that hold none any more go."""
    step = F.when(F.col("change") == "added", 1).when(F.col("change") == "removed", -1).otherwise(0).cast("long")
    own = delta.groupBy(location(directory_of("location")).alias("__own")).agg(F.sum(step).alias("files"))
    spread = own.where("files <> 0").select(F.explode(_above("__own")).alias("directory"), "files")
    summed = counts.select("directory", "files").unionByName(spread).groupBy("directory").agg(F.sum("files").alias("files"))
    return summed.where("files <> 0")


def updated_audit(
    catalog: DataFrame,
    previous: DataFrame,
    counts: DataFrame,
    delta: DataFrame,
    key: str = "patch_id",
    expected: Mapping[str, int] = COMPLETE_FILES,
    paths: Mapping[str, str] = SENSOR_PATHS,
) -> DataFrame:
    """The audit after ``delta``: patches above a change are counted anew, the others keep what ``previous`` says.

    ``counts`` are those after the change. ``previous`` has the catalogue's columns
    and a count per sensor; ``key`` names a catalogue row.
    """
    moved = delta.where("change <> 'changed'").select(location(directory_of("location")).alias("__own")).distinct()
    touched = moved.select(F.explode(_above("__own")).alias("__directory")).distinct()
    sides = catalog.select(F.col(key).alias("__key"), F.explode(F.array(*(location(p) for p in paths.values()))).alias("__side"))
    keys = sides.join(touched, F.col("__side") == F.col("__directory"), "left_semi").select("__key").distinct()
    anew = catalog.join(keys, F.col(key).eqNullSafe(F.col("__key")), "left_semi")
    found = with_directory_counts(anew, counts, paths=paths).where(is_incomplete(expected))
    kept = previous.join(keys, F.col(key).eqNullSafe(F.col("__key")), "left_anti")
    return kept.unionByName(found)


def with_directory_counts(
    catalog: DataFrame,
    counts: DataFrame,
    columns: Mapping[str, str] = COUNT_COLUMNS,
    paths: Mapping[str, str] = SENSOR_PATHS,
) -> DataFrame:
    """Catalogue rows with the number of files in each of their directories.

    The directories of a row become rows of their own, meet the counts in one
    join and are summed back, so the catalogue is joined once and not per sensor.
    Equal catalogue rows have equal counts: they are one group, told apart again at the end.
    """
    row = catalog.select(F.struct(*catalog.columns).alias("__row"))
    sides = F.array(
        *(
            F.struct(F.lit(s).alias("sensor"), location(F.col(f"__row.{p}")).alias("directory"))
            for s, p in paths.items()
        )
    )
    spread = row.select("*", F.explode(sides).alias("__side"))
    joined = spread.join(counts, spread["__side.directory"] == counts["directory"], "left")
    per_row = joined.groupBy("__row").agg(
        F.expr(f"count(1) div {len(paths)}").alias("__copies"),
        *(
            F.coalesce(F.max(F.when(F.col("__side.sensor") == s, F.col("files"))), F.lit(0)).cast("int").alias(columns[s])
            for s in paths
        ),
    )
    copies = per_row.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), "__copies")))
    return copies.select("__row.*", *(columns[s] for s in paths))
