"""Raster file inventory.

``list_root`` lists a root of any size in tasks, level by level. The functions that
take a catalogue list the directories of its patches inside the tasks and need no
shuffle; ``bind_to_catalog`` joins an inventory to a catalogue instead. ``scan_files``
and ``load_files`` use Spark's own file listing, for its file sources; the driver
then holds one entry per file, which suits up to some ten million of them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pixelframe.functions.paths import (
    band_of_file,
    directory_of,
    file_stem,
    is_pixel_file,
    location,
    parent_directory,
)
from pixelframe.schemas import (
    BAND_SUFFIX,
    LABEL,
    OPTICAL_FILE_GLOB,
    PIXEL_BANDS,
    RADAR_BANDS,
    RASTER_SUFFIX,
)
from pixelframe.sources.remote import TaskStorage
from pixelframe.storage import temporary_setting

SENSOR_PATHS = {"s2": "s2_path", "s1": "s1_path", "label": "label_path"}
LISTING_TASKS_PER_CORE = 8
_LIST_THREADS = 8
_LIST_CHUNK = 256
_LIST_ROWS = 4096

Listing = list[tuple[str, int]]


def load_files(
    spark: SparkSession,
    path: str | list[str],
    format: str = "binaryFile",
    suffix: str = RASTER_SUFFIX,
    recursive: bool = True,
) -> DataFrame:
    """Files below ``path`` whose name ends in ``suffix``, through any Spark file source."""
    return _load(spark, path, format, f"*{suffix}", recursive)


def _load(
    spark: SparkSession, path: str | list[str], format: str, glob: str, recursive: bool
) -> DataFrame:
    # Left alone, Spark starts a listing task for every single directory.
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    tasks = LISTING_TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    with temporary_setting(spark, name, min(tasks, int(spark.conf.get(name)))):
        return (
            spark.read.format(format)
            .option("recursiveFileLookup", str(recursive).lower())
            .option("pathGlobFilter", glob)
            .load(path)
        )


def scan_files(
    spark: SparkSession, path: str | list[str], glob: str = f"*{RASTER_SUFFIX}"
) -> DataFrame:
    """Path and length of every file that matches ``glob``; contents are not read."""
    return _load(spark, path, "binaryFile", glob, True).select("path", "length")


def scan_optical_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Files of the four optical bands; the glob drops the others while listing."""
    return scan_files(spark, path, OPTICAL_FILE_GLOB)


FOUND = "path string, length long, open boolean"


def _hidden(path: str, below: str) -> bool:
    """True for what Spark's listing skips: a name that starts with _ or a dot."""
    return any(part[:1] in ("_", ".") for part in path[len(below) :].split("/"))


def _listings(
    storage: TaskStorage, pool: ThreadPoolExecutor, directory: str, whole: bool
) -> Iterator[list[tuple[str, int, bool]]]:
    """What lies right in ``directory``; with ``whole`` all files below it.

    The directories below are listed some hundred at a time, so that a task never
    holds more than these listings and the names of directories still to be listed.
    """
    each = pool.map if storage.waits(directory) else map
    waiting = [directory]
    while waiting:
        several = waiting[-_LIST_CHUNK:]
        del waiting[-_LIST_CHUNK:]
        for inside, found in zip(several, each(storage.children, several)):
            shown = [f for f in found if not _hidden(f[0], inside)]
            if whole:
                waiting += [path for path, _, is_open in shown if is_open]
                shown = [f for f in shown if not f[2]]
            yield shown


def list_root(
    spark: SparkSession,
    root: str,
    suffix: str = RASTER_SUFFIX,
    levels: int = 2,
    tasks: int | None = None,
) -> DataFrame:
    """Path and length of every file below ``root``, listed in tasks.

    The directories of the first ``levels`` levels are rows that are spread over
    ``tasks`` before each next step; the last step lists what lies below them, one
    directory after the other.
    The driver sees the root alone.
    """
    tasks = tasks or LISTING_TASKS_PER_CORE * spark.sparkContext.defaultParallelism

    def step(whole: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            storage = TaskStorage()
            with ThreadPoolExecutor(_LIST_THREADS) as pool:
                for batch in batches:
                    still_open = batch.column("open")
                    yield batch.filter(pc.invert(still_open))
                    for directory in batch.filter(still_open).column("path").to_pylist():
                        for found in _listings(storage, pool, directory, whole):
                            kept = [f for f in found if f[2] or f[0].endswith(suffix)]
                            for start in range(0, len(kept), _LIST_ROWS):
                                columns = zip(*kept[start : start + _LIST_ROWS])
                                types = [pa.string(), pa.int64(), pa.bool_()]
                                arrays = [pa.array(c, t) for c, t in zip(columns, types)]
                                yield pa.RecordBatch.from_arrays(arrays, ["path", "length", "open"])

        return run

    rows = spark.createDataFrame([(root.rstrip("/"), 0, True)], FOUND)
    for _ in range(levels):
        rows = rows.mapInArrow(step(whole=False), FOUND).repartition(tasks)
    return rows.mapInArrow(step(whole=True), FOUND).select("path", "length")


def list_stems(spark: SparkSession, path: str, suffix: str = "") -> DataFrame:
    """File names below ``path``, cut at their first dot."""
    return list_root(spark, path, suffix).select(file_stem("path").alias("stem"))


def with_file_keys(files: DataFrame, path: str = "path") -> DataFrame:
    """Add the patch (parent directory) and the band that each path belongs to.

    Radar directories have names of their own, and names may repeat below several
    roots: ``bind_to_catalog`` is what brings the sensors of a patch together.
    """
    return files.withColumns({"patch": parent_directory(path), "band": band_of_file(path)})


def band_files(files: DataFrame, path: str = "path") -> DataFrame:
    """The files that pixels are made of, with their patch and band."""
    return with_file_keys(files.where(is_pixel_file(path)), path)


def sensor_of(band: str) -> str:
    if band in RADAR_BANDS:
        return "s1"
    return "label" if band == LABEL else "s2"


def bind_to_catalog(
    catalog: DataFrame,
    files: DataFrame,
    keys: Sequence[str],
    path: str = "path",
    keep: Sequence[str] = (),
) -> DataFrame:
    """``keys``, band and path of the files in the catalogue's directories.

    The three directories of a patch become rows and meet the files by location,
    whatever schemes the two sides are written with. A directory without a band file
    keeps one row without a band, so ``gather_bands`` reports the patch. ``keep``
    names columns of ``files`` to carry along.
    """
    band = band_of_file(path)
    sensor = F.when(band.isin(*RADAR_BANDS), "s1").when(band == LABEL, "label").otherwise("s2")
    located = files.where(is_pixel_file(path)).select(
        location(directory_of(path)).alias("__directory"),
        sensor.alias("__sensor"),
        band.alias("band"),
        F.col(path).alias("path"),
        *keep,
    )
    sides = F.array(
        *(
            F.struct(F.lit(s).alias("sensor"), location(c).alias("directory"))
            for s, c in SENSOR_PATHS.items()
        )
    )
    patches = catalog.select(*keys, F.explode(sides).alias("__side"))
    same = (patches["__side.directory"] == located["__directory"]) & (
        patches["__side.sensor"] == located["__sensor"]
    )
    return patches.join(located, same, "left").select(*keys, "band", "path", *keep)


def band_paths_by_name(catalog: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One path per patch and band, built from the naming rule; nothing is listed."""
    stem = {"s1": "s1_name", "s2": "patch_id", "label": "patch_id"}

    def path(band: str):
        sensor = sensor_of(band)
        directory = F.regexp_replace(SENSOR_PATHS[sensor], "/+$", "")
        name = F.lit(f"_{BAND_SUFFIX[band]}{RASTER_SUFFIX}")
        return F.concat(directory, F.lit("/"), F.col(stem[sensor]), name).alias(band)

    return catalog.select(*keys, *[path(b) for b in PIXEL_BANDS])


def _map_listings(
    df: DataFrame,
    directories: Sequence[str],
    fields: list[T.StructField],
    derive: Callable[[list[Listing]], list],
) -> DataFrame:
    """Add ``fields`` to each row, derived from the listings of its ``directories``.

    Listing waits on storage, so a task lists several directories at a time.
    """
    schema = T.StructType(df.schema.fields + fields)
    types = [pa.string() if f.dataType == T.StringType() else pa.int32() for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        storage = TaskStorage()
        with ThreadPoolExecutor(_LIST_THREADS) as pool:
            for batch in batches:
                for start in range(0, batch.num_rows, _LIST_CHUNK):
                    part = batch.slice(start, _LIST_CHUNK)
                    listings = []
                    for c in directories:
                        places = part.column(c).to_pylist()
                        each = pool.map if any(d and storage.waits(d) for d in places) else map
                        listings.append(list(each(lambda d: storage.list_files(d) if d else [], places)))
                    rows = [derive(list(row)) for row in zip(*listings)]
                    added = [pa.array(v, t) for v, t in zip(zip(*rows), types)]
                    yield pa.RecordBatch.from_arrays(
                        [*part.columns, *added], names=schema.fieldNames()
                    )

    return df.mapInArrow(run, schema)


def band_paths_by_listing(catalog: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One path per patch and band, found in the patch's directories.

    Bands are bound by file name, whatever the order of the listing. A band
    without a file is NULL; of several files for a band, the first in path
    order is taken.
    """
    sensors = list(SENSOR_PATHS)

    def derive(listings: list[Listing]) -> list[str | None]:
        found = dict(zip(sensors, listings))
        return [
            min(
                (
                    path
                    for path, _ in found[sensor_of(band)]
                    if path.endswith(f"_{BAND_SUFFIX[band]}{RASTER_SUFFIX}")
                ),
                default=None,
            )
            for band in PIXEL_BANDS
        ]

    columns = list(dict.fromkeys([*keys, *SENSOR_PATHS.values()]))
    fields = [T.StructField(b, T.StringType()) for b in PIXEL_BANDS]
    listed = _map_listings(catalog.select(*columns), list(SENSOR_PATHS.values()), fields, derive)
    return listed.select(*keys, *PIXEL_BANDS)


def count_listed_files(
    catalog: DataFrame, columns: Mapping[str, str], paths: Mapping[str, str] = SENSOR_PATHS
) -> DataFrame:
    """Add the number of files in each sensor's directory; a missing directory counts 0."""
    fields = [T.StructField(columns[sensor], T.IntegerType()) for sensor in paths]
    return _map_listings(catalog, list(paths.values()), fields, lambda ls: [len(x) for x in ls])
