"""Rasters."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pixelframe.operators import audit, models, pixels
from pixelframe.operators.stages import PixelExploder, PixelExtractor, stage_rejects
from pixelframe.plans import jobs
from pixelframe.plans.checks.raster_files import write_tiff
from pixelframe.plans.checks.registry import query
from pixelframe.plans.checks.standins import (
    COUNT_SCALE,
    PATCH_PIXELS,
    PATCH_SIDE,
    PIXELS_SQL,
    SPLIT_SQL,
    TURN,
    band_arrays,
    table,
    turned,
)
from pixelframe.schemas import OPTICAL_BANDS, PIXEL_BANDS, PIXEL_ORDER, RADAR_BANDS
from pixelframe.sources import bands, files, rasters, sinks
from pixelframe.sources.remote import TaskStorage
from pixelframe.storage import materialize, scratch_path


def _stored_values(band: str, values: np.ndarray) -> np.ndarray:
    if band in RADAR_BANDS:
        return values.astype(np.float32)
    return np.floor(np.abs(values) * COUNT_SCALE[band]).astype(np.uint16)


def _raster_of(band: str, values: np.ndarray) -> bytes:
    return write_tiff(_stored_values(band, values).reshape(PATCH_SIDE, PATCH_SIDE), band in OPTICAL_BANDS)


#: Patches that are encoded at a time.
ENCODED = 256


def band_contents(spark: SparkSession, sf_dir: str, tasks: int | None = None) -> DataFrame:
    """Patches with each band as the bytes of an 8 x 8 single-band TIFF.

    With ``tasks`` the vectors are spread over so many before they are encoded: a
    table of many patches may still be one file.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, ENCODED):
                batch = whole.slice(start, ENCODED)
                columns = [batch.column("vec_id")]
                for b in PIXEL_BANDS:
                    values = batch.column(b).flatten().to_numpy().reshape(-1, PATCH_PIXELS)
                    columns.append(pa.array([_raster_of(b, v) for v in values], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", *PIXEL_BANDS])

    schema = "vec_id bigint, " + ", ".join(f"{b} binary" for b in PIXEL_BANDS)
    return band_arrays(spark, sf_dir, "vec_id", tasks=tasks).drop("split").mapInArrow(encode, schema)


@query(
    "raster_decode",
    f"WITH {PIXELS_SQL} SELECT vec_id, pos, VH, VV, B, G, R, NIR, label FROM px",
)
def raster_decode(spark, sf_dir):
    return _decoded_pixels(spark, sf_dir, block_pixels=1 << 20)


@query(
    "raster_blocks",
    f"WITH {PIXELS_SQL} SELECT vec_id, pos, VH, VV, B, G, R, NIR, label FROM px",
)
def raster_blocks(spark, sf_dir):
    """The same pixels and positions where every raster comes in several blocks."""
    return _decoded_pixels(spark, sf_dir, block_pixels=10)


#: Patches that are laid below each other in one raster, and rows of its strips.
MOSAIC, STRIP_ROWS = 16, 3


def _stacked(band: str) -> Column:
    """A band's values of all patches of a mosaic, one after the other."""
    by = PIXEL_BANDS.index(band) * TURN
    return F.flatten(F.transform("rows", lambda row: turned(row["values"], by))).alias(band)


def _write_mosaics(batch: pa.RecordBatch, root: str, storage: TaskStorage) -> pa.RecordBatch:
    """Write the bands of a batch of mosaics, one mosaic at a time; their paths."""
    paths = {b: [] for b in PIXEL_BANDS}
    for i, mosaic in enumerate(batch.column("mosaic").to_pylist()):
        for b in PIXEL_BANDS:
            values = _stored_values(b, batch.column(b)[i].values.to_numpy(zero_copy_only=False))
            paths[b].append(f"{root}/{mosaic}_{files.BAND_SUFFIX[b]}.tif")
            content = write_tiff(values.reshape(-1, PATCH_SIDE), b in OPTICAL_BANDS, STRIP_ROWS)
            storage.write(paths[b][-1], content)
    columns = [batch.column("mosaic"), *(pa.array(paths[b], pa.string()) for b in PIXEL_BANDS)]
    return pa.RecordBatch.from_arrays(columns, ["mosaic", *PIXEL_BANDS])


def mosaic_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rasters of many patches, each band a file in strips: (mosaic, a path per band)."""
    root = scratch_path(spark, "mosaics")
    vectors = table(spark, sf_dir, "embeddings").withColumn("mosaic", F.expr(f"vec_id div {MOSAIC}"))
    # The vectors are what is shuffled; the bands are turned out of them where they are stacked.
    spread = vectors.repartition(spark.sparkContext.defaultParallelism, "mosaic")
    rows = F.array_sort(F.collect_list(F.struct("vec_id", F.col("embedding").cast("array<double>").alias("values"))))
    stacked = spread.groupBy("mosaic").agg(rows.alias("rows")).select("mosaic", *[_stacked(b) for b in PIXEL_BANDS])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        storage = TaskStorage()
        for batch in batches:
            yield _write_mosaics(batch, root, storage)

    written = stacked.mapInArrow(write, "mosaic bigint, " + ", ".join(f"{b} string" for b in PIXEL_BANDS))
    return materialize(written, "mosaic-paths")


@query(
    "raster_windows",
    f"""WITH {PIXELS_SQL} SELECT vec_id // {MOSAIC} AS mosaic, (vec_id % {MOSAIC}) * {PATCH_PIXELS} + pos AS pos,
      VH, VV, B, G, R, NIR, label FROM px""",
)
def raster_windows(spark, sf_dir):
    """Large rasters in strips, read by ranges of their files: seven bands in step, a block at a time."""
    decoded = rasters.decode_patches(mosaic_paths(spark, sf_dir), ["mosaic"], block_pixels=100)
    return pixels.explode_pixels(decoded, keep=["mosaic"], position="pos", offset=rasters.FIRST_PIXEL)


@query(
    "bucketed_bands",
    f"WITH {PIXELS_SQL} SELECT vec_id, pos, VH, VV, B, G, R, NIR, label FROM px",
)
def bucketed_bands(spark, sf_dir):
    """Decoded blocks stored as a bucketed table per band, named anew and joined without a shuffle."""
    path, name = scratch_path(spark, "bands"), f"bands_{uuid.uuid4().hex}"
    contents = band_contents(spark, sf_dir, spark.sparkContext.defaultParallelism)
    decoded = materialize(rasters.decode_patches(contents, ["vec_id"], block_pixels=24), "decoded-blocks")
    bands.write_bands(decoded, path, name, ["vec_id"], 4)
    bands.register_bands(spark, path, f"{name}_again", ["vec_id"], 4)
    joined = bands.join_bands(spark, f"{name}_again", ["vec_id"])
    placed = pixels.explode_pixels(joined, keep=["vec_id"], position="pos", offset=rasters.FIRST_PIXEL)
    return placed.withColumn("pos", F.col("pos").cast("int"))


def _decoded_pixels(spark, sf_dir, block_pixels):
    # Encoding and decoding take longer than their small input suggests: spread the patches first.
    contents = band_contents(spark, sf_dir, spark.sparkContext.defaultParallelism)
    decoded = rasters.decode_patches(
        contents, ["vec_id"], block_pixels=block_pixels
    )
    placed = pixels.explode_pixels(
        decoded, keep=["vec_id"], position="pos", offset=rasters.FIRST_PIXEL
    )
    return placed.withColumn("pos", F.col("pos").cast("int"))


#: Radar files and directories have names of their own.
RADAR_NAME = "r"


def _band_path(root: str, patch: int, band: str) -> str:
    """Two roots hold directories of the same names: those of patches 2n and 2n + 1."""
    sensor = files.sensor_of(band)
    mark = RADAR_NAME if sensor == "s1" else ""
    stem = f"{mark}{patch}_{files.BAND_SUFFIX[band]}"
    return f"{root}/{patch % 2}/{sensor}/{mark}{patch // 2}/{stem}.tif"


BAND_PATH_SQL = """(vec_id % 2) || '/' || sensor || '/' || mark || (vec_id // 2) || '/'
  || mark || vec_id || '_' || suffix || '.tif'"""
BAND_VALUES_SQL = ", ".join(
    f"('{b}', '{files.BAND_SUFFIX[b]}', '{files.sensor_of(b)}', "
    f"'{RADAR_NAME if files.sensor_of(b) == 's1' else ''}')"
    for b in PIXEL_BANDS
)
BAND_NAMES_SQL = f"(VALUES {BAND_VALUES_SQL}) AS names(band, suffix, sensor, mark)"


def write_band_files(contents: DataFrame, root: str) -> DataFrame:
    """Write each band to a file of its own in the tasks."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        storage = TaskStorage()
        for batch in batches:
            for i, patch in enumerate(batch.column("vec_id").to_pylist()):
                for b in PIXEL_BANDS:
                    storage.write(_band_path(root, patch, b), batch.column(b)[i].as_buffer())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id")], names=["vec_id"])

    return contents.mapInArrow(write, "vec_id bigint")


def stored_root(spark: SparkSession, sf_dir: str) -> str:
    """A root with the band files of every patch."""
    root = scratch_path(spark, "rasters")
    # Writing waits on storage: spread it, however few partitions the table has.
    contents = band_contents(spark, sf_dir, spark.sparkContext.defaultParallelism)
    write_band_files(contents, root).agg(F.count("vec_id")).first()
    return root


def stored_catalog(spark: SparkSession, sf_dir: str, root: str | None = None) -> DataFrame:
    """The catalogue of the patches stored below ``root``, which is written where none is given."""
    root = root or stored_root(spark, sf_dir)
    name = F.col("vec_id").cast("string")

    def directory(sensor: str):
        mark = RADAR_NAME if sensor == "s1" else ""
        half = F.expr("vec_id div 2").cast("string")
        return F.concat(
            F.lit(f"{root}/"), (F.col("vec_id") % 2).cast("string"), F.lit(f"/{sensor}/{mark}"), half, F.lit("/")
        )

    return table(spark, sf_dir, "embeddings").select(
        name.alias("patch_id"),
        F.concat(F.lit(RADAR_NAME), name).alias("s1_name"),
        F.expr(SPLIT_SQL).alias("split"),
        *[directory(sensor).alias(path) for sensor, path in files.SENSOR_PATHS.items()],
    )


def bound_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Band files of a listed root, bound to the patches of its catalogue."""
    root = stored_root(spark, sf_dir)
    listed = files.list_root(spark, root)
    return files.bind_to_catalog(stored_catalog(spark, sf_dir, root), listed, ["patch_id"])


@query(
    "inventory_gather",
    f"SELECT vec_id::VARCHAR AS patch_id, band, {BAND_PATH_SQL} AS file FROM embeddings, {BAND_NAMES_SQL}",
)
def inventory_gather(spark, sf_dir):
    """Radar directories under other names and equal names below two roots find their patches."""
    inner = F.regexp_extract("path", r"/rasters-[0-9a-f]+/(.*)$", 1)
    return bound_files(spark, sf_dir).select("patch_id", "band", inner.alias("file"))


@query(
    "raster_files",
    f"WITH {PIXELS_SQL} SELECT vec_id, VH, VV, B, G, R, NIR, label FROM px",
)
def raster_files(spark, sf_dir):
    """Band files of a listed root, gathered by path per patch and read where they are decoded."""
    gathered = rasters.gather_bands(bound_files(spark, sf_dir), ["patch_id"])
    decoded = rasters.decode_patches(gathered, ["patch_id"])
    rows = pixels.explode_pixels(decoded, keep=["patch_id"])
    return rows.select(F.col("patch_id").cast("bigint").alias("vec_id"), *PIXEL_BANDS)


@query(
    "listed_stems",
    f"SELECT mark || vec_id || '_' || suffix AS stem FROM embeddings, {BAND_NAMES_SQL}",
)
def listed_stems(spark, sf_dir):
    """File names below a root, listed in tasks."""
    return files.list_stems(spark, stored_root(spark, sf_dir))


@query(
    "raster_stages",
    f"""WITH {PIXELS_SQL}
    SELECT vec_id::VARCHAR AS patch_id, split, VV, VH, B, G, R, NIR, label FROM px""",
)
def raster_stages(spark, sf_dir):
    """Catalogue rows to pixel rows: directories listed and rasters read in the tasks."""
    rows = stored_catalog(spark, sf_dir)
    tasks = spark.sparkContext.defaultParallelism
    stages = [PixelExtractor(find="list", tasks=tasks), PixelExploder(keep=["patch_id", "split"])]
    return models.fit(stages, rows).transform(rows)


@query(
    "pixel_resume",
    f"""WITH {PIXELS_SQL}
    SELECT vec_id::VARCHAR AS patch_id, split, VV, VH, B, G, R, NIR, label FROM px""",
)
def pixel_resume(spark, sf_dir):
    """A pixel table built by three runs, the first two of which stop early: every pixel once."""
    catalog, output = scratch_path(spark, "resume-catalog"), scratch_path(spark, "resume-pixels")
    stored_catalog(spark, sf_dir).write.parquet(catalog)
    batches = {"patches_per_task": 60, "tasks_per_commit": 2}
    for commits in (1, 2, None):
        jobs.resumable_pixel_job(spark, catalog, output, commits=commits, **batches)
    return sinks.read_committed_pixels(spark, output).select("patch_id", "split", *PIXEL_ORDER)


@query(
    "stage_rejects",
    "SELECT vec_id::VARCHAR AS patch_id, 'missing bands: VH, VV' AS error FROM embeddings WHERE label < 5",
)
def rejected_patches(spark, sf_dir):
    """Training patches that point to a radar directory that does not exist come out with a reason."""
    rows = stored_catalog(spark, sf_dir)
    lost = F.when(F.col("split") == "train", F.concat("s1_path", F.lit("gone/"))).otherwise(F.col("s1_path"))
    tasks = spark.sparkContext.defaultParallelism
    extracted = PixelExtractor(find="list", tasks=tasks).transform(rows.withColumn("s1_path", lost))
    return stage_rejects(extracted).select("patch_id", "error")


@query(
    "raster_names",
    f"""WITH {PIXELS_SQL}
    SELECT vec_id::VARCHAR AS patch_id, VH, VV, B, G, R, NIR, label FROM px""",
)
def raster_names(spark, sf_dir):
    """Catalogue rows to pixel rows, with paths built from the naming rule."""
    rows = stored_catalog(spark, sf_dir)
    paths_by_band = files.band_paths_by_name(rows, ["patch_id"])
    spread = paths_by_band.repartition(spark.sparkContext.defaultParallelism)
    return pixels.explode_pixels(rasters.decode_patches(spread, ["patch_id"]), keep=["patch_id"])


@query(
    "listed_audit",
    """SELECT vec_id::VARCHAR AS patch_id, 4::INTEGER AS ns2bands, 2::INTEGER AS ns1bands,
      1::INTEGER AS nlabelbands FROM embeddings""",
)
def listed_audit(spark, sf_dir):
    """Every stored patch lacks the eight optical bands that pixels do not need."""
    spread = stored_catalog(spark, sf_dir).repartition(spark.sparkContext.defaultParallelism)
    counted = files.count_listed_files(spread, audit.COUNT_COLUMNS)
    return counted.where(audit.is_incomplete()).select("patch_id", *audit.COUNT_COLUMNS.values())
