"""Rasters at size: work that is spread, memory that is bounded."""

import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import types as T

from fixtures import metadata, write_store
from pixelframe.plans import jobs
from pixelframe.plans.checks import raster_checks
from pixelframe.plans.checks.raster_files import write_tiff
from pixelframe.schemas import PIXEL_BANDS
from pixelframe.sources import files, rasters, remote, sinks, tiff

SF_DIR = "/root/testdata/sf0.001"


def jobs_of(spark, group, run):
    spark.sparkContext.setJobGroup(group, group)
    try:
        run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_small_batches_share_their_jobs(spark, tmp_path):
    """Each batch has a commit of its own, but twelve of them take no more jobs than three."""
    write_store(tmp_path / "store", 12)
    metadata(spark, 12).write.parquet(str(tmp_path / "metadata"))
    catalog = str(tmp_path / "catalog")
    jobs.catalog_job(spark, str(tmp_path / "metadata"), catalog, f"file://{tmp_path}/store")
    counted = {}
    for patches in (4, 1):
        output = str(tmp_path / f"pixels-{patches}")
        batches = {"patches_per_task": patches, "tasks_per_commit": 1}
        counted[patches] = jobs_of(
            spark, f"batches-of-{patches}", lambda: jobs.resumable_pixel_job(spark, catalog, output, **batches)
        )
        done = sinks.committed(spark, output)
        assert done.count() == 12 and done.select("batch").distinct().count() == 12 // patches
        assert sinks.read_committed_pixels(spark, output).count() == 12 * 16
    assert counted[1] <= counted[4] + 2


def test_rounds_stop_at_the_bound(spark, tmp_path, monkeypatch):
    """Several rounds, of which a run does only so many batches."""
    monkeypatch.setattr(jobs, "TASKS_PER_CORE", 2 / spark.sparkContext.defaultParallelism)
    write_store(tmp_path / "store", 6)
    metadata(spark, 6).write.parquet(str(tmp_path / "metadata"))
    catalog, output = str(tmp_path / "catalog"), str(tmp_path / "pixels")
    jobs.catalog_job(spark, str(tmp_path / "metadata"), catalog, f"file://{tmp_path}/store")
    batches = {"patches_per_task": 1, "tasks_per_commit": 1}
    assert jobs.resumable_pixel_job(spark, catalog, output, commits=3, **batches) == 3
    assert sinks.committed(spark, output).select("batch").distinct().count() == 3
    assert sinks.drop_uncommitted(spark, output) == 0
    assert jobs.resumable_pixel_job(spark, catalog, output, **batches) == 0
    assert sinks.read_committed_pixels(spark, output).count() == 6 * 16


def test_mosaics_are_written_one_at_a_time(tmp_path):
    """400 mosaics as Python numbers would take 90 MB."""
    values = np.random.default_rng(1).normal(size=400 * 1024)
    lists = pa.ListArray.from_arrays(pa.array(np.arange(401, dtype=np.int32) * 1024), pa.array(values))
    batch = pa.RecordBatch.from_arrays([pa.array(range(400)), *[lists for _ in PIXEL_BANDS]], ["mosaic", *PIXEL_BANDS])
    tracemalloc.start()
    paths = raster_checks._write_mosaics(batch, str(tmp_path), remote.TaskStorage())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert paths.num_rows == 400 and peak < 4 << 20
    content = (tmp_path / "399_VH.tif").read_bytes()
    assert np.array_equal(tiff.read_tiff(content).reshape(-1), values[-1024:].astype(np.float32))


class Captured:
    """Stands for a table; gives back the function that its tasks would run."""

    schema = T.StructType([T.StructField("id", T.LongType())] + [T.StructField(b, T.BinaryType()) for b in PIXEL_BANDS])

    def mapInArrow(self, run, schema):
        return run


def test_small_blocks_come_in_few_batches():
    content = write_tiff(np.arange(35, dtype=np.uint16).reshape(5, 7))
    columns = [pa.array([content] * 50, pa.binary()) for _ in PIXEL_BANDS]
    batch = pa.RecordBatch.from_arrays([pa.array(range(50)), *columns], ["id", *PIXEL_BANDS])
    (out,) = rasters.decode_patches(Captured(), ["id"], block_pixels=10)(iter([batch]))
    assert out.column("first_pixel").to_pylist() == [0, 10, 20, 30] * 50
    assert out.column("NIR").flatten().to_pylist() == list(range(35)) * 50


def test_contents_in_memory_are_decoded_without_threads():
    content = write_tiff(np.arange(35, dtype=np.uint16).reshape(5, 7))

    def threads(do, items):
        raise AssertionError("nothing waits")

    rows = rasters._patch_rows(lambda: {b: pa.BufferReader(content) for b in PIXEL_BANDS}, tiff.open_tiff, threads, 10)
    assert [start for start, _, _ in rows] == [0, 10, 20, 30]


def test_opener_is_looked_for_once():
    assert rasters.default_opener() is rasters.default_opener()


def test_vectors_are_spread_before_they_are_encoded(spark):
    contents = raster_checks.band_contents(spark, SF_DIR, 6)
    assert contents.rdd.getNumPartitions() == 6
    text = contents._jdf.queryExecution().executedPlan().toString()
    assert text.index("MapInArrow") < text.index("Exchange")


def test_directories_are_made_once_and_local_files_do_not_wait(monkeypatch, tmp_path):
    made = []

    storage = remote.TaskStorage()
    local = remote.pafs.LocalFileSystem()

    class Counting:
        def create_dir(self, path, recursive):
            made.append(path)
            local.create_dir(path, recursive=recursive)

        def open_output_stream(self, path):
            return local.open_output_stream(path)

    monkeypatch.setattr(storage, "_resolve", lambda uri: (Counting(), "", uri))
    for name in ("a/1", "a/2", "a/3", "b/1"):
        storage.write(f"{tmp_path}/{name}", b"x")
    assert made == [f"{tmp_path}/a", f"{tmp_path}/b"]
    assert not remote.TaskStorage().waits(f"file://{tmp_path}")


def test_listing_holds_some_hundred_directories(tmp_path):
    """What lies below a directory comes a directory at a time, long before all of it is listed."""
    for i in range(700):
        (tmp_path / str(i) / "in").mkdir(parents=True)
        for name in ("a.tif", "in/b.tif"):
            (tmp_path / str(i) / name).write_bytes(b"x")
    listed = []

    class Storage(remote.TaskStorage):
        def children(self, directory):
            listed.append(directory)
            return super().children(directory)

    with files.ThreadPoolExecutor(2) as pool:
        found = files._listings(Storage(), pool, str(tmp_path), True)
        sizes = [len(next(found)) for _ in range(10)]
        assert len(listed) <= 1 + files._LIST_CHUNK and max(sizes) == 1
        rest = sum(len(f) for f in found)
    assert sum(sizes) + rest == 1400 and len(listed) == 1401
