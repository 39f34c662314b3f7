"""Jobs and stages on real raster files."""

import struct
import tracemalloc
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from fixtures import SIDE, band_pixels, ids, metadata, write_store
from hypothesis import given, settings
from hypothesis import strategies as st
from hypothesis.extra import numpy as npst
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from pixelframe.operators import catalog, models
from pixelframe.operators.labels import land_cover_dictionary
from pixelframe.operators.stages import (
    FeatureAssembler,
    IndexBuilder,
    LabelRecoder,
    PixelExploder,
    PixelExtractor,
)
from pixelframe.plans import jobs
from pixelframe.schemas import CATALOG, FEATURE_COLUMNS, PIXEL, PIXEL_BANDS, PIXEL_ORDER
from pixelframe.plans.checks.raster_files import write_tiff
from pixelframe.sources import files, rasters, sinks, tables, tiff

N = 8


@pytest.fixture(scope="module")
def store(tmp_path_factory):
    root = tmp_path_factory.mktemp("store")
    write_store(root, N)
    return root


@pytest.fixture(scope="module")
def catalog_path(spark, store, tmp_path_factory):
    work = tmp_path_factory.mktemp("work")
    metadata(spark, N).write.parquet(str(work / "metadata"))
    jobs.catalog_job(spark, str(work / "metadata"), str(work / "catalog"), f"file://{store}")
    return str(work / "catalog")


@pytest.fixture(scope="module")
def dictionary_path(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("codes") / "csv")
    land_cover_dictionary(spark).write.csv(path, header=True)
    return path


def expected_pixels(patches=range(N)):
    rows = []
    for i in patches:
        bands = {b: band_pixels(i, b).reshape(-1) for b in PIXEL_BANDS}
        for p in range(SIDE * SIDE):
            rows.append((ids(i)[0], *[bands[b][p].item() for b in PIXEL_BANDS]))
    return sorted(rows)


def stored_pixels(df):
    return sorted(tuple(r) for r in df.select("patch_id", *PIXEL_BANDS).collect())


# Rasters

SHAPES = npst.array_shapes(min_dims=2, max_dims=2, max_side=7)


@settings(max_examples=60, deadline=None)
@given(
    st.sampled_from([np.uint8, np.uint16, np.int16, np.uint32, np.float32, np.float64]).flatmap(
        lambda t: npst.arrays(t, SHAPES, elements={"allow_nan": False} if t in (np.float32, np.float64) else None)
    ),
    st.booleans(),
)
def test_tiff_roundtrip(pixels, deflate):
    read = tiff.read_tiff(write_tiff(pixels, deflate))
    assert read.dtype == pixels.dtype and np.array_equal(read, pixels)


@settings(max_examples=300, deadline=None)
@given(st.data(), st.booleans())
def test_damaged_tiff_raises_only_data_errors(data, deflate):
    content = bytearray(write_tiff(np.arange(12, dtype=np.uint16).reshape(3, 4), deflate))
    for _ in range(data.draw(st.integers(1, 4))):
        content[data.draw(st.integers(0, len(content) - 1))] = data.draw(st.integers(0, 255))
    try:
        tiff.read_tiff(bytes(content[: data.draw(st.integers(0, len(content)))]))
    except (ValueError, struct.error, zlib.error):
        pass


@pytest.mark.parametrize("content", [b"", b"unused", b"II*\0" + bytes(4), b"MM\0*" + bytes(8)])
def test_bad_tiff_is_a_reject(spark, content):
    good = write_tiff(np.ones((2, 2), np.uint16))
    row = ("p", *[bytearray(content if b == "G" else good) for b in PIXEL_BANDS])
    schema = "id string, " + ", ".join(f"{b} binary" for b in PIXEL_BANDS)
    decoded = rasters.decode_patches(spark.createDataFrame([row], schema), ["id"]).first()
    assert decoded.error and decoded.VH == [] and decoded.id == "p"


def test_uneven_and_missing_bands_are_rejects(spark):
    small = bytearray(write_tiff(np.ones((2, 2), np.uint16)))
    large = bytearray(write_tiff(np.ones((3, 2), np.uint16)))
    schema = "id string, " + ", ".join(f"{b} binary" for b in PIXEL_BANDS)
    rows = [
        ("uneven", *[large if b == "R" else small for b in PIXEL_BANDS]),
        ("missing", *[None if b == "VV" else small for b in PIXEL_BANDS]),
        ("good", *[small for _ in PIXEL_BANDS]),
    ]
    decoded = {r.id: r for r in rasters.decode_patches(spark.createDataFrame(rows, schema), ["id"]).collect()}
    assert "differ" in decoded["uneven"].error
    assert decoded["missing"].error == "missing bands: VV"
    assert decoded["good"].error is None and decoded["good"].VH == [1.0] * 4


def test_large_rasters_come_in_blocks(spark):
    data = np.arange(35, dtype=np.uint16).reshape(5, 7)
    content = bytearray(write_tiff(data))
    schema = "id string, " + ", ".join(f"{b} binary" for b in PIXEL_BANDS)
    df = spark.createDataFrame([("p", *[content for _ in PIXEL_BANDS])], schema)
    rows = rasters.decode_patches(df, ["id"], block_pixels=10).orderBy("first_pixel").collect()
    assert [r.first_pixel for r in rows] == [0, 10, 20, 30]
    assert [v for r in rows for v in r.NIR] == list(range(35))


@settings(max_examples=60, deadline=None)
@given(SHAPES, st.booleans(), st.integers(1, 8), st.integers(1, 40))
def test_runs_of_strips(shape, deflate, strip_rows, run_bytes):
    pixels = np.arange(shape[0] * shape[1], dtype=np.uint16).reshape(shape)
    content = write_tiff(pixels, deflate, strip_rows)
    band = tiff.open_tiff(pa.BufferReader(content), run_bytes)
    assert band.shape == shape and np.array_equal(np.concatenate(list(band.runs)), pixels)


def decoded_blocks(paths, block_pixels):
    def find():
        return {b: pa.memory_map(p) for b, p in paths.items()}

    each = lambda do, items: [do(i) for i in items]
    return rasters._patch_rows(find, tiff.open_tiff, each, block_pixels)


@pytest.mark.parametrize("strip_rows", [None, 100])
def test_decode_memory_is_that_of_a_block(tmp_path, strip_rows):
    """Seven bands of four million pixels would take 224 MB decoded whole."""
    side, block = 2000, 1 << 16
    data = np.random.default_rng(1).integers(0, 9, (side, side)).astype(np.uint16)
    paths = {}
    for k, b in enumerate(PIXEL_BANDS):
        paths[b] = str(tmp_path / f"{b}.tif")
        (tmp_path / f"{b}.tif").write_bytes(write_tiff(data, k % 2 == 0, strip_rows))
    flat, seen = data.reshape(-1), 0
    tracemalloc.start()
    for start, arrays, error in decoded_blocks(paths, block):
        assert error is None and start == seen
        seen += len(arrays["R"])
        assert all(np.array_equal(v, flat[start:seen]) for v in arrays.values())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # A block and a run of each band, the latter as stored, widened and joined.
    assert seen == flat.size and peak < 7 * (3 * 8 * block + 12 * tiff.RUN_BYTES)


def test_large_raster_that_breaks_off_is_a_reject(tmp_path):
    """A patch gives all its pixels or none, though the first blocks could be read."""
    data = np.arange(4000, dtype=np.uint16).reshape(400, 10)
    paths = {b: str(tmp_path / f"{b}.tif") for b in PIXEL_BANDS}
    for b, path in paths.items():
        content = bytearray(write_tiff(data, True, 20))
        if b == "NIR":
            content[len(content) // 2 : len(content) // 2 + 40] = bytes(40)
        Path(path).write_bytes(content)
    rows = list(decoded_blocks(paths, 100))
    assert len(rows) == 1 and rows[0][2] and all(len(v) == 0 for v in rows[0][1].values())


def test_resumed_pixels_equal_one_run(spark, catalog_path, tmp_path):
    """A run fails in its second batch; the next decodes only what lacks, copies of a row included."""

    def stopping(content):
        raise RuntimeError("stopped")

    rows = spark.read.parquet(catalog_path)
    twice = str(tmp_path / "twice")
    rows.unionByName(rows.limit(2)).write.parquet(twice)
    whole, parts = str(tmp_path / "whole"), str(tmp_path / "parts")
    jobs.pixel_job(spark, twice, whole)
    expected = stored_pixels(sinks.read_pixels(spark, whole))
    batches = {"patches_per_task": 2, "tasks_per_commit": 1}
    left = jobs.resumable_pixel_job(spark, twice, parts, commits=1, **batches)
    assert 0 < left < N + 2
    held = sinks.committed(spark, parts).count()
    with pytest.raises(Exception, match="stopped"):
        jobs.resumable_pixel_job(spark, twice, parts, decoder=stopping, **batches)
    assert sinks.committed(spark, parts).count() == held
    assert sinks.drop_uncommitted(spark, parts) == 1
    assert jobs.resumable_pixel_job(spark, twice, parts, **batches) == 0
    assert stored_pixels(sinks.read_committed_pixels(spark, parts)) == expected
    before = sinks.committed(spark, parts).select("batch").distinct().count()
    assert jobs.resumable_pixel_job(spark, twice, parts, decoder=stopping, **batches) == 0
    assert sinks.committed(spark, parts).select("batch").distinct().count() == before
    assert sinks.committed(spark, parts).count() == N + 2


# Inventory


def test_scan_and_gather(spark, store):
    scanned = files.scan_files(spark, str(store))
    assert scanned.count() == 15 * N
    optical = files.scan_optical_files(spark, str(store))
    assert optical.count() == 4 * N
    stems = {r.stem for r in files.list_stems(spark, str(store / "Reference_Maps")).collect()}
    assert stems == {f"{ids(i)[0]}_reference_map" for i in range(N)}
    found = files.band_files(files.load_files(spark, str(store / "S2")).select("path", "content"))
    assert found.groupBy("band").count().count() == 4
    gathered = rasters.gather_bands(found, ["patch"]).first()
    assert gathered.B.endswith("_B02.tif") and gathered.VH is None


def test_non_recursive_load_finds_no_nested_file(spark, store):
    assert files.load_files(spark, str(store / "S2"), recursive=False).count() == 0


# Jobs


def test_catalog(spark, catalog_path, store):
    rows = tables.read_metadata(spark, catalog_path)
    assert rows.schema == CATALOG
    first = rows.where(F.col("patch_id") == ids(0)[0]).first()
    assert first.s2_path == f"file://{store}/S2/S2A_MSIL2A_T0/{ids(0)[0]}/"
    assert first.s1_path == f"file://{store}/S1/S1B_IW_GRDH_0/{ids(0)[1]}/"


def test_slim_catalog(spark, tmp_path):
    paths = [f"s3://store/{sensor}/p/" for sensor in ("s1", "s2", "label")]
    row = ("p", None, "train", None, "r", None, None, None, "p", "r", *paths)
    spark.createDataFrame([row], CATALOG).write.parquet(str(tmp_path / "catalog"))
    jobs.slim_catalog_job(spark, str(tmp_path / "catalog"), str(tmp_path / "slim"))
    assert spark.read.parquet(str(tmp_path / "slim")).first().asDict() == {
        "patch_id": "p",
        "split": "train",
        "patch_path_array": ["store/s1/p/", "store/s2/p/", "store/label/p/", "p"],
    }


def test_slim_catalog_rejects_other_schemes(spark, tmp_path):
    def row(name, radar):
        return (name, None, "train", None, "r", None, None, None, name, "r", radar, "s3://b/2/", "s3://b/l/")

    rows = [row("good", "s3://b/1/"), row("other", "gs://b/1/"), row("none", None)]
    spark.createDataFrame(rows, CATALOG).write.parquet(str(tmp_path / "catalog"))
    jobs.slim_catalog_job(spark, str(tmp_path / "catalog"), str(tmp_path / "slim"))
    assert [r.patch_id for r in spark.read.parquet(str(tmp_path / "slim")).collect()] == ["good"]
    rejects = spark.read.parquet(jobs.rejects_path(str(tmp_path / "slim"))).collect()
    assert {r.patch_id: r.reason for r in rejects} == {
        "other": "s1_path lacks s3://",
        "none": "s1_path is missing",
    }


def test_listed_inventory_binds_radar_directories(spark, store, catalog_path):
    rows = tables.read_table(spark, catalog_path)
    listed = files.list_root(spark, f"file://{store}")
    assert listed.count() == 15 * N
    assert files.list_root(spark, str(store), levels=0).count() == 15 * N
    gathered = rasters.gather_bands(files.bind_to_catalog(rows, listed, ["patch_id"]), ["patch_id"])
    decoded = rasters.decode_patches(gathered, ["patch_id"])
    assert decoded.where("error IS NOT NULL").count() == 0 and decoded.count() == N
    nothing = files.bind_to_catalog(rows, listed.where("false"), ["patch_id"])
    rejected = rasters.decode_patches(rasters.gather_bands(nothing, ["patch_id"]), ["patch_id"])
    assert rejected.where("error IS NOT NULL").count() == N


def test_list_root_with_spaces_hidden_files_and_no_root(spark, tmp_path):
    for name in ("a b/c%20d/e.tif", "a b/_temporary/f.tif", "a b/g.txt", ".h/i.tif", "j.tif"):
        path = tmp_path / "root" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"xy")
    for levels in (0, 1, 3):
        found = files.list_root(spark, f"file://{tmp_path}/root", levels=levels, tasks=2).collect()
        kept = {(r.path.split("/root/")[1], r.length) for r in found}
        assert kept == {("a b/c%20d/e.tif", 2), ("j.tif", 2)}
    assert files.list_root(spark, f"file://{tmp_path}/missing", tasks=2).count() == 0


@pytest.fixture(scope="module")
def damaged(spark, tmp_path_factory):
    """A store where patch 1 lacks a band, patch 2 its radar folder, patch 3 is catalogued twice."""
    work = tmp_path_factory.mktemp("damaged")
    write_store(work / "store", N)
    rows = metadata(spark, N)
    doubled = rows.unionAll(rows.where(F.col("patch_id") == ids(3)[0]))
    doubled.write.parquet(str(work / "metadata"))
    next((work / "store").glob(f"S2/*/{ids(1)[0]}/*_B03.tif")).unlink()
    for file in (work / "store").glob(f"S1/*/{ids(2)[1]}/*"):
        file.unlink()
    next((work / "store").glob(f"S1/*/{ids(2)[1]}")).rmdir()
    jobs.catalog_job(spark, str(work / "metadata"), str(work / "catalog"), f"file://{work}/store")
    return work


@pytest.mark.parametrize("source", ["list", "inventory"])
def test_audit(spark, damaged, tmp_path, source):
    inventory = files.scan_files(spark, str(damaged / "store")) if source == "inventory" else None
    jobs.audit_job(spark, str(damaged / "catalog"), str(tmp_path / "audit"), inventory=inventory)
    rows = spark.read.parquet(str(tmp_path / "audit")).collect()
    counts = {r.patch_id: (r.ns2bands, r.ns1bands, r.nlabelbands) for r in rows}
    assert counts == {ids(1)[0]: (11, 2, 1), ids(2)[0]: (12, 0, 1)}


def test_audit_of_first_patches(spark, damaged, tmp_path):
    jobs.audit_job(spark, str(damaged / "catalog"), str(tmp_path / "audit"), first=2)
    rows = spark.read.parquet(str(tmp_path / "audit")).collect()
    assert [r.patch_id for r in rows] == [sorted(ids(i)[0] for i in range(N))[1]]


@pytest.mark.parametrize("find", ["list", "name"])
def test_pixel_job(spark, catalog_path, tmp_path, find):
    jobs.pixel_job(spark, catalog_path, str(tmp_path / "pixels"), find=find, patches_per_task=3)
    pixels = sinks.read_pixels(spark, str(tmp_path / "pixels"))
    assert [(f.name, f.dataType) for f in pixels.schema] == [(f.name, f.dataType) for f in PIXEL]
    assert stored_pixels(pixels) == expected_pixels()
    assert sinks.read_rejects(spark, str(tmp_path / "pixels")).count() == 0
    assert pixels.where("split = 'train'").count() == N // 2 * SIDE * SIDE


@pytest.mark.parametrize("find", ["list", "name"])
def test_pixel_job_reports_rejects_and_keeps_copies(spark, damaged, tmp_path, find):
    jobs.pixel_job(spark, str(damaged / "catalog"), str(tmp_path / "pixels"), find=find)
    rejects = sinks.read_rejects(spark, str(tmp_path / "pixels")).collect()
    assert {r.patch_id: r.error for r in rejects} == {
        ids(1)[0]: "missing bands: G",
        ids(2)[0]: "missing bands: VH, VV",
    }
    stored = stored_pixels(sinks.read_pixels(spark, str(tmp_path / "pixels")))
    assert stored == expected_pixels([0, 3, 3, 4, 5, 6, 7])


def test_sampled_pixel_job(spark, catalog_path, tmp_path):
    jobs.pixel_job(spark, catalog_path, str(tmp_path / "pixels"), fraction=0.5, find="name")
    pixels = sinks.read_pixels(spark, str(tmp_path / "pixels"))
    assert 0 < pixels.select("patch_id").distinct().count() < N


def test_forest_job(spark, catalog_path, dictionary_path, tmp_path):
    jobs.pixel_job(spark, catalog_path, str(tmp_path / "pixels"))
    result = jobs.forest_job(spark, str(tmp_path / "pixels"), dictionary_path, numTrees=10)
    scores = {r.split: r for r in result.accuracy.collect()}
    assert set(scores) == {"train", "test"}
    labels = [r[-1] for r in expected_pixels() if r[-1] != 777]
    majority = max(labels.count(c) for c in set(labels)) / len(labels)
    assert scores["train"].accuracy > majority
    forest = result.model.stages[-1]
    assert forest.numFeatures == len(FEATURE_COLUMNS) and forest.numClasses == 100


def test_regression_job(spark):
    df = spark.range(400).select(
        F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 3 == 1, "b").otherwise("c").alias("kind"),
        (F.col("id") % 17).cast("int").alias("size"),
    )
    df = df.withColumn("CO2", 3.0 * F.col("size") + F.when(F.col("kind") == "a", 10.0).otherwise(0.0))
    result = jobs.regression_job(df, "CO2")
    assert result.rmse < 0.1
    assert result.predictions.count() < 400


# Stages


def test_stages_equal_the_job_and_survive_saving(spark, catalog_path, dictionary_path, tmp_path):
    train = tables.read_table(spark, catalog_path).where("split = 'train'")
    stages = [
        PixelExtractor(find="list", tasks=2),
        PixelExploder(),
        IndexBuilder(),
        LabelRecoder(path=dictionary_path),
        FeatureAssembler(),
        models.forest(numTrees=3),
    ]
    Pipeline(stages=stages).write().save(str(tmp_path / "pipeline"))
    model = Pipeline.load(str(tmp_path / "pipeline")).fit(train)
    model.write().save(str(tmp_path / "model"))
    loaded = PipelineModel.load(str(tmp_path / "model"))
    assert loaded.stages[0].getOrDefault("find") == "list"
    predicted = models.predict(loaded, train)
    known = [r for r in expected_pixels(range(0, N)) if r[-1] != 777]
    assert 0 < predicted.count() <= len(known)
    assert predicted.exceptAll(models.predict(model, train)).count() == 0


def test_extractor_gives_one_row_per_catalogue_row(spark, catalog_path):
    rows = tables.read_table(spark, catalog_path)
    twice = rows.unionAll(rows)
    for find in ("list", "name"):
        arrays = PixelExtractor(find=find).transform(twice)
        assert arrays.columns == ["patch_id", "split", "pixel_arrays"]
        assert arrays.count() == 2 * N
    pixels = PixelExploder(keep=["patch_id"]).transform(arrays.distinct())
    assert stored_pixels(pixels) == expected_pixels()


def test_extractor_takes_bundled_paths(spark, catalog_path):
    columns = ["split", "s1_path", "s2_path", "label_path"]
    rows = tables.read_table(spark, catalog_path).select(*columns)
    prepared = catalog.bundle_paths(catalog.strip_path_schemes(rows, scheme="file://"))
    extractor = PixelExtractor(keys=["split"], bundle="paths_array", scheme="file://")
    pixels = PixelExploder().transform(extractor.transform(prepared.select("split", "paths_array")))
    assert pixels.columns == list(PIXEL_ORDER)
    stored = sorted(tuple(r) for r in pixels.select(*PIXEL_BANDS).collect())
    assert stored == sorted(r[1:] for r in expected_pixels())


def test_tuning_prepares_the_data_once(spark):
    df = spark.range(120).select(
        (F.col("id") % 2).cast("bigint").alias("label"),
        (F.col("id") % 2 * 1.0 + F.rand(1)).alias("x"),
    )
    runs = spark.sparkContext.accumulator(0)

    class Counted(FeatureAssembler):
        def _transform(self, df):
            runs.add(1)
            return super()._transform(df)

    grid = {"numTrees": [2, 4], "maxDepth": [2]}
    tuned = models.tune_forest(
        df, [Counted()], models.forest(), models.accuracy_evaluator(), grid, folds=2
    )
    assert runs.value == 1
    assert len(tuned.search.avgMetrics) == 2 and max(tuned.search.avgMetrics) > 0.8
    assert models.predict(tuned.model, df).count() == 120
