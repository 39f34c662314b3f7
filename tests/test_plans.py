"""What the physical plans must and must not hold."""

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from pixelframe import storage
from pixelframe.operators import audit, labels, pixels, profile, sampling
from pixelframe.plans import checks
from pixelframe.plans.checks import raster_checks, standins
from pixelframe.plans.jobs import in_even_ranges
from pixelframe.schemas import PATCH_ARRAYS, PIXEL_BANDS, RADAR_BANDS
from pixelframe.sources import bands, files, rasters, sinks, tables
from pixelframe.storage import CHECKPOINT_DIR, materialize, shared_dir

SF_DIR = "/root/testdata/sf0.01"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    df.collect()
    return plan(df)


def test_narrow_schema_prunes_the_scan(spark):
    text = plan(checks.QUERIES["scan_pruned"](spark, SF_DIR))
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_totalprice:double>" in text


def test_split_filter_prunes_directories(spark, tmp_path):
    orders = standins.table(spark, SF_DIR, "orders")
    sinks.write_table(orders, str(tmp_path / "o"), ["o_orderstatus"])
    stored = tables.read_table(spark, str(tmp_path / "o"))
    text = plan(sampling.split_rows(stored, "F", "o_orderstatus"))
    assert "PartitionFilters: [isnotnull(o_orderstatus" in text


def test_rejects_are_pruned(spark, tmp_path):
    rows = standins.pixel_rows(spark, SF_DIR).withColumn("error", F.lit(None).cast("string"))
    sinks.write_pixels(rows, str(tmp_path / "p"))
    text = plan(sinks.read_pixels(spark, str(tmp_path / "p")).where("split = 'test'").select("NIR"))
    assert "isnotnull(state" in text and "ReadSchema: struct<NIR:bigint>" in text


@pytest.mark.parametrize("name", ["pixels_zip", "pixel_features", "path_columns", "band_files", "hash_split"])
def test_row_operators_are_narrow_and_stay_in_the_jvm(spark, name):
    text = plan(checks.QUERIES[name](spark, SF_DIR))
    assert "Exchange" not in text and "Python" not in text and "Arrow" not in text


def test_explode_reads_only_the_bands_it_needs(spark, tmp_path):
    standins.band_arrays(spark, SF_DIR, "vec_id").write.parquet(str(tmp_path / "a"))
    arrays = spark.read.parquet(str(tmp_path / "a"))
    text = plan(pixels.explode_pixels(arrays, ["VV", "NIR"]))
    assert "ReadSchema: struct<VV:array<double>,NIR:array<double>>" in text


def test_small_dictionary_is_broadcast(spark):
    text = final_plan(checks.QUERIES["label_recode"](spark, SF_DIR))
    assert "BroadcastHashJoin" in text


def test_large_dictionary_is_not_broadcast(spark, tmp_path):
    dictionary = spark.range(300_000).select(
        F.col("id").cast("string").alias("ID"), F.col("id").cast("string").alias("ID_NEW")
    )
    dictionary.write.parquet(str(tmp_path / "d"))
    rows = standins.table(spark, SF_DIR, "lineitem").withColumnRenamed("l_partkey", "label")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100KB")
    try:
        text = plan(labels.recode_labels(rows, spark.read.parquet(str(tmp_path / "d"))))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in text and "Broadcast" not in text


def test_counts_are_aggregated_before_the_shuffle(spark):
    found = standins.table(spark, SF_DIR, "lineitem").select(
        F.col("l_orderkey").alias("patch_id"), F.col("l_returnflag").alias("sensor")
    )
    text = plan(audit.count_files(found))
    assert "partial_count" in text and text.count("Exchange") == 1 and "Python" not in text


def test_audit_join_starts_from_plain_shuffles(spark):
    """Both sides of the join are shuffles of scans, which adaptive execution can split."""
    patches = standins.table(spark, SF_DIR, "orders").select(F.col("o_orderkey").alias("patch_id"))
    found = standins.table(spark, SF_DIR, "lineitem").select(
        F.col("l_orderkey").alias("patch_id"), F.lit("s2").alias("sensor")
    )
    counts = materialize(audit.count_files(found), "test-counts")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        text = plan(audit.incomplete_patches(patches, counts))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in text and "HashAggregate" not in text


@contextmanager
def small_skew_limits(spark):
    """No broadcast, and partitions of a few kilobytes count as large."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
    }
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k in settings:
            spark.conf.unset(k)


def half_in_one(key: str, n: int):
    """A key that holds half of the rows, and a payload."""
    value = F.when(F.col("id") < n // 2, 0).otherwise(F.col("id"))
    return value.alias(key), F.hex(F.xxhash64("id")).alias("payload")


def test_skewed_catalogue_key_is_split(spark):
    """A patch that holds most catalogue rows does not end in one task."""
    n = 400_000
    files_per_sensor = [F.lit(1).alias(c) for c in audit.COUNT_COLUMNS.values()]
    counts = materialize(
        spark.range(n).select(F.col("id").alias("patch_id"), *files_per_sensor), "skew-counts"
    )
    stored = materialize(spark.range(n).select(*half_in_one("patch_id", n)), "skew-catalog")
    with small_skew_limits(spark):
        result = audit.incomplete_patches(stored, counts).agg(F.count("*"), F.max("payload"))
        assert result.collect()[0][0] == n
        assert "skew=true" in plan(result)


def test_skewed_label_is_split(spark):
    """A class that holds most pixels is no hot task when the dictionary is not broadcast."""
    n = 400_000
    codes = spark.range(n).select(
        F.col("id").cast("string").alias("ID"), (F.col("id") + 1).cast("string").alias("ID_NEW")
    )
    dictionary = materialize(codes, "skew-dictionary")
    stored = materialize(spark.range(n).select(*half_in_one("label", n)), "skew-pixels")
    with small_skew_limits(spark):
        result = labels.recode_labels(stored, dictionary).agg(F.count("*"), F.max("payload"))
        assert result.collect()[0][0] == n
        assert "skew=true" in plan(result)


def test_first_rows_keep_only_the_top_in_each_task(spark):
    assert "TakeOrderedAndProject" in plan(checks.QUERIES["first_n"](spark, SF_DIR))


def test_share_counts_the_table_once(spark):
    text = final_plan(profile.split_share(standins.table(spark, SF_DIR, "orders"), "o_orderstatus"))
    assert "Window" not in text and "CartesianProduct" not in text


def test_inventory_does_not_read_contents(spark, tmp_path):
    (tmp_path / "a.tif").write_bytes(b"x")
    assert "ReadSchema: struct<path:string,length:bigint>" in plan(files.scan_files(spark, str(tmp_path)))


def test_listing_groups_directories(spark, tmp_path):
    for i in range(100):
        (tmp_path / str(i)).mkdir()
        (tmp_path / str(i) / "a.tif").write_bytes(b"x")
    setting = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(setting)
    spark.sparkContext.setJobGroup("listing", "listing")
    assert files.scan_files(spark, str(tmp_path)).count() == 100
    assert spark.conf.get(setting) == before
    tracker = spark.sparkContext.statusTracker()
    stages = [
        tracker.getStageInfo(stage)
        for job in tracker.getJobIdsForGroup("listing")
        for stage in tracker.getJobInfo(job).stageIds
    ]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < max(s.numTasks for s in stages if s) <= 64


def test_shared_folder_is_the_one_the_session_names(spark):
    assert shared_dir(spark) == spark.conf.get(CHECKPOINT_DIR)
    df = materialize(spark.range(3).toDF("x"), "probe")
    assert df.inputFiles()[0].removeprefix("file://").startswith(shared_dir(spark))
    assert sorted(r.x for r in df.collect()) == [0, 1, 2]


def test_copies_of_one_patch_are_spread_over_decode_tasks(spark):
    copies = F.when(F.col("id") % 2 == 0, "p").otherwise(F.col("id").cast("string"))
    catalog = spark.range(4000).select(copies.alias("patch_id"), F.lit("train").alias("split"))
    ranges = in_even_ranges(catalog, 250)
    assert "REPARTITION_BY_NUM" in plan(ranges)
    report = sampling.partition_report(ranges).first()
    assert report.rows == 4000 and report.partitions > 12 and report.max_rows < 2 * 250


def test_a_dominant_value_is_written_by_many_tasks(spark, tmp_path):
    rows = spark.range(300_000).select(
        F.hex(F.xxhash64("id")).alias("payload"),
        F.when(F.col("id") % 10 == 0, "b").otherwise("a").alias("split"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "500KB")
    try:
        sinks.write_table(rows, str(tmp_path / "t"), ["split"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "t" / "split=a").glob("*.parquet"))) > 4
    assert spark.read.parquet(str(tmp_path / "t")).count() == 300_000


def test_open_writers_are_set_for_the_write_only(spark, tmp_path):
    rows = spark.range(100).select("id", (F.col("id") % 3).alias("split"))
    setting = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(setting)
    with storage.unsorted_writes(spark):
        assert int(spark.conf.get(setting)) == storage.OPEN_WRITERS
        rows.write.partitionBy("split").parquet(str(tmp_path / "t"))
    assert spark.conf.get(setting) == before
    assert spark.read.parquet(str(tmp_path / "t")).count() == 100


def test_decoding_and_exploding_share_a_stage(spark):
    """From the catalogue's shuffle on, nothing is exchanged again."""
    contents = raster_checks.band_contents(spark, SF_DIR)
    decoded = rasters.decode_patches(contents, ["vec_id"])
    text = plan(pixels.explode_pixels(decoded, keep=["vec_id", "error"], outer=True))
    assert "Exchange" not in text
    generate = next(line for line in text.splitlines() if "Generate posexplode" in line)
    assert "*(" in generate.split("Generate")[0]


def test_bucketed_bands_join_without_exchange(spark, tmp_path):
    rows = [(f"p{i}", b, *[[float(b)] if s in RADAR_BANDS else [b] for s in PIXEL_BANDS]) for i in range(40) for b in (0, 1)]
    schema = StructType([StructField("patch_id", StringType()), StructField("first_pixel", LongType()), *PATCH_ARRAYS.fields])
    bands.write_bands(spark.createDataFrame(rows, schema), str(tmp_path), "plan_bands", ["patch_id"], 4)
    joined = bands.join_bands(spark, "plan_bands", ["patch_id"])
    assert joined.count() == 80
    text = plan(joined)
    assert "Exchange" not in text and text.count("SortMergeJoin") == len(PIXEL_BANDS) - 1
