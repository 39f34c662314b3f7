import hashlib
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml import PipelineModel
from pyspark.ml.linalg import SparseVector
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pixelframe.operators import audit, catalog, categories, features, labels, models, pixels, profile, sampling
from pixelframe.schemas import LABEL_DICTIONARY_CSV
from pixelframe.sources import tables

SLOW = settings(
    max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


# Catalogue


def test_bundle_by_position_and_by_name(spark):
    df = spark.createDataFrame([("a", "b", "c")], "s1_path string, s2_path string, label_path string")
    by_position = catalog.unpack_paths(catalog.bundle_paths(df).select("paths_array"))
    assert by_position.first()[1:] == ("a", "b", "c")
    named = catalog.bundle_paths(df, named=True, output="paths").select("paths.label_path")
    assert named.first().label_path == "c"


def test_conform_reports_missing_columns(spark):
    with pytest.raises(ValueError, match="DESC"):
        tables.conform(spark.createDataFrame([("1", "2")], "ID string, ID_NEW string"), LABEL_DICTIONARY_CSV)


# Pixels


def test_explode_aligns_bands_within_each_patch(spark):
    df = spark.createDataFrame(
        [("p", [1, 2], [10, 20]), ("q", [3], [30]), ("r", [4], [40, 50]), ("s", None, [1]), ("t", [], [])],
        "id string, a array<int>, b array<int>",
    )
    rows = pixels.explode_pixels(df, ["a", "b"], keep=["id"], position="pos").collect()
    assert sorted(tuple(r) for r in rows) == [("p", 0, 1, 10), ("p", 1, 2, 20), ("q", 0, 3, 30)]
    assert {r.id for r in pixels.uneven_patches(df, ["a", "b"]).collect()} == {"r", "s"}


def test_explode_outer_keeps_patches_without_pixels(spark):
    df = spark.createDataFrame([("p", [], []), ("q", [1], [2])], "id string, a array<int>, b array<int>")
    rows = pixels.explode_pixels(df, ["a", "b"], keep=["id"], outer=True).collect()
    assert sorted(tuple(r) for r in rows if r.a is not None) == [("q", 1, 2)]
    assert [tuple(r) for r in rows if r.a is None] == [("p", None, None)]


@SLOW
@given(st.lists(st.lists(st.integers(-5, 5), max_size=6), min_size=1, max_size=5))
def test_every_pixel_is_a_row_once(spark, patches):
    df = spark.createDataFrame(
        [(i, values, [v * 2 for v in values]) for i, values in enumerate(patches)],
        "id int, a array<int>, b array<int>",
    )
    rows = pixels.explode_pixels(df, ["a", "b"], keep=["id"], position="pos").collect()
    expected = [(i, p, v, 2 * v) for i, values in enumerate(patches) for p, v in enumerate(values)]
    assert sorted(tuple(r) for r in rows) == expected


# Labels


def test_builtin_dictionary(spark):
    rows = labels.land_cover_dictionary(spark).collect()
    assert len(rows) == 45
    assert [int(r.ID_NEW) for r in rows] == [*range(1, 45), 99]
    assert [int(r.ID) for r in rows] == sorted(int(r.ID) for r in rows)


def test_dictionary_csv_with_bom_and_crlf(spark, tmp_path):
    path = tmp_path / "codes.csv"
    path.write_bytes("﻿ID,ID_NEW,DESC\r\n111,1,Urban\r\nx,2,Bad\r\n331,30,Dunes  sands\r\n".encode())
    dictionary = tables.read_label_dictionary(spark, str(path))
    assert dictionary.columns == ["ID", "ID_NEW", "DESC"]
    df = spark.createDataFrame([(111, 1.0), (331, 2.0), (5, 3.0), (None, 4.0)], "label bigint, v double")
    recoded = labels.recode_labels(df, dictionary)
    assert recoded.dtypes == [("label", "bigint"), ("v", "double")]
    assert sorted(tuple(r) for r in recoded.collect()) == [(1, 1.0), (30, 2.0)]


def test_dictionary_header_is_checked(spark, tmp_path):
    path = tmp_path / "codes.csv"
    path.write_text("CODE,NEW\n1,2\n")
    with pytest.raises(ValueError, match="CODE"):
        tables.read_label_dictionary(spark, str(path))


def test_unlabeled_pixels_can_be_dropped(spark):
    df = spark.createDataFrame([(999,), (523,)], "label bigint")
    dictionary = labels.land_cover_dictionary(spark)
    kept = labels.recode_labels(df, dictionary).collect()
    assert sorted(r.label for r in kept) == [44, 99]
    dropped = labels.recode_labels(df, dictionary, drop_unlabeled=True).collect()
    assert [r.label for r in dropped] == [44]


# Sampling


def test_sample_is_seeded_and_stratified(spark):
    df = spark.range(4000).select(
        "id", F.when(F.col("id") % 2 == 0, "train").otherwise("test").alias("split")
    )
    fractions = {"train": 1.0, "test": 0.1, "validation": 0.5}
    one = sampling.sample_by_split(df, fractions)
    assert one.exceptAll(sampling.sample_by_split(df, fractions)).count() == 0
    counts = {r.split: r["count"] for r in one.groupBy("split").count().collect()}
    assert counts["train"] == 2000 and 120 < counts["test"] < 280


@pytest.mark.parametrize("form", ["random", "hash"])
@pytest.mark.parametrize("fraction", [0.5, 1.0])
def test_sample_refuses_a_missing_split(spark, form, fraction):
    df = spark.createDataFrame([(1, "train"), (2, None)], "id int, split string")
    fractions = sampling.split_fractions(fraction)
    sample = (
        sampling.sample_by_split(df, fractions)
        if form == "random"
        else sampling.hash_sample_by_split(df, fractions, "id")
    )
    with pytest.raises(Exception, match="no sampling fraction for NULL"):
        sample.collect()


def test_directory_counts_join_once(spark):
    files = spark.createDataFrame(
        [("s3://b/x/1.tif",), ("s3a://b/x/old/2.tif",), ("s3://b/y/1.tif",), ("s3://b/yy/1.tif",)], "path string"
    )
    paths = {"s2": "a", "s1": "b", "label": "c"}
    row = ("p", "s3://b/x/", "s3a://b/y", None)
    catalog = spark.createDataFrame([row, row], "patch_id string, a string, b string, c string")
    counts = audit.count_by_directory(files)
    counted = audit.with_directory_counts(catalog, counts, paths=paths)
    assert [tuple(r) for r in counted.collect()] == [(*row, 2, 1, 0)] * 2
    assert counted._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1


def test_positions_go_on_from_block_to_block(spark):
    blocks = spark.createDataFrame(
        [(0, [1, 2, 3], [4, 5, 6]), (3, [7], [8])], "first long, a array<int>, b array<int>"
    )
    rows = pixels.explode_pixels(blocks, ["a", "b"], position="pos", offset="first").collect()
    assert sorted(tuple(r) for r in rows) == [(0, 1, 4), (1, 2, 5), (2, 3, 6), (3, 7, 8)]


@pytest.mark.parametrize("form", ["random", "hash"])
def test_sample_refuses_an_unknown_split(spark, form):
    df = spark.createDataFrame([(1, "val")], "id int, split string")
    fractions = sampling.split_fractions(0.5)
    sample = (
        sampling.sample_by_split(df, fractions)
        if form == "random"
        else sampling.hash_sample_by_split(df, fractions, "id")
    )
    with pytest.raises(Exception, match="no sampling fraction for val"):
        sample.collect()


@SLOW
@given(st.integers(1, 7), st.sampled_from([{"a": 1.0, "b": 1.0}, {"a": 0.5, "b": 0.25, "c": 0.25}]))
def test_hash_split_does_not_depend_on_partitions(spark, n, weights):
    df = spark.range(500)
    one = sampling.hash_split(df, "id", weights)
    other = sampling.hash_split(df.repartition(n), "id", weights)
    assert one.exceptAll(other).count() == 0


def test_hash_split_shares(spark):
    parts = sampling.hash_split(spark.range(20000), "id", {"a": 2, "b": 1, "c": 1})
    counts = {r.part: r["count"] / 20000 for r in parts.groupBy("part").count().collect()}
    assert abs(counts["a"] - 0.5) < 0.02 and abs(counts["b"] - 0.25) < 0.02
    assert abs(counts["c"] - 0.25) < 0.02


def test_random_split_is_whole(spark):
    train, test = sampling.random_split(spark.range(1000))
    assert train.count() + test.count() == 1000
    assert train.intersect(test).count() == 0


def test_random_parts(spark):
    df = spark.range(20000)
    parts = sampling.random_parts(df, {"train": 0.8, "test": 0.2})
    counts = {r.part: r["count"] / 20000 for r in parts.groupBy("part").count().collect()}
    assert abs(counts["train"] - 0.8) < 0.02 and abs(sum(counts.values()) - 1) < 1e-9
    again = sampling.random_parts(df, {"train": 0.8, "test": 0.2})
    assert parts.exceptAll(again).count() == 0


def test_partitions(spark):
    df = spark.range(300).select("id", (F.col("id") % 3).alias("split"))
    by_split = sampling.partition_report(sampling.hash_partition(df, 100, "split")).first()
    assert by_split.partitions == 100 and by_split.filled <= 3 and by_split.rows == 300
    by_key = sampling.partition_report(sampling.hash_partition(df, 10, "id")).first()
    assert by_key.partitions == 10


# Audit


def test_audit_counts(spark):
    files = spark.createDataFrame(
        [("a", "s2")] * 12 + [("a", "s1")] * 2 + [("a", "label")] + [("b", "s2")] * 11 + [("z", "s1")],
        "patch_id string, sensor string",
    )
    patches = spark.createDataFrame([("a",), ("b",), ("c",), ("b",)], "patch_id string")
    rows = audit.incomplete_patches(patches, audit.count_files(files)).collect()
    assert sorted(tuple(r) for r in rows) == [("b", 11, 0, 0), ("b", 11, 0, 0), ("c", 0, 0, 0)]


# Profile


def test_split_share_rounds(spark):
    df = spark.createDataFrame([("a",)] * 2 + [("b",)] + [(None,)], "split string")
    shares = {r.split: r.share for r in profile.split_share(df).collect()}
    assert shares == {"a": 0.67, "b": 0.33}


def test_column_summary_counts_nulls_and_odd_names(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "`a b` int, `c.d` string")
    rows = profile.column_summary(df).collect()
    assert [tuple(r) for r in rows] == [(0, "a b", "int", 2), (1, "c.d", "string", 1)]


# Features and models


def test_assembled_vectors_equal_the_assembler(spark):
    df = spark.createDataFrame(
        [(1, 0.0, 3), (2, 2.5, None), (3, math.inf, 0), (4, 0.0, 0)], "label bigint, x double, y bigint"
    )
    ours = features.assemble(df)
    theirs = features.assembler(["x", "y"]).transform(df).select("features", "label")
    assert ours.schema["features"].metadata == theirs.schema["features"].metadata
    assert [(r.label, r.features.toArray().tolist()) for r in ours.collect()] == [
        (r.label, r.features.toArray().tolist()) for r in theirs.collect()
    ]


def test_columns_by_type_leaves_the_label_out(spark):
    df = spark.createDataFrame([("x", 1, 2, 3.0, 4.0)], "s string, i int, l bigint, d double, CO2 double")
    assert features.columns_by_type(df, "CO2") == (["s"], ["i", "d"])
    wider = features.columns_by_type(df, "CO2", ("int", "bigint", "double"))
    assert wider == (["s"], ["i", "l", "d"])


def test_incomplete_rows_are_dropped_alike(spark):
    df = spark.createDataFrame(
        [(1, 1.0), (2, None), (3, math.nan), (4, 2.0)], "label int, x double"
    )
    assert [r.label for r in features.drop_incomplete(df, ["x"]).collect()] == [1, 4]
    assert [r.label for r in features.assemble(df).collect()] == [1, 4]


@SLOW
@given(st.lists(st.sampled_from("abcdefg"), min_size=1, max_size=40))
def test_distributed_index_equals_the_indexer(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "c string").repartition(3)
    model = features.category_indexer(["c"]).fit(df)
    expected = {v: float(i) for i, v in enumerate(model.labelsArray[0])}
    rows = features.index_categories(df, ["c"]).collect()
    assert len(rows) == len(values)
    assert all(expected[r.c] == r.c_index for r in rows)


def test_too_many_categories_raise(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("c"))
    with pytest.raises(features.TooManyCategories):
        features.check_categories(df, ["c"], 1000)
    features.check_categories(df, ["c"], 10000)


def test_grid_is_checked():
    with pytest.raises(ValueError, match="64"):
        models.check_grid({"maxDepth": [4, 64]})
    models.check_grid(models.FOREST_GRID)


def test_scores_equal_the_evaluators(spark):
    df = spark.createDataFrame(
        [(1.0, 1.0), (0.0, 1.0), (2.0, 2.0)], "label double, prediction double"
    )
    assert models.accuracy_by(df).first().accuracy == models.accuracy_evaluator().evaluate(df)
    rmse = df.agg(models.rmse_of("label").alias("x")).first().x
    assert rmse == pytest.approx(models.rmse_evaluator("label").evaluate(df))


# Categories


def category_rows(spark):
    rows = [("b", "x", 1.0), ("a", "x", 2.0), ("b", None, 4.0), (None, "y", 7.0), ("c", "x", 11.0), ("a", "y", 16.0)]
    return spark.createDataFrame(rows, "c string, d string, n double")


def test_wide_features_as_the_library(spark, tmp_path):
    """Same vectors as MLlib's indexer, encoder, scaler and assembler, also after saving."""
    train = category_rows(spark)
    other = spark.createDataFrame([("a", "new", 3.0), (None, "y", 0.0), ("zz", None, -1.0)], train.schema)
    library = models.fit(features.mixed_feature_stages(["c", "d"], ["n"]), train)
    index = categories.CategoryIndexer(inputCols=["c", "d"]).fit(train)
    wide = PipelineModel([index, categories.sparse_assembler(index, train, ["n"])])
    wide.save(str(tmp_path / "model"))
    loaded = PipelineModel.load(str(tmp_path / "model"))
    assert loaded.stages[0].uid == index.uid
    for rows in (train, other):
        expected = {tuple(r[:3]): r.features.toArray().tolist() for r in library.transform(rows).collect()}
        for model in (wide, loaded):
            got = model.transform(rows).collect()
            assert {tuple(r[:3]): r.features.toArray().tolist() for r in got} == expected
            assert all(isinstance(r.features, SparseVector) for r in got)
    estimator = categories.CategoryIndexer(inputCols=["c"], suffix="_code")
    estimator.save(str(tmp_path / "estimator"))
    again = categories.CategoryIndexer.load(str(tmp_path / "estimator")).fit(train)
    assert {(r.c, r.c_code) for r in again.transform(train).collect()} == {("a", 0.0), ("b", 1.0), ("c", 2.0), (None, 3.0)}


def test_missing_numbers(spark):
    rows = spark.createDataFrame([(0.0, 1.0), (1.0, None), (0.0, float("nan"))], "i double, n double")
    assembler = categories.SparseAssembler(indexCols=["i"], sizes=[1], numericCols=["n"], scales=[0.0], handleInvalid="skip")
    assert [r.features.toArray().tolist() for r in assembler.transform(rows).collect()] == [[1.0, 0.0]]
    with pytest.raises(Exception, match="a number is missing"):
        assembler.copy({assembler.handleInvalid: "error"}).transform(rows).collect()


def test_wide_fit_keeps_values_off_the_driver(spark):
    """120,000 values: vectors have two entries, the index and its use collect only counts."""
    rows = spark.range(240_000).select(F.concat(F.lit("v"), (F.col("id") % 120_000).cast("string")).alias("c"), F.col("id").alias("n"))
    index = categories.CategoryIndexer(inputCols=["c"]).fit(rows)
    assert index.getOrDefault("known") == [120_000]
    vectors = categories.sparse_assembler(index, rows, ["n"]).transform(index.transform(rows))
    first = vectors.first().features
    assert (first.size, len(first.indices)) == (120_001, 2)
    codes = index.codes[0]
    assert codes.agg(F.countDistinct("code"), F.max("code")).first()[:] == (120_000, 119_999.0)


# Samples, first rows and folds


@pytest.mark.parametrize("edge", [10_000, 5, 1])
def test_exact_sample(spark, monkeypatch, edge):
    """The rows of the smallest hashes, however fine the histogram must get; equal keys included."""
    monkeypatch.setattr(sampling, "EDGE_ROWS", edge)
    monkeypatch.setattr(sampling, "DIGITS", 1)
    rows = [(i, "a" if i % 3 else "b", f"x{i}") for i in range(400)] + [(7, "a", "x7")] * 3 + [(None, "a", "none"), (1, "c", "few")]
    df = spark.createDataFrame(rows, "k int, s string, v string")
    sizes = {"a": 100, "b": 3, "c": 50, "d": 4}
    got = sorted(tuple(r) for r in sampling.exact_sample(df, sizes, "k", "s").collect() if r.k is not None)
    expected = []
    for stratum, n in sizes.items():
        own = sorted((hashlib.md5(str(r[0]).encode()).hexdigest() if r[0] is not None else "", r) for r in rows if r[1] == stratum)
        expected += [r for _, r in own[:n] if r[0] is not None]
    assert got == sorted(expected)
    none = sampling.exact_sample(df, {**sizes, "b": 0}, "k", "s")
    assert none.where("s = 'b'").count() == 0 and none.where("s = 'a'").count() == 100
    with pytest.raises(Exception, match="no sampling fraction for c"):
        sampling.exact_sample(df, {"a": 1, "b": 1}, "k", "s").collect()


@pytest.mark.parametrize("n", [0, 1, 99, 250, 1000])
def test_first_many(spark, n):
    df = spark.range(500).select((F.col("id") * 37 % 251).alias("a"), "id").repartition(7)
    got = sorted((r.a, r.id) for r in sampling.first_many(df, n, ["a", "id"]).collect())
    assert got == sorted((i * 37 % 251, i) for i in range(500))[:n]


def test_folds_do_not_part_groups(spark):
    """A label that only its patch tells: folds by row leak it, folds by patch do not."""
    rows = spark.range(1200).select(  # fewer patches than a tree has bins
        (F.col("id") % 30).alias("patch"), (F.xxhash64(F.col("id") % 30) % 2 == 0).cast("double").alias("label")
    )
    folded = models.with_folds(rows, "patch", 3)
    assert folded.groupBy("patch").agg(F.countDistinct("fold").alias("n")).where("n > 1").count() == 0
    vectors = features.assemble(rows.withColumn("f", F.col("patch").cast("double")), exclude=["patch"], keep=["patch"])
    forest = models.forest(numTrees=5, maxDepth=10)
    by_patch = models.grouped_accuracy(vectors, forest, "patch").agg(F.avg("accuracy")).first()[0]
    by_row = models.grouped_accuracy(vectors.withColumn("row", F.monotonically_increasing_id()), forest, "row")
    assert by_patch < 0.75 < 0.9 < by_row.agg(F.avg("accuracy")).first()[0]
    tuned = models.tune_forest(vectors, [], forest, models.accuracy_evaluator(), {"maxDepth": [2, 10]}, group="patch")
    assert max(tuned.search.avgMetrics) < 0.75


# Balance and drift


def test_balanced_partition(spark):
    """A key with half of all rows is parted, light keys stay together, weights count, NULL is a key."""
    rows = [(0 if i % 2 else (None if i % 50 == 0 else i), i) for i in range(4000)]
    df = spark.createDataFrame(rows, "k int, i int").repartition(5)
    dealt = sampling.balanced_partition(df, 8, "k")
    placed = [(r.k, r.i, r.p) for r in dealt.select("k", "i", F.spark_partition_id().alias("p")).collect()]
    assert sorted(i for _, i, _ in placed) == list(range(4000))
    sizes = [sum(p == n for *_, p in placed) for n in range(8)]
    assert max(sizes) <= 1.2 * 500
    light = {k for k, *_ in placed if k}
    assert all(len({p for k, _, p in placed if k == key}) == 1 for key in list(light)[:100])
    heavy = F.when(F.col("i") < 400, 10).otherwise(1)
    by_weight = sampling.balanced_partition(df, 4, "i", heavy).select("i", F.spark_partition_id().alias("p")).collect()
    loads = [sum(10 if r.i < 400 else 1 for r in by_weight if r.p == n) for n in range(4)]
    assert sum(loads) == 7600 and max(loads) <= 1.2 * 1900
    assert sampling.balanced_partition(df.limit(0), 4, "k").count() == 0


def test_drift_rejects(spark, tmp_path):
    good = str(tmp_path / "good.parquet")
    spark.range(3).selectExpr("int(id) as a", "'x' as b").write.parquet(good)
    (tmp_path / "torn.parquet").write_bytes(b"PAR1 no footer")
    wanted = T.StructType.fromDDL("a bigint, b string")
    names = [good + "/" + p.name for p in (tmp_path / "good.parquet").glob("*.parquet")]
    names += [str(tmp_path / "torn.parquet"), str(tmp_path / "gone.parquet")]
    drift = tables.read_drifting(spark, spark.createDataFrame([(n,) for n in names], "path string"), wanted)
    assert drift.rows.schema == wanted
    assert sorted(r.a for r in drift.rows.collect()) == [0, 1, 2]
    rejects = {r.path.rsplit("/", 1)[1]: r.reason for r in drift.rejects.collect()}
    assert set(rejects) == {"torn.parquet", "gone.parquet"} and "no such file" in rejects["gone.parquet"]
    narrow = tables.read_drifting(spark, spark.createDataFrame([(names[0],)], "path string"), T.StructType.fromDDL("a tinyint"))
    assert narrow.rows.count() == 0 and narrow.rejects.first().reason == "column a is int, not tinyint"


# Deltas


def test_delta_and_audit_equal_a_full_audit(spark):
    def snapshot(*rows):
        return spark.createDataFrame(list(rows), "path string, length long")

    before = snapshot(("s3://b/x/1.tif", 1), ("s3://b/x/2.tif", 1), ("s3://b/y/1.tif", None), ("s3://b/z/1.tif", 5))
    after = snapshot(("s3a://b/x/1.tif", 1), ("s3a://b/y/old/2.tif", 1), ("s3a://b/y/1.tif", None), ("s3a://b/z/1.tif", 6))
    delta = audit.inventory_delta(before, after)
    assert sorted(tuple(r) for r in delta.collect()) == [
        ("b/x/2.tif", "removed", 1, None), ("b/y/old/2.tif", "added", None, 1), ("b/z/1.tif", "changed", 5, 6)
    ]
    counts = audit.updated_counts(audit.count_by_directory(before), delta)
    full = audit.count_by_directory(after)
    assert sorted(tuple(r) for r in counts.collect()) == sorted(tuple(r) for r in full.collect())
    paths, expected = {"s2": "a", "s1": "b", "label": "c"}, {"s2": 2, "s1": 1, "label": 1}
    rows = [("p", "s3://b/x", "s3://b/y/", "s3://b/z"), ("q", "s3://b/y", "s3://b/x", "s3://b/z"), (None, "s3://b/none", "s3://b/z", None)]
    catalog = spark.createDataFrame(rows, "patch_id string, a string, b string, c string")
    old = audit.with_directory_counts(catalog, audit.count_by_directory(before), paths=paths).where(audit.is_incomplete(expected))
    new = audit.updated_audit(catalog, old, counts, delta, expected=expected, paths=paths)
    wanted = audit.with_directory_counts(catalog, full, paths=paths).where(audit.is_incomplete(expected))
    assert sorted(map(str, new.collect())) == sorted(map(str, wanted.collect()))
    assert {r.patch_id for r in old.collect()} == {"q", None} and {r.patch_id for r in new.collect()} == {"p", None}
