import pytest
from pyspark.sql import functions as F

from pixelframe.functions import indices, paths
from pixelframe.functions.hashing import key_fraction

PIXEL = "VV double, VH double, B bigint, G bigint, R bigint, NIR bigint"


def test_indices_by_hand(spark):
    row = indices.add_indices(
        spark.createDataFrame([(-10.0, -20.0, 100, 200, 300, 500)], PIXEL)
    ).first()
    assert row.NDVI == 200 / 800
    assert row.EVI == 2.5 * 200 / (500 + 1800 - 750 + 1)
    assert row.NDWI == -300 / 200 + 500
    assert row.BVI == 200 / 500
    assert row.RRadio == 0.5
    assert row.RDiff == 10.0
    assert row.RSum == -30.0
    assert row.RVI == -80.0 / -30.0


def test_standard_ndwi(spark):
    df = spark.createDataFrame([(-10.0, -20.0, 100, 200, 300, 500)], PIXEL)
    assert indices.add_indices(df, standard_ndwi=True).first().NDWI == -300 / 700


@pytest.mark.parametrize(
    "column, values",
    [
        ("NDVI", (1.0, 1.0, 1, 1, 0, 0)),
        ("EVI", (1.0, 1.0, 2, 1, 1, 8)),
        ("NDWI", (1.0, 1.0, 1, 0, 1, 1)),
        ("BVI", (1.0, 1.0, 1, 1, 1, 0)),
        ("RRadio", (1.0, 0.0, 1, 1, 1, 1)),
        ("RVI", (1.0, -1.0, 1, 1, 1, 1)),
        ("NDVI", (1.0, 1.0, 1, 1, None, 1)),
    ],
)
def test_undefined_index_is_null(spark, column, values):
    row = indices.add_indices(spark.createDataFrame([values], PIXEL)).first()
    assert row[column] is None


def test_index_on_other_columns(spark):
    df = spark.createDataFrame([(1.0, 3.0)], "a double, b double")
    assert df.select(indices.ndvi("b", "a").alias("x")).first().x == 0.5
    assert df.select(indices.bvi(F.col("a") * 2, "b").alias("x")).first().x == 2 / 3


def test_scene_ids(spark):
    df = spark.createDataFrame(
        [
            ("S2A_MSIL2A_20170613T101031_26_57", "S1B_IW_GRDH_1SDV_20170613_33UUP_26_57"),
            ("no-suffix", "S1B_33uup_26_57"),
            (None, None),
        ],
        "p string, s string",
    )
    rows = df.select(paths.optical_scene("p").alias("p"), paths.radar_scene("s").alias("s")).collect()
    assert rows[0] == ("S2A_MSIL2A_20170613T101031", "S1B_IW_GRDH_1SDV_20170613")
    assert rows[1] == (None, None)
    assert rows[2] == (None, None)


def test_paths(spark):
    df = spark.createDataFrame(
        [("s3://store/a/p/p_B02.tif",), ("hdfs://x/p/p_VH.tif",), ("p_B8A.tif.aux",), (None,)],
        "path string",
    )
    rows = df.select(
        paths.strip_scheme("path").alias("rest"),
        paths.file_stem("path").alias("stem"),
        paths.parent_directory("path").alias("parent"),
        paths.directory_of("path").alias("directory"),
        paths.band_of_file("path").alias("band"),
        paths.is_optical_pixel_file("path").alias("optical"),
    ).collect()
    assert rows[0] == ("store/a/p/p_B02.tif", "p_B02", "p", "s3://store/a/p/", "B", True)
    assert rows[1] == (None, "p_VH", "p", "hdfs://x/p/", "VH", False)
    assert rows[2].rest is None and rows[2].band is None and rows[2].directory == ""
    assert all(v is None for v in rows[3])


def test_patch_directory_is_null_without_scene(spark):
    df = spark.createDataFrame([("scene", "p"), (None, "p")], "s string, p string")
    rows = df.select(paths.patch_directory("s3://b/", "S2", "s", "p").alias("d")).collect()
    assert [r.d for r in rows] == ["s3://b/S2/scene/p/", None]


def test_key_fraction_is_uniform_and_salted(spark):
    df = spark.range(20000).select(
        key_fraction("id").alias("a"), key_fraction("id", salt="x").alias("b")
    )
    low = df.agg(
        F.min("a").alias("lo"), F.max("a").alias("hi"), F.avg("a").alias("m"), F.corr("a", "b").alias("c")
    ).first()
    assert 0 <= low.lo and low.hi < 1 and abs(low.m - 0.5) < 0.01 and abs(low.c) < 0.05


@pytest.mark.parametrize("path", ["file:/a/b/", "file:///a/b", "/a/b/", "s3a://a/b/", "a/b", "HDFS://a/b/"])
def test_location_ignores_how_a_path_is_written(spark, path):
    df = spark.createDataFrame([(path,)], "path string")
    assert df.select(paths.location("path").alias("x")).first().x == "a/b"
