"""Paths and catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pixelframe.functions import paths
from pixelframe.operators import catalog, pixels, sampling
from pixelframe.plans.checks.registry import query
from pixelframe.plans.checks.standins import table
from pixelframe.sources import files, sinks, tables
from pixelframe.storage import scratch_path

# Half of the ids end in a letter and belong to no scene.
PATCH_ID_SQL = """concat('S2A_', l_returnflag, '_', l_orderkey, '_', l_partkey, '_',
  CASE WHEN l_linestatus = 'F' THEN l_linenumber::VARCHAR ELSE l_linestatus END)"""
S1_NAME_SQL = """concat('S1B_', l_suppkey, '_', l_returnflag, l_linenumber, '_', l_orderkey, '_',
  l_partkey)"""
IDS_SQL = f"ids AS (SELECT {PATCH_ID_SQL} AS patch_id, {S1_NAME_SQL} AS s1_name FROM lineitem)"


def patch_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = F.when(F.col("l_linestatus") == "F", F.col("l_linenumber").cast("string")).otherwise(
        F.col("l_linestatus")
    )
    tail = F.concat_ws("_", "l_orderkey", "l_partkey")
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("S2A_"), "l_returnflag", F.lit("_"), tail, F.lit("_"), last).alias(
            "patch_id"
        ),
        F.concat(
            F.lit("S1B_"), "l_suppkey", F.lit("_"), "l_returnflag", "l_linenumber", F.lit("_"), tail
        ).alias("s1_name"),
    )


SCENES_SQL = f"""scenes AS (
  SELECT patch_id, s1_name,
    nullif(regexp_extract(patch_id, '{paths.OPTICAL_SCENE_PATTERN}', 1), '') AS patch_id_path,
    nullif(regexp_extract(s1_name, '{paths.RADAR_SCENE_PATTERN}', 1), '') AS patch_id_path_s1
  FROM ids)"""


@query("parent_ids", f"WITH {IDS_SQL}, {SCENES_SQL} SELECT * FROM scenes")
def parent_ids(spark, sf_dir):
    return catalog.add_scenes(patch_ids(spark, sf_dir))


CATALOG_SQL = """paths AS (
  SELECT *, 's3://store/S1/' || patch_id_path_s1 || '/' || s1_name || '/' AS s1_path,
    's3://store/S2/' || patch_id_path || '/' || patch_id || '/' AS s2_path,
    's3://store/Reference_Maps/' || patch_id_path || '/' || patch_id || '/' AS label_path
  FROM scenes)"""


@query("path_columns", f"WITH {IDS_SQL}, {SCENES_SQL}, {CATALOG_SQL} SELECT * FROM paths")
def path_columns(spark, sf_dir):
    return catalog.build_catalog(patch_ids(spark, sf_dir), "s3://store")


@query(
    "malformed_ids",
    f"WITH {IDS_SQL}, {SCENES_SQL} SELECT patch_id FROM scenes "
    "WHERE patch_id_path IS NULL OR patch_id_path_s1 IS NULL",
)
def malformed_ids(spark, sf_dir):
    built = catalog.add_scenes(patch_ids(spark, sf_dir))
    return catalog.malformed_ids(built).select("patch_id")


SLIM_SQL = """SELECT patch_id, substr(s1_path, 6) AS s1, substr(s2_path, 6) AS s2,
  substr(label_path, 6) AS label, patch_id AS bundled_id FROM paths"""


@query("slim_catalog", f"WITH {IDS_SQL}, {SCENES_SQL}, {CATALOG_SQL} {SLIM_SQL}")
def slim_catalog(spark, sf_dir):
    """Scheme strip, bundle, slim sink, and the bundle taken apart after reading it back."""
    built = catalog.build_catalog(patch_ids(spark, sf_dir), "s3://store")
    path = scratch_path(spark, "slim")
    with_split = built.withColumn("split", F.lit("train"))
    sinks.write_slim_catalog(catalog.slim_catalog(with_split), path)
    names = ["s1", "s2", "label", "bundled_id"]
    unpacked = catalog.unpack_paths(tables.read_table(spark, path), names, "patch_path_array")
    return unpacked.select("patch_id", *names)


@query(
    "scheme_rejects",
    f"""WITH {IDS_SQL}, {SCENES_SQL}, {CATALOG_SQL}
    SELECT patch_id, concat_ws('; ', CASE WHEN s1_path IS NULL THEN 's1_path is missing' END,
      CASE WHEN s2_path IS NULL THEN 's2_path is missing'
        WHEN patch_id LIKE 'S2A_A%' THEN 's2_path lacks s3://' END,
      CASE WHEN label_path IS NULL THEN 'label_path is missing' END) AS reason
    FROM paths WHERE s1_path IS NULL OR s2_path IS NULL OR patch_id LIKE 'S2A_A%'""",
)
def scheme_rejects(spark, sf_dir):
    """Malformed ids have no paths; some optical paths come with another scheme."""
    built = catalog.build_catalog(patch_ids(spark, sf_dir), "s3://store")
    other = F.regexp_replace("s2_path", "^s3://", "gs://")
    mixed = built.withColumn(
        "s2_path", F.when(F.col("patch_id").startswith("S2A_A"), other).otherwise(F.col("s2_path"))
    )
    return catalog.scheme_rejects(mixed).select("patch_id", "reason")


@query(
    "catalog_sink",
    f"""WITH {IDS_SQL}, {SCENES_SQL}, {CATALOG_SQL}
    SELECT patch_id, s1_path, label_path FROM paths WHERE substr(patch_id, 5, 1) = 'A'""",
)
def catalog_sink(spark, sf_dir):
    built = catalog.build_catalog(patch_ids(spark, sf_dir), "s3://store")
    path = scratch_path(spark, "catalog")
    sinks.write_catalog(built.withColumn("split", F.substring("patch_id", 5, 1)), path)
    stored = sampling.split_rows(tables.read_table(spark, path), "A")
    return stored.select("patch_id", "s1_path", "label_path")


@query(
    "scheme_strip",
    "SELECT page_id, string_split(url, 'https://')[2] AS rest FROM pages",
)
def scheme_strip(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id", paths.strip_scheme("url", "https://").alias("rest")
    )


@query(
    "path_bundle",
    """SELECT page_id, url AS s1_path, split_part(url, '/', 3) AS s2_path,
         split_part(url, '?', 1) AS label_path FROM pages""",
)
def path_bundle(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select(
        "page_id",
        F.col("url").alias("a"),
        F.split_part("url", F.lit("/"), F.lit(3)).alias("b"),
        F.split_part("url", F.lit("?"), F.lit(1)).alias("c"),
    )
    bundled = catalog.bundle_paths(pages, ["a", "b", "c"])
    return catalog.unpack_paths(bundled).select("page_id", *catalog.PATH_COLUMNS)


@query(
    "path_explode",
    """SELECT page_id, unnest([url, split_part(url, '/', 3), split_part(url, '?', 1)]) AS path
       FROM pages""",
)
def path_explode(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select(
        "page_id",
        F.col("url").alias("a"),
        F.split_part("url", F.lit("/"), F.lit(3)).alias("b"),
        F.split_part("url", F.lit("?"), F.lit(1)).alias("c"),
    )
    return pixels.explode_paths(catalog.bundle_paths(pages, ["a", "b", "c"]), keep=["page_id"])


@query(
    "file_stems",
    """SELECT page_id, split_part(split_part(url, '/', -1), '.', 1) AS stem,
         split_part(url, '/', -2) AS directory FROM pages""",
)
def file_stems(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id",
        paths.file_stem("url").alias("stem"),
        paths.parent_directory("url").alias("directory"),
    )


FILES_SQL = """files AS (
  SELECT concat('s3://store/S2/scene/', l_orderkey, '/', l_orderkey, '_B0', l_linenumber,
    CASE WHEN l_returnflag = 'A' THEN '.tif' ELSE '.tif.aux' END) AS path, l_orderkey, l_linenumber
  FROM lineitem)"""


def band_file_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    suffix = F.when(F.col("l_returnflag") == "A", F.lit(".tif")).otherwise(F.lit(".tif.aux"))
    root, key = F.lit("s3://store/S2/scene/"), F.col("l_orderkey").cast("string")
    number = F.col("l_linenumber").cast("string")
    return table(spark, sf_dir, "lineitem").select(
        F.concat(root, key, F.lit("/"), key, F.lit("_B0"), number, suffix).alias("path")
    )


@query(
    "optical_files",
    rf"WITH {FILES_SQL} SELECT path FROM files WHERE regexp_matches(path, '_B(0[2348])\.tif$')",
)
def optical_files(spark, sf_dir):
    return band_file_rows(spark, sf_dir).where(paths.is_optical_pixel_file("path"))


@query(
    "band_files",
    rf"""WITH {FILES_SQL}
    SELECT path, l_orderkey::VARCHAR AS patch,
      CASE l_linenumber WHEN 2 THEN 'B' WHEN 3 THEN 'G' WHEN 4 THEN 'R' END AS band
    FROM files WHERE regexp_matches(path, '_B0[234]\.tif$')""",
)
def band_files(spark, sf_dir):
    return files.band_files(band_file_rows(spark, sf_dir))
