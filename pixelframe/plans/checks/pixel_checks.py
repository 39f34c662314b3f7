"""Pixels, band maths and labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pixelframe.functions import indices
from pixelframe.operators import labels, pixels
from pixelframe.plans.checks.registry import query
from pixelframe.plans.checks.standins import (
    BANDS_SQL,
    COUNT_SCALE,
    FEATURES_SQL,
    INDEX_SQL,
    LINEITEM_BANDS,
    NDWI_STANDARD_SQL,
    PIXELS_SQL,
    POSITIONS_SQL,
    RECODED_SQL,
    TURN,
    as_count,
    band_arrays,
    nation_dictionary,
    pixel_rows,
    table,
    turned,
    turned_sql,
)
from pixelframe.schemas import FEATURE_COLUMNS, PIXEL_BANDS


@query(
    "pixels_zip",
    f"WITH {PIXELS_SQL} SELECT vec_id, split, pos, VH, VV, B, G, R, NIR, label FROM px",
)
def pixels_zip(spark, sf_dir):
    return pixel_rows(spark, sf_dir)


@query(
    "pixels_posexplode",
    f"SELECT vec_id, pos, {turned_sql(0)} AS value FROM embeddings, {POSITIONS_SQL}",
)
def pixels_posexplode(spark, sf_dir):
    arrays = band_arrays(spark, sf_dir, "vec_id")
    return pixels.explode_positions(arrays, "VH", keep=["vec_id"], value="value")


@query(
    "struct_projection",
    f"WITH {PIXELS_SQL} SELECT vec_id, pos, VV, NIR FROM px",
)
def struct_projection(spark, sf_dir):
    arrays = band_arrays(spark, sf_dir, "vec_id")
    nested = arrays.select("vec_id", F.struct(*PIXEL_BANDS).alias("pixel_arrays"))
    flat = pixels.flatten_struct(nested, "pixel_arrays", ["VV", "NIR"], keep=["vec_id"])
    rows = pixels.explode_pixels(flat, ["VV", "NIR"], keep=["vec_id"], position="pos")
    return rows.withColumn("NIR", as_count(F.col("NIR"), COUNT_SCALE["NIR"]))


def uneven_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two bands; every third label has one value more in the second."""
    values = F.col("embedding").cast("array<double>")
    second = turned(values, TURN)
    longer = F.when(F.col("label") % 3 == 0, F.concat(second, F.array(F.lit(0.0)))).otherwise(second)
    return table(spark, sf_dir, "embeddings").select("vec_id", values.alias("VH"), longer.alias("VV"))


@query("uneven_patches", "SELECT vec_id FROM embeddings WHERE label % 3 = 0")
def uneven_patches(spark, sf_dir):
    arrays = uneven_arrays(spark, sf_dir)
    return pixels.uneven_patches(arrays, ["VH", "VV"]).select("vec_id")


@query(
    "even_patches",
    f"""SELECT vec_id, {turned_sql(0)} AS VH, {turned_sql(TURN)} AS VV
       FROM embeddings, {POSITIONS_SQL} WHERE label % 3 <> 0""",
)
def even_patches(spark, sf_dir):
    return pixels.explode_pixels(uneven_arrays(spark, sf_dir), ["VH", "VV"], keep=["vec_id"])


def _register_index(name: str, output: str, sql: str, standard: bool = False) -> None:
    @query(name, f"WITH {BANDS_SQL} SELECT l_orderkey, l_linenumber, {sql} AS value FROM bands")
    def run(spark, sf_dir):
        value = indices.index_columns(LINEITEM_BANDS, standard)[output]
        rows = table(spark, sf_dir, "lineitem")
        return rows.select("l_orderkey", "l_linenumber", value.alias("value"))


for _name, _sql in INDEX_SQL.items():
    _register_index(f"band_index_{_name.lower()}", _name, _sql)
_register_index("band_index_ndwi_standard", "NDWI", NDWI_STANDARD_SQL, standard=True)


@query(
    "pixel_features",
    f"""WITH {PIXELS_SQL}, {FEATURES_SQL}
    SELECT vec_id, pos, {", ".join(FEATURE_COLUMNS)}, label FROM features""",
)
def pixel_features(spark, sf_dir):
    rows = indices.add_indices(pixel_rows(spark, sf_dir))
    return rows.select("vec_id", "pos", *FEATURE_COLUMNS, "label")


@query(
    "label_recode",
    f"WITH {PIXELS_SQL}, {FEATURES_SQL}, {RECODED_SQL} SELECT vec_id, pos, NIR, label FROM recoded",
)
def label_recode(spark, sf_dir):
    rows = pixel_rows(spark, sf_dir).select("vec_id", "pos", "NIR", "label")
    return labels.recode_labels(rows, nation_dictionary(spark, sf_dir))


@query(
    "land_cover_summary",
    f"""WITH {PIXELS_SQL}, {FEATURES_SQL}, {RECODED_SQL}
    SELECT label, count(*) AS pixels, round(avg(NDVI), 6) AS mean_ndvi,
      round(avg(RDiff), 6) AS mean_rdiff, count(*) - count(BVI) AS undefined_bvi
    FROM recoded GROUP BY label""",
)
def land_cover_summary(spark, sf_dir):
    rows = indices.add_indices(pixel_rows(spark, sf_dir))
    recoded = labels.recode_labels(rows, nation_dictionary(spark, sf_dir))
    return recoded.groupBy("label").agg(
        F.count(F.lit(1)).alias("pixels"),
        F.round(F.avg("NDVI"), 6).alias("mean_ndvi"),
        F.round(F.avg("RDiff"), 6).alias("mean_rdiff"),
        (F.count(F.lit(1)) - F.count("BVI")).alias("undefined_bvi"),
    )
