"""Driver tables as stand-ins for imagery.

``embeddings`` are patches of 8 x 8 pixels: a band is the whole vector, turned by an offset of its own.
``lineitem`` rows are files of a patch or band values, ``orders`` is the catalogue,
``nation`` the label dictionary and ``pages.url`` supplies paths.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pixelframe.operators import pixels
from pixelframe.schemas import LABEL, OPTICAL_BANDS, PIXEL_BANDS
from pixelframe.sources import tables


def table(spark: SparkSession, sf_dir: str, name: str, schema: T.StructType | None = None):
    return tables.read_table(spark, f"{sf_dir}/{name}.parquet", schema)


PATCH_SIDE = 8
PATCH_PIXELS = PATCH_SIDE**2
#: How far the vector of a band is turned, for each place of the band.
TURN = 9
SPLIT_SQL = "CASE WHEN label < 5 THEN 'train' WHEN label < 8 THEN 'validation' ELSE 'test' END"


def turned(values: Column, by: int) -> Column:
    """All values, from place ``by`` on, then those before it."""
    rest = F.slice(values, by + 1, F.greatest(F.size(values) - by, F.lit(0)))
    return F.concat(rest, F.slice(values, 1, by)) if by else values


def turned_sql(by: int) -> str:
    """The same at position ``pos``."""
    return f"embedding[1 + (pos + {by}) % {PATCH_PIXELS}]::DOUBLE"


def band_arrays(spark: SparkSession, sf_dir: str, *keep: str, tasks: int | None = None) -> DataFrame:
    """One row per patch with seven arrays of 64 doubles; with ``tasks`` spread over so many."""
    vectors = table(spark, sf_dir, "embeddings")
    vectors = vectors.repartition(tasks) if tasks else vectors
    values = F.col("embedding").cast("array<double>")
    return vectors.select(
        *keep,
        F.expr(SPLIT_SQL).alias("split"),
        *[turned(values, i * TURN).alias(b) for i, b in enumerate(PIXEL_BANDS)],
    )


COUNT_SCALE = dict.fromkeys(OPTICAL_BANDS, 10000.0) | {LABEL: 100.0}


def as_count(value: Column, scale: float) -> Column:
    """The integer that an optical or label raster would hold."""
    return F.floor(F.abs(value) * F.lit(scale)).cast("bigint")


def as_counts(df: DataFrame) -> DataFrame:
    return df.withColumns({b: as_count(F.col(b), s) for b, s in COUNT_SCALE.items()})


def pixel_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    arrays = band_arrays(spark, sf_dir, "vec_id")
    return as_counts(pixels.explode_pixels(arrays, keep=["vec_id", "split"], position="pos"))


def _band_sql(band: str) -> str:
    value = turned_sql(PIXEL_BANDS.index(band) * TURN)
    scale = COUNT_SCALE.get(band)
    return f"floor(abs({value}) * {scale:.0f})::BIGINT AS {band}" if scale else f"{value} AS {band}"


POSITIONS_SQL = f"(SELECT unnest(range({PATCH_PIXELS}))::INTEGER AS pos)"
PIXELS_SQL = f"""
px AS (
  SELECT vec_id, {SPLIT_SQL} AS split, pos,
    {", ".join(map(_band_sql, PIXEL_BANDS))}
  FROM embeddings, {POSITIONS_SQL}
)"""

INDEX_SQL = {
    "NDVI": "(NIR - R) / nullif(NIR + R, 0)::DOUBLE",
    "EVI": "2.5::DOUBLE * (NIR - R) / nullif(NIR + 6 * R - 7.5::DOUBLE * B + 1, 0)",
    "NDWI": "(G - NIR) / nullif(G, 0)::DOUBLE + NIR",
    "BVI": "G / nullif(NIR, 0)::DOUBLE",
    "RRadio": "VV / nullif(VH, 0)",
    "RDiff": "VV - VH",
    "RSum": "VV + VH",
    "RVI": "4 * VH / nullif(VH + VV, 0)",
}
NDWI_STANDARD_SQL = "(G - NIR) / nullif(G + NIR, 0)::DOUBLE"


def nation_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label dictionary of 25 codes; label codes above 24 stay unknown."""
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("string").alias("ID"),
        (F.col("n_regionkey") + 1).cast("string").alias("ID_NEW"),
        F.col("n_name").alias("DESC"),
    )

# lineitem columns as bands: small discounts and taxes give natural zero denominators.
LINEITEM_BANDS = {
    "VV": "l_extendedprice",
    "VH": "l_tax",
    "B": "l_tax",
    "G": "l_discount",
    "R": "l_discount",
    "NIR": "l_tax",
}
BANDS_SQL = "bands AS (SELECT l_orderkey, l_linenumber, {} FROM lineitem)".format(
    ", ".join(f"{source} AS {band}" for band, source in LINEITEM_BANDS.items())
)

FEATURES_SQL = "features AS (SELECT *, {} FROM px)".format(
    ", ".join(f"{sql} AS {name}" for name, sql in INDEX_SQL.items())
)

RECODED_SQL = """recoded AS (
  SELECT features.* EXCLUDE (label), n_regionkey::BIGINT + 1 AS label
  FROM features JOIN nation ON features.label = n_nationkey)"""

HASH_SQL = "(('0x' || substr(md5({}::VARCHAR), 1, 8))::UBIGINT / 4294967296.0::DOUBLE)"
