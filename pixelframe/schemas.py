"""Row types of the tables that the library reads and writes."""

from __future__ import annotations

from pyspark.sql import types as T

RADAR_BANDS = ("VH", "VV")
OPTICAL_BANDS = ("B", "G", "R", "NIR")
LABEL = "label"
PIXEL_BANDS = RADAR_BANDS + OPTICAL_BANDS + (LABEL,)

# Names of the splits, and files of a complete patch per sensor.
SPLITS = ("train", "validation", "test")
COMPLETE_FILES = {"s2": 12, "s1": 2, "label": 1}

# How band files are named, as the last part of the file stem.
BAND_SUFFIX = {
    "VH": "VH",
    "VV": "VV",
    "B": "B02",
    "G": "B03",
    "R": "B04",
    "NIR": "B08",
    "label": "reference_map",
}
# File-name patterns of the bands used for pixels.
OPTICAL_FILE_PATTERN = r"_B(0[2348])\.tif$"
OPTICAL_FILE_GLOB = "*_B0[2348].tif"
RASTER_SUFFIX = ".tif"


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


METADATA = T.StructType(
    _strings("patch_id")
    + [T.StructField("labels", T.ArrayType(T.StringType()))]
    + _strings("split", "country", "s1_name", "s2v1_name")
    + [
        T.StructField("contains_seasonal_snow", T.BooleanType()),
        T.StructField("contains_cloud_or_shadow", T.BooleanType()),
    ]
)

CATALOG = T.StructType(
    METADATA.fields
    + _strings("patch_id_path", "patch_id_path_s1", "s1_path", "s2_path", "label_path")
)

# Narrow reads of the catalogue.
AUDIT_COLUMNS = T.StructType(_strings("patch_id", "s1_path", "s2_path", "label_path"))
PIXEL_JOB_COLUMNS = T.StructType(
    _strings("patch_id", "s1_name", "split", "s1_path", "s2_path", "label_path")
)

LABEL_DICTIONARY_CSV = T.StructType(_strings("ID", "ID_NEW", "DESC"))

def band_type(band: str) -> T.DataType:
    return T.DoubleType() if band in RADAR_BANDS else T.LongType()


PATCH_ARRAYS = T.StructType([T.StructField(b, T.ArrayType(band_type(b))) for b in PIXEL_BANDS])

# Radar, optical and label columns of a pixel, in the order that models see them.
PIXEL_ORDER = ("VV", "VH") + OPTICAL_BANDS + (LABEL,)
PIXEL = T.StructType(
    [T.StructField(b, band_type(b)) for b in PIXEL_ORDER] + _strings("patch_id", "split")
)

INDEX_COLUMNS = ("NDVI", "EVI", "NDWI", "BVI", "RRadio", "RDiff", "RSum", "RVI")
FEATURE_COLUMNS = ("VV", "VH") + OPTICAL_BANDS + INDEX_COLUMNS
