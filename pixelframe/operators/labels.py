"""Label recoding through a dictionary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pixelframe.schemas import LABEL

# Land-cover codes, the dense codes they map to, and class names.
LAND_COVER_CODES = [
    (111, 1, "Continuous urban fabric"),
    (112, 2, "Discontinuous urban fabric"),
    (121, 3, "Industrial or commercial units"),
    (122, 4, "Road and rail networks and associated land"),
    (123, 5, "Port areas"),
    (124, 6, "Airports"),
    (131, 7, "Mineral extraction sites"),
    (132, 8, "Dump sites"),
    (133, 9, "Construction sites"),
    (141, 10, "Green urban areas"),
    (142, 11, "Sport and leisure facilities"),
    (211, 12, "Non-irrigated arable land"),
    (212, 13, "Permanently irrigated land"),
    (213, 14, "Rice fields"),
    (221, 15, "Vineyards"),
    (222, 16, "Fruit trees and berry plantations"),
    (223, 17, "Olive groves"),
    (231, 18, "Pastures"),
    (241, 19, "Annual crops associated with permanent crops"),
    (242, 20, "Complex cultivation patterns"),
    (
        243,
        21,
        "Land principally occupied by agriculture with significant areas of natural vegetation",
    ),
    (244, 22, "Agro-forestry areas"),
    (311, 23, "Broad-leaved forest"),
    (312, 24, "Coniferous forest"),
    (313, 25, "Mixed forest"),
    (321, 26, "Natural grassland"),
    (322, 27, "Moors and heathland"),
    (323, 28, "Sclerophyllous vegetation"),
    (324, 29, "Transitional woodland/shrub"),
    (331, 30, "Beaches dunes  sands"),
    (332, 31, "Bare rock"),
    (333, 32, "Sparsely vegetated areas"),
    (334, 33, "Burnt areas"),
    (335, 34, "Glaciers and perpetual snow"),
    (411, 35, "Inland marshes"),
    (412, 36, "Peatbogs"),
    (421, 37, "Salt marshes"),
    (422, 38, "Salines"),
    (423, 39, "Intertidal flats"),
    (511, 40, "Water courses"),
    (512, 41, "Water bodies"),
    (521, 42, "Coastal lagoons"),
    (522, 43, "Estuaries"),
    (523, 44, "Sea and ocean"),
    (999, 99, "Unlabeled"),
]
UNLABELED = 99


def land_cover_dictionary(spark: SparkSession) -> DataFrame:
    """The built-in dictionary with the columns of the CSV form, as strings."""
    rows = [(str(code), str(new), name) for code, new, name in LAND_COVER_CODES]
    return spark.createDataFrame(rows, "ID string, ID_NEW string, DESC string")


def recode_labels(
    df: DataFrame, dictionary: DataFrame, label: str = LABEL, drop_unlabeled: bool = False
) -> DataFrame:
    """Replace ``label`` by its dictionary code; rows with an unknown code are dropped.

    Ids that are not numbers match nothing. The join carries no broadcast hint:
    Spark broadcasts the dictionary while its size is below the session's
    threshold and otherwise shuffles, where adaptive execution splits a code
    that holds most pixels.
    """
    codes = dictionary.select(
        F.col("ID").try_cast("bigint").alias("__id"),
        F.col("ID_NEW").try_cast("bigint").alias("__new"),
    )
    if drop_unlabeled:
        codes = codes.where(F.col("__new") != UNLABELED)
    order = [F.col("__new").alias(label) if c == label else F.col(c) for c in df.columns]
    return df.join(codes, F.col(label).cast("bigint") == F.col("__id"), "inner").select(*order)
