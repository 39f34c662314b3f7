"""Band-math indices as column expressions.

A zero denominator gives NULL; incomplete rows are dropped later, where the
feature vector is assembled.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pixelframe.schemas import OPTICAL_BANDS, RADAR_BANDS

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ndvi(nir: ColumnOrName, red: ColumnOrName) -> Column:
    nir, red = _c(nir), _c(red)
    return F.try_divide(nir - red, nir + red)


def evi(nir: ColumnOrName, red: ColumnOrName, blue: ColumnOrName) -> Column:
    nir, red, blue = _c(nir), _c(red), _c(blue)
    return F.try_divide(2.5 * (nir - red), nir + 6 * red - 7.5 * blue + 1)


def ndwi(green: ColumnOrName, nir: ColumnOrName, standard: bool = False) -> Column:
    """Water index; by default with the sum outside the quotient.

    ``standard=True`` gives the published form, (G - NIR) / (G + NIR).
    """
    green, nir = _c(green), _c(nir)
    if standard:
        return F.try_divide(green - nir, green + nir)
    return F.try_divide(green - nir, green) + nir


def bvi(green: ColumnOrName, nir: ColumnOrName) -> Column:
    return F.try_divide(_c(green), _c(nir))


def radar_ratio(vv: ColumnOrName, vh: ColumnOrName) -> Column:
    return F.try_divide(_c(vv), _c(vh))


def radar_difference(vv: ColumnOrName, vh: ColumnOrName) -> Column:
    return _c(vv) - _c(vh)


def radar_sum(vv: ColumnOrName, vh: ColumnOrName) -> Column:
    return _c(vv) + _c(vh)


def rvi(vv: ColumnOrName, vh: ColumnOrName) -> Column:
    vv, vh = _c(vv), _c(vh)
    return F.try_divide(4 * vh, vh + vv)


def index_columns(
    bands: Mapping[str, ColumnOrName] | None = None, standard_ndwi: bool = False
) -> dict[str, Column]:
    """All eight indices by output name; ``bands`` renames the inputs."""
    b = {name: name for name in RADAR_BANDS + OPTICAL_BANDS} | dict(bands or {})
    return {
        "NDVI": ndvi(b["NIR"], b["R"]),
        "EVI": evi(b["NIR"], b["R"], b["B"]),
        "NDWI": ndwi(b["G"], b["NIR"], standard=standard_ndwi),
        "BVI": bvi(b["G"], b["NIR"]),
        "RRadio": radar_ratio(b["VV"], b["VH"]),
        "RDiff": radar_difference(b["VV"], b["VH"]),
        "RSum": radar_sum(b["VV"], b["VH"]),
        "RVI": rvi(b["VV"], b["VH"]),
    }


def add_indices(
    df: DataFrame,
    bands: Mapping[str, ColumnOrName] | None = None,
    standard_ndwi: bool = False,
) -> DataFrame:
    """Append the eight index columns in one projection."""
    return df.withColumns(index_columns(bands, standard_ndwi))
