"""Path and identifier expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from pixelframe.schemas import BAND_SUFFIX, OPTICAL_FILE_PATTERN

# Trailing parts of a patch id that do not belong to its scene.
OPTICAL_SCENE_PATTERN = r"^(.*)_[0-9]+_[0-9]+$"
RADAR_SCENE_PATTERN = r"^(.*)_[A-Z0-9]+_[0-9]+_[0-9]+$"

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _extract_or_null(c: Column, pattern: str, group: int = 1) -> Column:
    # regexp_extract gives '' without a match, which would read as a real id.
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def optical_scene(patch_id: ColumnOrName) -> Column:
    """Scene of an optical patch; NULL when the id has another shape."""
    return _extract_or_null(_c(patch_id), OPTICAL_SCENE_PATTERN)


def radar_scene(s1_name: ColumnOrName) -> Column:
    """Scene of a radar patch; NULL when the id has another shape."""
    return _extract_or_null(_c(s1_name), RADAR_SCENE_PATTERN)


def patch_directory(root: str, folder: str, scene: ColumnOrName, patch: ColumnOrName) -> Column:
    """``<root>/<folder>/<scene>/<patch>/``; NULL when any part is NULL."""
    prefix = f"{root.rstrip('/')}/{folder.strip('/')}/"
    return F.concat(F.lit(prefix), _c(scene), F.lit("/"), _c(patch), F.lit("/"))


def strip_scheme(path: ColumnOrName, scheme: str = "s3://") -> Column:
    """The part behind ``scheme``; NULL when the path does not carry it."""
    return F.get(F.split(_c(path), re.escape(scheme)), F.lit(1))


def file_stem(path: ColumnOrName) -> Column:
    """File name up to its first dot."""
    name = F.substring_index(_c(path), "/", -1)
    return F.substring_index(name, ".", 1)


def directory_of(path: ColumnOrName) -> Column:
    """Path up to and with its last slash."""
    c = _c(path)
    return F.left(c, F.length(c) - F.length(F.substring_index(c, "/", -1)))


def location(path: ColumnOrName) -> Column:
    """Path without scheme and outer slashes, so that file:/x/ and file:///x agree."""
    return F.rtrim(F.regexp_replace(_c(path), "^([A-Za-z][A-Za-z0-9+.-]*:)?/*", ""), F.lit("/"))


def parent_directory(path: ColumnOrName) -> Column:
    """Name of the directory that holds the file."""
    return F.substring_index(F.substring_index(_c(path), "/", -2), "/", 1)


def is_optical_pixel_file(path: ColumnOrName) -> Column:
    """True for the four optical bands that pixels are made of."""
    return _c(path).rlike(OPTICAL_FILE_PATTERN)


def is_pixel_file(path: ColumnOrName) -> Column:
    """True for the file of any band that pixels are made of."""
    return _c(path).rlike(rf"_({'|'.join(BAND_SUFFIX.values())})\.tif$")


def band_of_file(path: ColumnOrName) -> Column:
    """Band name by the file's suffix; NULL for files that hold no pixel band."""
    c = _c(path)
    band = F.lit(None).cast("string")
    for name, suffix in BAND_SUFFIX.items():
        band = F.when(c.endswith(f"_{suffix}.tif"), F.lit(name)).otherwise(band)
    return band
