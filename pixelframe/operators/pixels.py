"""Patch arrays to pixel rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pixelframe.schemas import PIXEL_BANDS


def explode_paths(
    df: DataFrame, bundle: str = "paths_array", keep: Sequence[str] = (), output: str = "path"
) -> DataFrame:
    """One row per path of a bundle."""
    return df.select(*keep, F.explode(bundle).alias(output))


def flatten_struct(
    df: DataFrame, struct: str, fields: Sequence[str], keep: Sequence[str] = ()
) -> DataFrame:
    """Struct fields as top-level columns; only the named fields are read."""
    return df.select(*keep, *[F.col(f"{struct}.{f}").alias(f) for f in fields])


def _equal_lengths(bands: Sequence[str]) -> Column:
    first, *rest = (F.size(b) for b in bands)
    even = F.lit(True)
    for other in rest:
        even = even & (first == other)
    return F.coalesce(even, F.lit(False))


def uneven_patches(df: DataFrame, bands: Sequence[str] = PIXEL_BANDS) -> DataFrame:
    """Rejects of ``explode_pixels``: patches whose bands differ in length or are missing."""
    return df.where(~_equal_lengths(bands) | F.isnull(bands[0]))


def explode_pixels(
    df: DataFrame,
    bands: Sequence[str] = PIXEL_BANDS,
    keep: Sequence[str] = (),
    position: str | None = None,
    outer: bool = False,
    offset: str | None = None,
) -> DataFrame:
    """One row per pixel, each exactly once, aligned by position within the patch.

    A row that holds a block of a patch names the position of its first pixel in
    the column ``offset``; ``position`` then counts on from there.

    One array is exploded with its position and the others are indexed by it.
    No zipped array of structs is built and nothing is joined; columns in
    ``keep`` are repeated as scalars. Patches with uneven bands give no rows;
    ``uneven_patches`` reports them. With ``outer`` a patch without pixels is
    kept as one row of NULL bands.
    """
    lead, *others = bands
    at, value = "__pos", "__lead"
    generate = F.posexplode_outer if outer else F.posexplode
    first = [F.col(offset).alias("__first")] if offset else []
    exploded = df.where(_equal_lengths(bands)).select(
        *keep, *first, *others, generate(lead).alias(at, value)
    )
    place = F.col(at) + F.col("__first") if offset else F.col(at)
    return exploded.select(
        *keep,
        *([place.cast("int" if not offset else "long").alias(position)] if position else []),
        F.col(value).alias(lead),
        *[F.get(b, F.col(at)).alias(b) for b in others],
    )


def explode_positions(
    df: DataFrame,
    array: str,
    keep: Sequence[str] = (),
    position: str = "pos",
    value: str | None = None,
) -> DataFrame:
    """One row per array element with its position."""
    return df.select(*keep, F.posexplode(array).alias(position, value or array))
