"""Patch catalogue: paths and path bundles from patch metadata."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pixelframe.functions.paths import (
    optical_scene,
    patch_directory,
    radar_scene,
    strip_scheme,
)

PATH_COLUMNS = ("s1_path", "s2_path", "label_path")
FOLDERS = {"s1": "S1", "s2": "S2", "label": "Reference_Maps"}


def add_scenes(
    metadata: DataFrame, patch_id: str = "patch_id", s1_name: str = "s1_name"
) -> DataFrame:
    """Add the scene ids; NULL where an id has another shape."""
    return metadata.withColumns(
        {"patch_id_path": optical_scene(patch_id), "patch_id_path_s1": radar_scene(s1_name)}
    )


def build_catalog(
    metadata: DataFrame, root: str, folders: Mapping[str, str] | None = None
) -> DataFrame:
    """Metadata plus scene ids and the three image directories of each patch.

    ``folders`` names the folder below ``root`` for each sensor.
    """
    names = FOLDERS | dict(folders or {})
    return add_scenes(metadata).withColumns(
        {
            "s1_path": patch_directory(root, names["s1"], "patch_id_path_s1", "s1_name"),
            "s2_path": patch_directory(root, names["s2"], "patch_id_path", "patch_id"),
            "label_path": patch_directory(root, names["label"], "patch_id_path", "patch_id"),
        }
    )


def malformed_ids(catalog: DataFrame) -> DataFrame:
    """Catalogue rows whose ids gave no scene, to be reported."""
    return catalog.where(F.col("patch_id_path").isNull() | F.col("patch_id_path_s1").isNull())


def _scheme_faults(columns: Sequence[str], scheme: str) -> Column:
    """What is wrong with the paths of a row; empty where nothing is."""
    faults = (
        F.when(F.col(c).isNull(), F.lit(f"{c} is missing")).when(
            strip_scheme(c, scheme).isNull(), F.lit(f"{c} lacks {scheme}")
        )
        for c in columns
    )
    return F.concat_ws("; ", *faults)


def scheme_rejects(
    catalog: DataFrame, columns: Sequence[str] = PATH_COLUMNS, scheme: str = "s3://"
) -> DataFrame:
    """Catalogue rows with a path that is NULL or lacks ``scheme``, with the ``reason``."""
    return catalog.withColumn("reason", _scheme_faults(columns, scheme)).where("reason <> ''")


def with_scheme(
    catalog: DataFrame, columns: Sequence[str] = PATH_COLUMNS, scheme: str = "s3://"
) -> DataFrame:
    """The rows that ``scheme_rejects`` leaves."""
    return catalog.where(_scheme_faults(columns, scheme) == "")


def strip_path_schemes(
    df: DataFrame, columns: Sequence[str] = PATH_COLUMNS, scheme: str = "s3://"
) -> DataFrame:
    return df.withColumns({c: strip_scheme(c, scheme) for c in columns})


def bundle_paths(
    df: DataFrame,
    columns: Sequence[str] = PATH_COLUMNS,
    output: str = "paths_array",
    named: bool = False,
) -> DataFrame:
    """Collect columns into one: an array by position, or a struct by name."""
    bundle = F.struct(*columns) if named else F.array(*columns)
    return df.withColumn(output, bundle)


def unpack_paths(
    df: DataFrame, columns: Sequence[str] = PATH_COLUMNS, bundle: str = "paths_array"
) -> DataFrame:
    """Positional bundle back to named columns."""
    return df.withColumns({c: F.get(bundle, F.lit(i)) for i, c in enumerate(columns)})


def slim(
    df: DataFrame, columns: Sequence[str] = ("patch_id", "split", "patch_path_array")
) -> DataFrame:
    return df.select(*columns)


def slim_catalog(catalog: DataFrame, scheme: str = "s3://") -> DataFrame:
    """Catalogue as the pixel job reads it: id, split and the path bundle.

    A path without ``scheme`` becomes NULL; ``scheme_rejects`` reports such rows.
    """
    stripped = strip_path_schemes(catalog, scheme=scheme)
    bundled = bundle_paths(stripped, [*PATH_COLUMNS, "patch_id"], "patch_path_array")
    return slim(bundled)


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)
