"""A small store of raster files with its metadata, as the jobs expect them."""

from __future__ import annotations

from pathlib import Path

import numpy as np

from pixelframe.schemas import BAND_SUFFIX, METADATA
from pixelframe.plans.checks.raster_files import write_tiff

SIDE = 4
SPLITS = ["train", "train", "validation", "test"]
CODES = [111, 211, 311, 999, 777]
OTHER_OPTICAL = ["B01", "B05", "B06", "B07", "B8A", "B09", "B11", "B12"]


def ids(i: int) -> tuple[str, str]:
    return f"S2A_MSIL2A_T{i % 2}_{i}_7", f"S1B_IW_GRDH_{i % 2}_33UX_{i}_7"


def band_pixels(i: int, band: str) -> np.ndarray:
    rng = np.random.default_rng([i, list(BAND_SUFFIX).index(band)])
    if band in ("VH", "VV"):
        return rng.normal(-15, 3, (SIDE, SIDE)).astype(np.float32)
    if band == "label":
        # Bright pixels belong to one class, so that a model can learn it.
        blue = band_pixels(i, "B")
        return np.where(blue > 500, 311, np.array(CODES)[rng.integers(0, 5, (SIDE, SIDE))]).astype(
            np.uint16
        )
    return rng.integers(0, 1000, (SIDE, SIDE)).astype(np.uint16)


def metadata_rows(n: int) -> list[tuple]:
    rows = []
    for i in range(n):
        patch, radar = ids(i)
        rows.append((patch, ["Arable land"], SPLITS[i % 4], "Austria", radar, patch, False, False))
    return rows


def write_store(root: Path, n: int) -> None:
    """All files of ``n`` patches: 12 optical, 2 radar and 1 label raster each."""
    for i in range(n):
        patch, radar = ids(i)
        places = {
            "s1": root / "S1" / radar.rsplit("_", 3)[0] / radar,
            "s2": root / "S2" / patch.rsplit("_", 2)[0] / patch,
            "label": root / "Reference_Maps" / patch.rsplit("_", 2)[0] / patch,
        }
        for place in places.values():
            place.mkdir(parents=True)
        for band, suffix in BAND_SUFFIX.items():
            sensor = "s1" if band in ("VH", "VV") else "label" if band == "label" else "s2"
            stem = radar if sensor == "s1" else patch
            data = write_tiff(band_pixels(i, band), deflate=sensor == "s2")
            (places[sensor] / f"{stem}_{suffix}.tif").write_bytes(data)
        for suffix in OTHER_OPTICAL:
            (places["s2"] / f"{patch}_{suffix}.tif").write_bytes(b"unused")


def metadata(spark, n: int):
    return spark.createDataFrame(metadata_rows(n), METADATA)
