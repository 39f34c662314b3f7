"""Raster files for the checks: the tables' vectors written as TIFFs."""

from __future__ import annotations

import struct
import zlib

import numpy as np

from pixelframe.sources import tiff


def write_tiff(pixels: np.ndarray, deflate: bool = False, strip_rows: int | None = None) -> bytes:
    """Single-band TIFF bytes of a 2-D array, in strips of so many rows, or one."""
    pixels = np.ascontiguousarray(pixels, dtype=pixels.dtype.newbyteorder("<"))
    height, width = pixels.shape
    step = strip_rows or max(1, height)
    strips = [pixels[top : top + step].tobytes() for top in range(0, max(1, height), step)]
    if deflate:
        strips = [zlib.compress(s) for s in strips]
    sizes = [len(s) for s in strips]
    places = [8 + sum(sizes[:i]) for i in range(len(sizes))]
    end = 8 + sum(sizes)
    tables = struct.pack(f"<{len(sizes)}I", *places) + struct.pack(f"<{len(sizes)}I", *sizes)
    single = len(sizes) == 1
    entries = [
        (tiff.WIDTH, 4, 1, width),
        (tiff.HEIGHT, 4, 1, height),
        (tiff.BITS, 3, 1, pixels.dtype.itemsize * 8),
        (tiff.COMPRESSION, 3, 1, 8 if deflate else 1),
        (tiff.OFFSETS, 4, len(sizes), places[0] if single else end),
        (tiff.SAMPLES, 3, 1, 1),
        (tiff.COUNTS, 4, len(sizes), sizes[0] if single else end + 4 * len(sizes)),
        (tiff.FORMAT, 3, 1, {"u": 1, "i": 2, "f": 3}[pixels.dtype.kind]),
    ]
    directory = struct.pack("<H", len(entries)) + b"".join(struct.pack("<HHII", *e) for e in entries)
    return b"II*\0" + struct.pack("<I", end + len(tables)) + b"".join(strips) + tables + directory + b"\0\0\0\0"
