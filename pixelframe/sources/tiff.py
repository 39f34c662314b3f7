"""Plain TIFF files by ranges: single-band, in strips, uncompressed or deflate.

Only the header, the strip table and the part of a strip that is decoded next are
read, so a file of any size takes the memory of a run of rows.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

# TIFF tags and the byte width and code of their value types.
WIDTH, HEIGHT, BITS, COMPRESSION = 256, 257, 258, 259
OFFSETS, SAMPLES, COUNTS, PREDICTOR, FORMAT = 273, 277, 279, 317, 339
_TAG_TYPES = {1: "B", 3: "H", 4: "I"}
_PIXEL_KINDS = {1: "u", 2: "i", 3: "f"}
_PIXEL_TYPES = {(k, b) for k in "ui" for b in (8, 16, 32, 64)} | {("f", 32), ("f", 64)}

#: Pixels that are decoded at once, in bytes; a row of the image at least.
RUN_BYTES = 1 << 20


class Band(NamedTuple):
    """A band that is decoded as it is read: its height and width, and its pixels in runs of whole rows."""

    shape: tuple[int, int]
    runs: Iterator[np.ndarray]

    @property
    def length(self) -> int:
        return self.shape[0] * self.shape[1]


def _range(source: pa.NativeFile, offset: int, count: int) -> bytes:
    if offset + count > source.size():
        raise ValueError("TIFF file is cut short")
    return source.read_at(count, offset)


def _tags(source: pa.NativeFile) -> tuple[str, dict[int, tuple]]:
    head = _range(source, 0, 8)
    order = {b"II": "<", b"MM": ">"}.get(head[:2])
    if order is None or struct.unpack(order + "H", head[2:4])[0] != 42:
        raise ValueError("not a TIFF file")
    at = struct.unpack(order + "I", head[4:8])[0]
    entries = struct.unpack(order + "H", _range(source, at, 2))[0]
    directory = _range(source, at + 2, 12 * entries)
    tags: dict[int, tuple] = {}
    for entry in range(0, 12 * entries, 12):
        tag, kind, count = struct.unpack_from(order + "HHI", directory, entry)
        if kind in _TAG_TYPES:
            size = count * struct.calcsize(_TAG_TYPES[kind])
            value = directory[entry + 8 : entry + 12]
            raw = value[:size] if size <= 4 else _range(source, struct.unpack(order + "I", value)[0], size)
            tags[tag] = struct.unpack(f"{order}{count}{_TAG_TYPES[kind]}", raw)
    return order, tags


def open_tiff(source: pa.NativeFile, run_bytes: int = RUN_BYTES) -> Band:
    """The band of a file that is open for reading at any place."""
    order, tags = _tags(source)

    def one(tag: int, default: int | None = None) -> int:
        if tags.get(tag):
            return tags[tag][0]
        if default is None:
            raise ValueError(f"TIFF tag {tag} is missing")
        return default

    compression, predictor = one(COMPRESSION, 1), one(PREDICTOR, 1)
    if one(SAMPLES, 1) != 1 or compression not in (1, 8, 32946) or predictor not in (1, 2):
        raise ValueError("unsupported TIFF layout")
    if OFFSETS not in tags or COUNTS not in tags:
        raise ValueError("unsupported TIFF layout: no strips")
    kind, bits = _PIXEL_KINDS.get(one(FORMAT, 1)), one(BITS, 1)
    if (kind, bits) not in _PIXEL_TYPES:
        raise ValueError(f"unsupported TIFF pixels: {kind}, {bits} bits")
    dtype = np.dtype(f"{order}{kind}{bits // 8}")
    shape = one(HEIGHT), one(WIDTH)
    strips = list(zip(tags[OFFSETS], tags[COUNTS]))
    if compression == 1 and shape[0] * shape[1] * dtype.itemsize > sum(n for _, n in strips):
        raise ValueError("TIFF strips hold too few pixels")
    data = _strip_bytes(source, strips, compression != 1, run_bytes)
    return Band(shape, _rows(data, shape, dtype, predictor == 2, run_bytes))


def _strip_bytes(source: pa.NativeFile, strips: list, deflate: bool, run_bytes: int) -> Iterator[bytes]:
    """The decoded bytes of all strips in order, ``run_bytes`` at a time."""
    for offset, count in strips:
        inflate = zlib.decompressobj() if deflate else None
        for start in range(0, count, run_bytes):
            piece = _range(source, offset + start, min(run_bytes, count - start))
            while piece and inflate:
                yield inflate.decompress(piece, run_bytes)
                piece = inflate.unconsumed_tail
            if not inflate:
                yield piece
        if inflate:
            yield inflate.flush()


def _rows(data: Iterator[bytes], shape: tuple, dtype: np.dtype, differences: bool, run_bytes: int) -> Iterator[np.ndarray]:
    """Pixels in runs of whole rows; raises where the bytes end too early."""
    height, width = shape
    row, done, held = width * dtype.itemsize, 0, bytearray()
    while done < height and row:
        piece = next(data, None)
        if piece is None:
            raise ValueError("TIFF strips hold too few pixels")
        held += piece
        rows = min(len(held) // row, height - done)
        if rows and (len(held) >= run_bytes or done + rows == height):
            pixels = np.frombuffer(bytes(held[: rows * row]), dtype).reshape(rows, width)
            del held[: rows * row]
            done += rows
            yield np.cumsum(pixels, axis=1, dtype=dtype) if differences else pixels


def read_tiff(content: bytes) -> np.ndarray:
    """All pixels of a file's content."""
    band = open_tiff(pa.BufferReader(content))
    runs = list(band.runs)
    return np.concatenate(runs) if runs else np.empty(band.shape)
