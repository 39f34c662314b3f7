"""Raster bytes to pixel arrays, as a Spark job.

``decode_patches`` takes one row per patch with a column per band, holding
either the band file's path or its content, and gives one row per patch with an
array per band. Scalars such as the patch id stay scalars; they are repeated
only where pixels become rows, inside the JVM.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pixelframe.schemas import PATCH_ARRAYS, PIXEL_BANDS, RADAR_BANDS
from pixelframe.sources.remote import TaskStorage
from pixelframe.sources.tiff import RUN_BYTES, Band, open_tiff

Decoder = Callable[[bytes], np.ndarray]
Opener = Callable[[pa.NativeFile], Band]

FIRST_PIXEL = "first_pixel"
ERROR = "error"

#: Pixels of an output batch, however small the blocks in it.
BATCH_PIXELS = 1 << 16


def decoded_whole(decoder: Decoder) -> Opener:
    """An opener for a decoder that takes a file's whole content."""

    def opened(source: pa.NativeFile) -> Band:
        pixels = np.asarray(decoder(source.read()))
        return Band((1, pixels.size), iter([pixels]))

    return opened


@cache
def default_opener() -> Opener:
    """rasterio where it is installed, else the plain TIFF reader; both read rows as they are asked for.

    Kept by the worker: each task would look for a missing package all along the path again.
    """
    try:
        import rasterio
        from rasterio.errors import RasterioError
        from rasterio.windows import Window
    except ImportError:
        return open_tiff

    def runs(data) -> Iterator[np.ndarray]:
        height, width = data.shape
        step = max(1, RUN_BYTES // max(1, width * 8))
        try:
            for top in range(0, height, step) if data.count == 1 else ():
                yield data.read(1, window=Window(0, top, width, min(step, height - top)))
            if data.count != 1:
                yield data.read()
        except RasterioError as problem:
            raise ValueError(str(problem)) from problem

    def opened(source: pa.NativeFile) -> Band:
        try:
            data = rasterio.open(source)
        except RasterioError as problem:
            raise ValueError(str(problem)) from problem
        return Band((data.count * data.height, data.width), runs(data))

    return opened


def _kind(band: str) -> type:
    return np.float64 if band in RADAR_BANDS else np.int64


class _Taker:
    """Hands out a band's pixels in blocks of any size; holds one run of them at most."""

    def __init__(self, band: Band, kind: type) -> None:
        self.runs, self.kind, self.rest = band.runs, kind, np.empty(0, kind)

    def take(self, count: int) -> np.ndarray:
        parts, held = [self.rest[:count]], min(count, len(self.rest))
        self.rest = self.rest[count:]
        while held < count:
            run = next(self.runs).reshape(-1)
            parts.append(run[: count - held].astype(self.kind))
            self.rest = run[count - held :].astype(self.kind)
            held += len(parts[-1])
        return np.concatenate(parts)


def _one_by_one(do: Callable, items: Iterable) -> list:
    return [do(item) for item in items]


def _blocks(
    sources: Mapping[str, pa.NativeFile], opened: Opener, each: Callable, block_pixels: int
) -> tuple[int, Iterator[dict[str, np.ndarray]]]:
    """(length, blocks of all bands in step); raises where the bands are not of one length."""
    if all(isinstance(source, pa.BufferReader) for source in sources.values()):
        each = _one_by_one  # nothing to wait for: threads would only cost time
    bands = dict(zip(sources, each(opened, sources.values())))
    lengths = {b: band.length for b, band in bands.items()}
    if len(set(lengths.values())) > 1:
        raise ValueError(f"band lengths differ: {lengths}")
    length = next(iter(lengths.values()))
    takers = {b: _Taker(band, _kind(b)) for b, band in bands.items()}

    def blocks() -> Iterator[dict[str, np.ndarray]]:
        for start in range(0, length, block_pixels):
            count = min(block_pixels, length - start)
            yield dict(zip(takers, each(lambda t: t.take(count), takers.values())))

    return length, blocks()


def _patch_rows(
    find: Callable[[], Mapping[str, pa.NativeFile | None]], opened: Opener, each: Callable, block_pixels: int
) -> Iterator[tuple[int, dict[str, np.ndarray], str | None]]:
    """(first pixel, arrays, error) of every output row of a patch.

    A raster of several blocks is read twice, at first only to know that all of
    it can be read: a patch gives all its pixels or none.
    """
    columns: Mapping[str, pa.NativeFile | None] = {}
    try:
        columns = find()
        missing = [b for b, source in columns.items() if source is None]
        if missing:
            raise ValueError(f"missing bands: {', '.join(missing)}")
        length, blocks = _blocks(columns, opened, each, block_pixels)
        if length <= block_pixels:
            blocks = iter([next(blocks, {b: np.empty(0, _kind(b)) for b in columns})])
        else:
            for _ in blocks:
                pass
            _, blocks = _blocks(find(), opened, each, block_pixels)
    except (ValueError, struct.error, zlib.error, StopIteration) as problem:
        yield 0, {b: np.empty(0, _kind(b)) for b in columns}, str(problem) or "too few pixels"
        return
    for n, block in enumerate(blocks):
        yield n * block_pixels, block, None


def _list_column(parts: Sequence[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(v) for v in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(parts)))


def decode_patches(
    patches: DataFrame,
    keys: Sequence[str],
    columns: Mapping[str, str] | None = None,
    decoder: Decoder | None = None,
    block_pixels: int = 1 << 20,
    fetch_threads: int = 8,
) -> DataFrame:
    """Decode one row of band files per patch into one array per band.

    ``columns`` names the input column of each band: a path (string) is read
    inside the task, a content (binary) is used as it is. A patch whose bands
    are missing, unreadable or of different sizes gives one row with ``error``
    set and no pixels. A raster above ``block_pixels`` comes in several rows;
    ``first_pixel`` is the position of a row's first pixel.

    The bands of a patch are read in step, a block at a time, by ranges of the
    files; a ``decoder`` of whole contents holds whole bands instead.
    """
    columns = dict(columns or {b: b for b in PIXEL_BANDS})
    keys = list(keys)
    kinds = {patches.schema[c].dataType for c in columns.values()}
    if kinds not in ({T.StringType()}, {T.BinaryType()}):
        raise ValueError("band columns must all hold paths or all hold contents")
    by_path = kinds == {T.StringType()}
    schema = T.StructType(
        [patches.schema[k] for k in keys]
        + [T.StructField(FIRST_PIXEL, T.LongType())]
        + [T.StructField(b, PATCH_ARRAYS[b].dataType) for b in columns]
        + [T.StructField(ERROR, T.StringType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = decoded_whole(decoder) if decoder else default_opener()
        storage = TaskStorage()
        with ThreadPoolExecutor(fetch_threads) as pool:

            def each(do: Callable, items: Iterable) -> list:
                return list(pool.map(do, items))

            def source(value: pa.Scalar) -> pa.NativeFile | None:
                if not value.is_valid:
                    return None
                return storage.open(value.as_py()) if by_path else pa.BufferReader(value.as_buffer())

            def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
                for i in range(batch.num_rows):
                    values = {b: batch.column(c)[i] for b, c in columns.items()}

                    def find(values=values) -> dict[str, pa.NativeFile | None]:
                        waiting = by_path and any(v.is_valid and storage.waits(v.as_py()) for v in values.values())
                        opening = each if waiting else _one_by_one
                        return dict(zip(values, opening(source, values.values())))

                    for start, arrays, error in _patch_rows(find, opened, each, block_pixels):
                        yield i, start, arrays or {b: np.empty(0, _kind(b)) for b in columns}, error

            for batch in batches:
                for group in _by_pixels(rows(batch), max(block_pixels, BATCH_PIXELS)):
                    index, starts, arrays, errors = zip(*group)
                    yield pa.RecordBatch.from_arrays(
                        [
                            *batch.select(keys).take(pa.array(index, pa.int64())).columns,
                            pa.array(starts, pa.int64()),
                            *[_list_column([a[b] for a in arrays]) for b in columns],
                            pa.array(errors, pa.string()),
                        ],
                        names=schema.fieldNames(),
                    )

    return patches.mapInArrow(run, schema)


def _by_pixels(rows, limit: int, max_rows: int = 4096) -> Iterator[list]:
    """Group output rows into batches of about ``limit`` pixels."""
    group, held = [], 0
    for row in rows:
        group.append(row)
        held += len(next(iter(row[2].values())))
        if held >= limit or len(group) >= max_rows:
            yield group
            group, held = [], 0
    if group:
        yield group


def gather_bands(files: DataFrame, keys: Sequence[str], value: str = "path") -> DataFrame:
    """Bring the band files of a patch into one row with a column per band.

    ``files`` has the keys, ``path``, ``band`` and, to gather contents, a binary
    ``value`` column. Map-side aggregation keeps one value per patch and band, so
    repeated files never pile up in one task; where several files claim a band,
    the first path in order is taken.
    """

    def first(band: str):
        chosen = F.col("band") == band
        if value == "path":
            return F.min(F.when(chosen, F.col("path"))).alias(band)
        return F.min_by(F.when(chosen, F.col(value)), F.when(chosen, F.col("path"))).alias(band)

    return files.groupBy(*keys).agg(*[first(b) for b in PIXEL_BANDS])
