"""Words and word windows of Arrow text columns as numpy arrays, for tasks.

A task works through chunks of whole documents of a few MB. A word is hashed eight
bytes at a time, each step a bijection of the state that is far from linear; very
long words by BLAKE2b. Windows are put together from windows of powers of two, mixed
at every step. The key is drawn anew by the caller for each run and shared by
its tasks, so no words that collide can be prepared; words that differ have equal
hashes with a chance of 2 ** -64 for each of the independent functions ``which``.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text in a chunk; a longer document is a chunk of its own.
CHUNK_BYTES = 1 << 21

#: Words of more bytes are hashed one by one.
LONG_WORD = 1 << 10

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
#: The low bytes of a 64-bit value, by their number.
_LOW_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def new_key() -> int:
    """A key for the hashes of one run."""
    return int.from_bytes(os.urandom(8), "little")


def mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit values that spreads all bits."""
    x = x + np.uint64((0x632BE59BD9B4E019 * (seed + 1)) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, key: int) -> np.ndarray:
    """A 64-bit hash of the bytes of every word."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.ndarray(len(data) + 1, "<u8", padded.data, strides=(1,))  # the eight bytes from every place on
    size = ends - starts
    state = mixed(size.astype(np.uint64) ^ np.uint64(key))
    rest, at = np.flatnonzero(size <= LONG_WORD), 0
    while len(rest):
        left = size[rest] - at
        state[rest] = mixed(state[rest] ^ (eights[starts[rest] + at] & _LOW_BYTES[np.minimum(left, 8)]))
        rest, at = rest[left > 8], at + 8
    for k in np.flatnonzero(size > LONG_WORD):
        digest = hashlib.blake2b(data[starts[k] : ends[k]].data, digest_size=8, key=key.to_bytes(8, "little"))
        state[k] = int.from_bytes(digest.digest(), "little")
    return state


def joined(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Hashes of pairs of hashes, in this order."""
    return mixed(x * np.uint64(0x9E3779B97F4A7C15) + y)


class Words:
    """The words of a run of documents: hashes, and where each document's words begin."""

    def __init__(self, data: np.ndarray, limits: np.ndarray, lower: bool, key: int) -> None:
        gap = _SPACE[data]
        edge = np.ones(len(data) + 1, bool)
        edge[1:-1] = gap[:-1] | gap[1:]
        edge[limits] = True
        self.starts = np.flatnonzero(edge[:-1] & ~gap)
        self.ends = np.flatnonzero(edge[1:] & ~gap) + 1
        self.first = np.searchsorted(self.starts, limits)
        self.data = _LOWER[data] if lower else data
        self.key = key
        self._hashes: dict[int, np.ndarray] = {}

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self, which: int = 0) -> np.ndarray:
        if which not in self._hashes:
            key = int(mixed(np.array([self.key], np.uint64), which)[0])
            self._hashes[which] = word_hashes(self.data, self.starts, self.ends, key)
        return self._hashes[which]

    def windows(self, width: int, which: int = 0) -> np.ndarray:
        """Hash of the window at every word; those that cross a document's end mean nothing."""
        n = max(0, len(self) - width + 1)
        power, span, whole, done = self.hashes(which), 1, None, 0
        while True:
            if width & span:
                part = power[done : done + n]
                whole = part if whole is None else joined(whole, part)
                done += span
            if done == width:
                return whole if width > 1 else mixed(whole)
            power, span = joined(power[:-span], power[span:]), 2 * span

    def places(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Where whole windows start, and the document of each."""
        counts = np.maximum(np.diff(self.first) - width + 1, 0)
        document = np.repeat(np.arange(len(counts)), counts)
        offset = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        return self.first[document] + offset, document


def text_chunks(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(from row, to row, bytes, document limits) of runs of rows; a null text is empty."""
    texts = batch.column(column).cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    row = 0
    while row < len(texts):
        to = int(np.searchsorted(offsets, offsets[row] + CHUNK_BYTES, "right")) - 1
        to = min(max(to, row + 1), len(texts))
        yield row, to, data[offsets[row] : offsets[to]], offsets[row : to + 1] - offsets[row]
        row = to


def word_chunks(batch: pa.RecordBatch, column: str, lower: bool, key: int) -> Iterator[tuple[int, int, Words]]:
    for row, to, data, limits in text_chunks(batch, column):
        yield row, to, Words(data, limits, lower, key)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def list_column(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from flat values and their number per row."""
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))
