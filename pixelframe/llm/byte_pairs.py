"""Byte-level BPE encoding and decoding by a two-tier lookup.

A text is split by the vocabulary's pattern. A minimal perfect hash over all
tokens, a displacement per bucket of keys, resolves the pieces that are tokens
themselves: one probe and one comparison for each distinct piece of a chunk.
The other pieces are merged from single bytes, kept as a linked list, with a heap
of the adjacent pairs by rank, leftmost first among equals; a pair that has
changed since it was pushed is passed over.

The vocabulary is read on the driver and sent to the tasks; its size is checked.
A worker remembers merged pieces up to a fixed number.

Edge cases: a null text is empty and has no ids; bytes that are no UTF-8 become
U+FFFD; repeated rows and ids are encoded each; other columns are carried only
where asked for, under any name; an empty table gives no rows; a piece of any
length is merged in n log n steps.
"""

from __future__ import annotations

import base64
import heapq
import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator, Sequence
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from pixelframe.llm.common import load
from pixelframe.llm.registry import query

#: A vocabulary is sent to every task; beyond this size it is refused.
VOCABULARY_BYTES = 64 << 20
#: Merged pieces of each of two generations that a worker remembers, and the longest piece among them.
REMEMBERED, REMEMBERED_BYTES = 200_000, 64
#: Bytes of text or ids that are worked on at once; longer ones are a chunk of their own.
CHUNK_BYTES = 1 << 20
BUCKET_KEYS = 4


class PerfectHash:
    """Maps each of n byte strings to a slot of its own below n; others to any slot.

    Keys are dealt to buckets; from the fullest bucket on, each gets the first
    displacement that puts all its keys on free slots.
    """

    def __init__(self, keys: Sequence[bytes]) -> None:
        self.n = len(keys)
        self.buckets = max(1, self.n // BUCKET_KEYS)
        self.shift = np.zeros(self.buckets, np.uint64)
        low, high = self._hashes(keys)
        bucket = (low % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        ends = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
        free = np.ones(self.n, bool)
        for b in np.argsort(ends[:-1] - ends[1:], kind="stable"):
            rows = order[ends[b] : ends[b + 1]]
            if len(rows):
                self._settle(b, low[rows], high[rows], free)

    def _settle(self, bucket: int, low: np.ndarray, high: np.ndarray, free: np.ndarray) -> None:
        first, tries = 0, 8
        while True:
            shift = np.arange(first, first + tries, dtype=np.uint64)[:, None]
            slots = self._slots(low, high, shift)
            for t in np.flatnonzero(free[slots].all(axis=1)).tolist():
                if len(set(slots[t].tolist())) == len(low):
                    self.shift[bucket] = first + t
                    free[slots[t]] = False
                    return
            first, tries = first + tries, min(2 * tries, 1 << 14)

    def _hashes(self, keys: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        import xxhash

        raw = b"".join(map(xxhash.xxh3_128_digest, keys))
        pairs = np.frombuffer(raw, ">u8").astype(np.uint64).reshape(-1, 2)
        return pairs[:, 0], pairs[:, 1]

    def _slots(self, low: np.ndarray, high: np.ndarray, shift: np.ndarray) -> np.ndarray:
        x = (high + shift * np.uint64(0x9E3779B97F4A7C15)) ^ (low >> np.uint64(29))
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return ((x ^ (x >> np.uint64(32))) % np.uint64(max(1, self.n))).astype(np.int64)

    def slots(self, keys: Sequence[bytes]) -> np.ndarray:
        low, high = self._hashes(keys)
        return self._slots(low, high, self.shift[(low % np.uint64(self.buckets)).astype(np.int64)])


class Vocabulary(NamedTuple):
    """Tokens and ids by their slots in the hash, the pattern, and the letters and digits it does not take as such.

    ``merged`` has the pieces merged lately, by age. A worker keeps the value it
    was sent, so what one task has merged is known to its next ones.
    """

    hash: PerfectHash
    tokens: list[bytes]
    ids: np.ndarray
    pattern: str
    late: str
    merged: list[dict[bytes, bytes]]


def read_ranks(path: str) -> dict[bytes, int]:
    """The rank of each token from a file of base64 tokens and ranks."""
    with open(path, "rb") as lines:
        raw = lines.read(VOCABULARY_BYTES + 1)
    if len(raw) > VOCABULARY_BYTES:
        raise ValueError(f"the vocabulary is larger than {VOCABULARY_BYTES} bytes")
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, raw.splitlines())}


@lru_cache
def late_characters(pattern: str) -> str:
    """Letters and digits that ``regex`` knows and the tokenizer library's own Unicode tables do not.

    The library is asked about characters newer than this Python's tables; without it, none are late.
    """
    import regex

    try:
        import tiktoken
    except ImportError:
        return ""
    newer = "".join(c for c in map(chr, range(0x110000)) if unicodedata.category(c) == "Cn")
    late = []
    for kind, beside in ((r"\p{L}", "a"), (r"\p{N}", "1")):
        found = regex.findall(kind, newer)
        ranks = {bytes([i]): i for i in range(256)} | {(beside + c).encode(): 256 + i for i, c in enumerate(found)}
        own = tiktoken.Encoding("late", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        late += [c for c in found if len(own.encode_ordinary(beside + c)) > 1]
    return "".join(sorted(late))


def vocabulary(path: str, pattern: str) -> Vocabulary:
    ranks = read_ranks(path)
    if missing := [b for b in range(256) if bytes([b]) not in ranks]:
        raise ValueError(f"the vocabulary lacks the bytes {missing}")
    found = PerfectHash(list(ranks))
    tokens = [b""] * len(ranks)
    for token, slot in zip(ranks, found.slots(list(ranks)).tolist(), strict=True):
        tokens[slot] = token
    ids = np.array([ranks[t] for t in tokens], np.uint32)
    return Vocabulary(found, tokens, ids, pattern, late_characters(pattern), [{}, {}])


def ranges(characters: str) -> str:
    """Sorted characters as the inside of a pattern's class."""
    codes = np.array([*map(ord, characters)], np.int64)
    cuts = np.flatnonzero(np.diff(codes) > 1) + 1
    return "".join(f"\\U{run[0]:08x}-\\U{run[-1]:08x}" for run in np.split(codes, cuts) if len(run))


class Splitter:
    """Splits texts by the pattern; ASCII texts by the standard library, which is faster there."""

    def __init__(self, pattern: str, late: str) -> None:
        import regex

        self.plain = regex.compile(pattern).findall
        ascii_only = pattern.replace(r"[^\s\p{L}\p{N}]", r"[^\sA-Za-z0-9]")
        ascii_only = ascii_only.replace(r"\p{L}", "[A-Za-z]").replace(r"\p{N}", "[0-9]")
        self.ascii = self.plain if r"\p" in ascii_only else re.compile(ascii_only).findall
        listed = ranges(late)
        self.late = re.compile(f"[{listed}]").search if late else lambda text: None
        other = rf"[[^\s\p{{L}}\p{{N}}]||[{listed}]]"
        parts = pattern.replace(r"[^\s\p{L}\p{N}]", "\0")
        for kind in (r"\p{L}", r"\p{N}"):
            parts = parts.replace(kind, f"[{kind}--[{listed}]]")
        self.careful = regex.compile("(?V1)" + parts.replace("\0", other)).findall if late else self.plain

    def __call__(self, text: str) -> list[str]:
        if text.isascii():
            return self.ascii(text)
        return self.careful(text) if self.late(text) else self.plain(text)


def merged(piece: bytes, ranks: dict[bytes, int], longest: int) -> list[int]:
    """The ids of a piece: the adjacent pair of lowest rank is joined until none has a rank."""
    n = len(piece)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, end = heapq.heappop(heap)
        j = after[i]
        if j < 0 or j >= n or after[j] != end:
            continue
        after[i], after[j] = end, -1
        if end < n:
            before[end] = i
            stop = after[end]
            if stop - i <= longest and (r := ranks.get(piece[i:stop])) is not None:
                heapq.heappush(heap, (r, i, stop))
        p = before[i]
        if p >= 0 and end - p <= longest and (r := ranks.get(piece[p:end])) is not None:
            heapq.heappush(heap, (r, p, end))
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : after[i]]])
        i = after[i]
    return ids


class Encoder:
    """Both tiers, for one task."""

    def __init__(self, words: Vocabulary) -> None:
        self.table = words
        self.split = Splitter(words.pattern, words.late)
        self.ranks = dict(zip(words.tokens, words.ids.tolist(), strict=True))
        self.longest = max(map(len, words.tokens))

    def _miss(self, piece: bytes) -> bytes:
        young, old = self.table.merged
        found = young.get(piece)
        if found is None:
            found = old.get(piece) or np.array(merged(piece, self.ranks, self.longest), "<u4").tobytes()
            if len(piece) <= REMEMBERED_BYTES:
                if len(young) >= REMEMBERED:
                    self.table.merged[:] = {}, young
                    young = self.table.merged[0]
                young[piece] = found
        return found

    def __call__(self, texts: Sequence[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        index: defaultdict[str, int] = defaultdict()
        index.default_factory = index.__len__  # the next number, for a piece not seen yet
        counts, parts = [], []
        for text in texts:
            pieces = self.split(text)
            counts.append(len(pieces))
            parts.append(np.fromiter(map(index.__getitem__, pieces), np.int64, len(pieces)))
        if not index:
            return [b""] * len(texts)
        distinct = [p.encode() for p in index]
        slots = self.table.hash.slots(distinct)
        tokens = self.table.tokens
        hit = np.array([tokens[s] == d for s, d in zip(slots.tolist(), distinct, strict=True)])
        size, first = np.ones(len(distinct), np.int64), np.arange(len(distinct))
        extra, after = [], len(distinct)
        for k in np.flatnonzero(~hit).tolist():
            extra.append(self._miss(distinct[k]))
            size[k], first[k] = len(extra[-1]) // 4, after
            after += len(extra[-1]) // 4
        flat = np.concatenate([self.table.ids[slots], np.frombuffer(b"".join(extra), "<u4")])
        at = np.concatenate(parts)
        lengths = size[at]
        ends = np.cumsum(lengths)
        ids = flat[np.repeat(first[at] - (ends - lengths), lengths) + np.arange(int(ends[-1]))].astype("<u4")
        borders = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        return [ids[a:b].tobytes() for a, b in zip(borders, borders[1:], strict=False)]


def _carried(df: DataFrame, keep: Sequence[str], added: str) -> StructType:
    return StructType([df.schema[c] for c in keep] + [StructField(added, BinaryType())])


def _chunks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose last column, binary, has some ``CHUNK_BYTES`` together."""
    size = pc.binary_length(batch.column(batch.num_columns - 1)).fill_null(0).to_numpy(zero_copy_only=False)
    of = (np.cumsum(size) - size) // CHUNK_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(of)) + 1).tolist(), len(batch)]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if a < b:
            yield batch.slice(a, b - a)


def encode(df: DataFrame, words: Vocabulary, keep: Sequence[str], text: str = "text", ids: str = "ids") -> DataFrame:
    """The columns ``keep`` and the ids of ``text``, packed as little-endian unsigned 32-bit integers."""
    sent = df.sparkSession.sparkContext.broadcast(words)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(sent.value)
        for batch in batches:
            for part in _chunks(batch):
                raw = part.column(part.num_columns - 1).to_pylist()
                packed = encoder([b.decode("utf-8", "replace") if b else "" for b in raw])
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(packed, pa.binary())], [*keep, ids])

    plain = df.select(*keep, F.col(text).cast("binary").alias("\0text"))
    return plain.mapInArrow(rows, _carried(df, keep, ids))


def decode(df: DataFrame, words: Vocabulary, keep: Sequence[str], ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """The columns ``keep`` and the bytes that packed ``ids`` stand for; none for null."""
    sent = df.sparkSession.sparkContext.broadcast(words)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = dict(zip(sent.value.ids.tolist(), sent.value.tokens, strict=True))
        for batch in batches:
            for part in _chunks(batch):
                raw = part.column(part.num_columns - 1).to_pylist()
                texts = [b"".join(map(table.__getitem__, np.frombuffer(b or b"", "<u4").tolist())) for b in raw]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(texts, pa.binary())], [*keep, decoded])

    return df.select(*keep, F.col(ids).alias("\0ids")).mapInArrow(rows, _carried(df, keep, decoded))


@query("op11_byte_pairs")
def op11_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    words = vocabulary(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    encoded = encode(load(spark, sf_dir, "documents"), words, ["doc_id"])
    decoded = decode(encoded, words, ["doc_id", "ids"])
    return decoded.select(
        "doc_id",
        F.expr("octet_length(ids) div 4").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
