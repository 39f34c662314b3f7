"""Substring dedup with difference-cover anchors.

Only windows of ``ANCHOR`` words that start at cover positions, modulo the
period, are hashed. Two equal windows of ``WINDOW`` words at any two positions
share an anchor at the same offset, because every difference modulo the period
is one of two cover elements. Anchors that stand in several documents are
extended to the windows around them, which are compared by two independent keyed
hashes of 96 bits together, and words of windows that a smaller id holds are
removed.

Edge cases: null and short texts hold no window; a null id is no smaller id and
loses nothing; rows with equal ids don't remove from each other; repeated words
and overlapping windows count each word once; empty tables give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pixelframe.llm.common import discard, fingerprint, load, store
from pixelframe.llm.registry import query
from pixelframe.llm.tokens import Words, new_key, signed, text_chunks, word_chunks

WINDOW = 13
#: Every difference modulo 7 is one of two elements of {1, 2, 4}.
PERIOD, COVER = 7, (1, 2, 4)
ANCHOR = WINDOW - PERIOD + 1
_IN_COVER = np.isin(np.arange(PERIOD), COVER)


def cover_anchors(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, document, hash) of the anchors of all documents that hold a window."""
    at, document = words.places(ANCHOR)
    long_enough = np.diff(words.first) >= WINDOW
    keep = _IN_COVER[(at - words.first[document]) % PERIOD] & long_enough[document]
    at, document = at[keep], document[keep]
    return at, document, words.windows(ANCHOR)[at]


def anchor_rows(docs: DataFrame, key: int) -> DataFrame:
    """(h, doc_id), each anchor of a document once."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            for row, _, words in word_chunks(batch, "text", False, key):
                _, document, h = cover_anchors(words)
                order = np.lexsort((h, document))
                document, h = document[order], h[order]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (document[1:] != document[:-1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(h[new])), pa.array(ids[row + document[new]])], ["h", "doc_id"]
                )

    known = docs.where("doc_id is not null and text is not null").select("doc_id", "text")
    return known.mapInArrow(rows, "h long, doc_id long")


def window_rows(docs: DataFrame, key: int) -> DataFrame:
    """(a, b, doc_id, place): windows around the anchors listed in ``shared``.

    The two hashes have 96 bits together; ``place`` holds 32 bits of the text's
    fingerprint above the start, which tells texts with one id apart.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, prints = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "print"))
            prints = prints << 32
            shared = batch.column("shared")
            for row, to, words in word_chunks(batch, "text", False, key):
                at, document, h = cover_anchors(words)
                wanted = shared.slice(row, to - row)
                ends = np.searchsorted(document, np.arange(to - row + 1))
                marked = np.zeros(len(words) + 1, np.int64)
                for i in range(to - row):
                    own = slice(ends[i], ends[i + 1])
                    hit = at[own][np.isin(signed(h[own]), wanted[i].values.to_numpy())]
                    first = np.maximum(hit - (PERIOD - 1), words.first[i])
                    np.add.at(marked, first, 1)
                    np.add.at(marked, hit + 1, -1)
                places, document = words.places(WINDOW)
                inside = np.cumsum(marked)[places] > 0
                places, document = places[inside], document[inside]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(signed(words.windows(WINDOW)[places])),
                        pa.array((words.windows(WINDOW, 1)[places] >> np.uint64(32)).astype(np.uint32).view(np.int32)),
                        pa.array(ids[row + document]),
                        pa.array(prints[row + document] | (places - words.first[document])),
                    ],
                    ["a", "b", "doc_id", "place"],
                )

    return docs.mapInArrow(rows, "a long, b int, doc_id long, place long")


def repeated_windows(docs: DataFrame) -> DataFrame:
    """(doc_id, print, starts), 32 bits of the print: windows whose word sequence a smaller id holds as well."""
    key = new_key()
    first = (
        anchor_rows(docs, key).groupBy("h").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    )
    several = store(first.where("low < high").select("h"), "anchors-several")
    shared = store(
        anchor_rows(docs, key).join(several, "h").groupBy("doc_id").agg(F.collect_set("h").alias("shared")),
        "anchors-shared",
    )
    discard(several)
    texts = docs.select("doc_id", fingerprint("text").alias("print"), "text").where("doc_id is not null")
    windows = store(window_rows(texts.join(shared, "doc_id"), key), "anchor-windows")
    discard(shared)
    least = (
        windows.groupBy("a", "b").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
        .where("low < high").drop("high")
    )
    least = store(least, "windows-least")
    starts = (
        windows.join(least, ["a", "b"]).where("doc_id > low")
        .select("doc_id", F.shiftright("place", 32).alias("print"), F.expr("int(place & 2147483647)").alias("start"))
        .groupBy("doc_id", "print").agg(F.collect_set("start").alias("starts"))
    )
    starts = store(starts, "windows-starts")
    discard(windows)
    discard(least)
    return starts


def kept_text(docs: DataFrame, with_text: bool) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept): ``kept`` joins the words outside ``starts``."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts = batch.column("starts")
            for row, to, data, limits in text_chunks(batch, "text"):
                total, removed, kept = [], [], []
                raw = data.tobytes()
                for i in range(to - row):
                    words = raw[limits[i] : limits[i + 1]].split()
                    total.append(len(words))
                    gone = 0
                    if starts[row + i].is_valid:
                        edge = np.zeros(len(words) + 1, np.int64)
                        at = starts[row + i].values.to_numpy()
                        edge[at] += 1
                        edge[at + WINDOW] -= 1
                        stay = np.cumsum(edge)[:-1] == 0
                        gone = int(len(words) - stay.sum())
                        words = [words[j] for j in np.flatnonzero(stay)]
                    removed.append(gone)
                    kept.append(b" ".join(words))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(row, to - row),
                        pa.array(total, pa.int64()),
                        pa.array(removed, pa.int64()),
                        pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
                        pa.array(kept if with_text else [b""] * len(kept), pa.binary()).cast(pa.string()),
                    ],
                    ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"],
                )

    return docs.mapInArrow(
        rows, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"
    )


def remove_repeats(docs: DataFrame, with_text: bool = True) -> DataFrame:
    """A row per document: word counts, the digest of the kept words and, if asked for, the words."""
    starts = repeated_windows(docs).withColumnsRenamed({"doc_id": "_id", "print": "_print"})
    texts = docs.select("doc_id", fingerprint("text").alias("print"), "text")
    half = F.shiftright(F.shiftleft("print", 32), 32)
    same = (F.col("doc_id") == F.col("_id")) & (half == F.col("_print"))
    return kept_text(texts.join(starts, same, "left").select("doc_id", "text", "starts"), with_text)


OP6_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS ws FROM documents),
w AS (
  SELECT r, doc_id, s, ws[s + 1 : s + {WINDOW}] AS win
  FROM (SELECT r, doc_id, ws, unnest(range(0, len(ws) - {WINDOW - 1})) AS s FROM d WHERE len(ws) >= {WINDOW})),
m AS (SELECT win, min(doc_id) AS low FROM w GROUP BY win HAVING min(doc_id) < max(doc_id)),
g AS (SELECT DISTINCT r, unnest(range(s, s + {WINDOW})) AS p FROM w JOIN m USING (win) WHERE doc_id > low),
a AS (SELECT r, list(p) AS ps FROM g GROUP BY r),
k AS (
  SELECT r, string_agg(word, ' ' ORDER BY p) AS kept
  FROM (SELECT r, unnest(ws) AS word, unnest(range(0, len(ws))) AS p FROM d) x
  WHERE NOT EXISTS (SELECT 1 FROM g WHERE g.r = x.r AND g.p = x.p) GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(len(ps), 0)::BIGINT AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN a USING (r) LEFT JOIN k USING (r)
"""


@query("op6_substring_dedup", OP6_SQL)
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(load(spark, sf_dir, "documents"), with_text=False).drop("kept")
