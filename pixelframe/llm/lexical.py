"""Ranked lexical search by the Best Position Algorithm.

The documents' counts of the query terms are stored once. A task then takes runs
of documents, bounded by rows and postings, and sorts each term's postings of
the run by impact. For each item the impact lists are read from the top, side by
side. A document met in one list is looked up in all others by direct access,
which gives its whole score and its positions there. The best position of a list
is the last one up to which all are seen, by either access, so it lies at or below
the last position read. No unseen document scores above the sum of the impacts at
the best positions; reading stops when that sum is strictly below the k-th
score found so far, since a document that equals it could win by its id. What a
run has found is the start of the next, and the tasks' lists are merged at the end.

Items come in blocks of a bounded size, each sent to all tasks; every block is
searched against all documents.

Edge cases: a null or term-less text is no document and finds nothing; rows that
repeat an id are documents, or items, of their own; equal scores rank by id, null
ids last; a term that all documents hold may weigh nothing; other columns play no
part; empty tables give no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pixelframe.llm.common import discard, load, ranked, root_of, running_total, store
from pixelframe.llm.registry import query
from pixelframe.llm.tokens import list_column

LIMIT = 20
#: Text of the items that are searched together, and sent to all tasks.
BLOCK_BYTES = 4 << 20
#: Documents and postings whose impact lists a task holds at once.
RUN_DOCUMENTS, RUN_POSTINGS = 1 << 14, 1 << 21
#: Positions read from each list at first; the step doubles up to the second.
FIRST_STEP, LAST_STEP = 32, 1024

# Terms are runs of ASCII letters and digits and of all other characters above ASCII.
_TERMS = bytearray(b" " * 128 + bytes(range(128, 256)))
_TERMS[0x30:0x3A] = bytes(range(0x30, 0x3A))
_TERMS[0x61:0x7B] = _TERMS[0x41:0x5B] = bytes(range(0x61, 0x7B))
_TERMS = bytes(_TERMS)


class Items(NamedTuple):
    """The query terms by number, and of each item its distinct terms and how often it has them."""

    vocabulary: dict[bytes, int]
    numbers: list[int]
    terms: list[np.ndarray]
    repeats: list[np.ndarray]


class Statistics(NamedTuple):
    """Documents with terms, all their terms, and the weight of every query term."""

    documents: int
    terms: int
    weights: np.ndarray


def terms_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_TERMS).split()


def query_items(rows: list) -> Items:
    """Items from rows (rank, text); those without terms are left out."""
    vocabulary: dict[bytes, int] = {}
    numbers, terms, repeats = [], [], []
    for number, text in rows:
        counts = Counter(terms_of(text))
        if counts:
            numbers.append(number)
            terms.append(np.array([vocabulary.setdefault(t, len(vocabulary)) for t in counts], np.int64))
            repeats.append(np.array(list(counts.values()), np.int64))
    return Items(vocabulary, numbers, terms, repeats)


def term_counts(docs: DataFrame, items: Items) -> DataFrame:
    """(doc_id, n, terms, counts) of every document with terms: which query terms it has, and how often."""
    sent = docs.sparkSession.sparkContext.broadcast(items.vocabulary)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            kept, size, found, counts, cut = [], [], [], [], []
            for k, text in enumerate(batch.column("text")):
                words = terms_of(text.as_py())
                if words:
                    own = Counter(map(known.get, words))
                    own.pop(None, None)
                    kept.append(k)
                    size.append(len(words))
                    found.extend(own)
                    counts.extend(own.values())
                    cut.append(len(own))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(kept, pa.int64())),
                    pa.array(size, pa.int64()),
                    list_column(np.array(found, np.int32), cut, pa.int32()),
                    list_column(np.array(counts, np.int32), cut, pa.int32()),
                ],
                ["doc_id", "n", "terms", "counts"],
            )

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return texts.mapInArrow(rows, "doc_id long, n long, terms array<int>, counts array<int>")


def statistics(counted: DataFrame, items: Items) -> Statistics:
    """Sizes of the corpus and the weights of the query terms; the tasks' document counts are summed up."""
    width = len(items.vocabulary)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, np.int64)
        for batch in batches:
            total += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=width)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["term", "df"])

    whole = counted.agg(F.count(F.lit(1)), F.sum("n")).first()
    n, length = int(whole[0]), int(whole[1] or 0)
    found = counted.select("terms").mapInArrow(rows, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    held = np.zeros(width, np.int64)
    table = found.toArrow()  # a row per query term of the block
    held[table["term"].to_numpy()] = table["df"].to_numpy()
    weights = [math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1))) for df in held.tolist()]
    return Statistics(n, length, np.array(weights, np.int64))


class Run:
    """The impact lists of a run of documents, and direct access to them."""

    def __init__(self, n: np.ndarray, document: np.ndarray, term: np.ndarray, count: np.ndarray, known: Statistics) -> None:
        self.documents = len(n)
        norm = 75 + 25 * n * known.documents // known.terms
        impact = 1_000_000_000 * count // (1000 * count + 12 * norm[document])
        order = np.lexsort((document, -impact, term))
        self.document, self.impact = document[order], impact[order]
        self.first = np.searchsorted(term[order], np.arange(len(known.weights) + 1))
        # Direct access: the postings by term and document, with the place of each in the lists.
        key = term * self.documents + document
        by_key = np.argsort(key, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.key, self.place = key[by_key], place[by_key]

    def direct(self, terms: np.ndarray, documents: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the documents (columns) in the lists of the terms (rows), and whether they are there."""
        wanted = terms[:, None] * self.documents + documents[None]
        at = np.minimum(np.searchsorted(self.key, wanted.ravel()), len(self.key) - 1).reshape(wanted.shape)
        return self.place[at], self.key[at] == wanted


class Best:
    """The ``limit`` best (score, id) so far; higher scores, then smaller ids, null ids last."""

    def __init__(self, limit: int) -> None:
        self.limit = limit
        self.score = self.id = np.zeros(0, np.int64)
        self.null = np.zeros(0, bool)

    def least(self) -> int:
        """The score that decides, or 0 while there are too few."""
        return int(self.score[-1]) if len(self.score) == self.limit else 0

    def add(self, score: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        near = score >= max(1, self.least())
        if near.any():
            score, ids, null = (
                np.concatenate([a, b[near]]) for a, b in ((self.score, score), (self.id, ids), (self.null, null))
            )
            order = np.lexsort((ids, null, -score))[: self.limit]
            self.score, self.id, self.null = score[order], ids[order], null[order]


def best_positions(run: Run, terms: np.ndarray, weight: np.ndarray, best: Best, ids: np.ndarray, null: np.ndarray) -> int:
    """Searches a run for one item and adds to ``best``; returns how many positions were read."""
    first = run.first[terms]
    length = run.first[terms + 1] - first
    open_lists = (length > 0) & (weight > 0)
    terms, weight, first, length = terms[open_lists], weight[open_lists], first[open_lists], length[open_lists]
    if not len(terms):
        return 0
    offset = np.cumsum(length) - length
    seen = np.zeros(int(length.sum()) + 1, bool)
    scored = np.zeros(run.documents, bool)
    position = np.zeros(len(terms), np.int64)
    depth, step = 0, FIRST_STEP
    while True:
        reach = np.minimum(length, depth + step)
        reading = np.maximum(reach - depth, 0)
        starts = np.repeat(first + depth - (np.cumsum(reading) - reading), reading)
        met = np.unique(run.document[starts + np.arange(int(reading.sum()))])
        met = met[~scored[met]]
        scored[met] = True
        for k in range(0, len(met), 4096):
            part = met[k : k + 4096]
            place, there = run.direct(terms, part)
            gained = np.where(there, run.impact[place], 0)
            best.add(weight @ gained, ids[part], null[part])
            seen[(offset[:, None] + place - first[:, None])[there]] = True
        depth, step = depth + step, min(2 * step, LAST_STEP)
        limit = 0
        for i in range(len(terms)):
            if position[i] < length[i]:
                rest = seen[offset[i] + position[i] : offset[i] + length[i]]
                gap = int(rest.argmin())
                position[i] = length[i] if rest[gap] else position[i] + gap
                if position[i] < length[i]:
                    limit += int(weight[i]) * int(run.impact[first[i] + position[i] - 1])
        if limit < max(1, best.least()):
            return int(np.minimum(length, depth).sum())


def found_in_runs(counted: DataFrame, items: Items, known: Statistics, limit: int) -> DataFrame:
    """(item, doc_id, score): the best of each task."""
    sent = counted.sparkSession.sparkContext.broadcast((items.numbers, items.terms, items.repeats, known))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, terms, repeats, known = sent.value
        found = [Best(limit) for _ in numbers]
        for part in runs(batches):
            ids = part["doc_id"].fill_null(0).to_numpy()
            null = part["doc_id"].is_null().to_numpy()
            lists = part["terms"].combine_chunks()
            document = np.repeat(np.arange(len(ids)), lists.value_lengths().to_numpy())
            flat = [c.flatten().to_numpy().astype(np.int64) for c in (lists, part["counts"].combine_chunks())]
            if not len(document):
                continue
            run = Run(part["n"].to_numpy(), document, *flat, known)
            for best, own, times in zip(found, terms, repeats, strict=True):
                best_positions(run, own, times * known.weights[own], best, ids, null)
        size = [len(b.score) for b in found]
        if any(size):
            ids = pa.array(np.concatenate([b.id for b in found]), mask=np.concatenate([b.null for b in found]))
            item = pa.array(np.repeat(np.array(numbers, np.int64), size))
            yield pa.RecordBatch.from_arrays(
                [item, ids, pa.array(np.concatenate([b.score for b in found]))], ["item", "doc_id", "score"]
            )

    return counted.mapInArrow(rows, "item long, doc_id long, score long")


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Consecutive documents up to the bounds; a single one may exceed them."""
    kept: list[pa.RecordBatch] = []
    documents = postings = 0
    for batch in batches:
        size = np.cumsum(batch.column("terms").value_lengths().to_numpy())
        start = 0
        while start < len(batch):
            before = int(size[start - 1]) if start else 0
            end = int(np.searchsorted(size, before + RUN_POSTINGS - postings, "right"))
            end = min(end, len(batch), start + RUN_DOCUMENTS - documents)
            if end <= start:
                if kept:
                    yield pa.Table.from_batches(kept)
                    kept, documents, postings = [], 0, 0
                    continue
                end = start + 1
            kept.append(batch.slice(start, end - start))
            documents += end - start
            postings += int(size[end - 1]) - before
            start = end
    if kept:
        yield pa.Table.from_batches(kept)


def best_of(found: DataFrame, limit: int, parts: int) -> DataFrame:
    """The ``limit`` best rows of each item with ``rank``; first within parts of the documents, then of those."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    part = F.pmod(F.xxhash64("doc_id"), F.lit(parts))
    inside = Window.partitionBy("item", "part").orderBy(*order)
    few = found.withColumn("part", part).withColumn("rank", F.row_number().over(inside)).where(F.col("rank") <= limit)
    few = few.drop("rank", "part").withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
    return few.where(F.col("rank") <= limit)


def search(docs: DataFrame, queries: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(item_id, rank, doc_id, score): the best documents (doc_id, text) of each of ``queries`` (item_id, text)."""
    texts = queries.select("item_id", F.col("text").cast("binary").alias("text")).withColumn("all", F.lit(0))
    items = ranked(texts, "all", ["item_id", "text"], "search-items")
    items = items.withColumn("bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    items = items.withColumn("bucket", F.expr(f"rank div {root_of(queries.count())}"))
    items = running_total(store(items, "search-items"), "all", "bucket", [F.col("rank")], "bytes")
    items = store(items.select("rank", "item_id", "text", F.expr(f"before div {BLOCK_BYTES}").alias("block")), "search-blocks")
    result: DataFrame | None = None
    for block in range((items.agg(F.max("block")).first()[0] or 0) + 1):
        own = items.where(F.col("block") == block)
        wanted = query_items([(r.rank, r.text) for r in own.select("rank", "text").collect()])  # a bounded block
        counted = store(term_counts(docs, wanted), "search-counts")
        known = statistics(counted, wanted)
        found = store(found_in_runs(counted, wanted, known, limit), "search-found")
        discard(counted)
        best = best_of(found, limit, root_of(known.documents // RUN_DOCUMENTS))
        named = own.select(F.col("rank").alias("item"), "item_id")
        rows = best.join(named, "item").select("item_id", "rank", "doc_id", "score")
        result = rows if result is None else result.unionByName(rows)
    return result


OP13_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), []) AS ws FROM documents),
b AS (
  SELECT row_number() OVER () AS item, item_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), []) AS ws FROM benchmark),
q AS (SELECT item, item_id, t, count(*) AS times FROM (SELECT item, item_id, unnest(ws) AS t FROM b) GROUP BY ALL),
c AS (SELECT count(*) AS n, sum(len(ws))::BIGINT AS l FROM d WHERE len(ws) > 0),
p AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(ws) AS t FROM d) SEMI JOIN q USING (t) GROUP BY ALL),
w AS (
  SELECT t, floor(1000 * ln((2 * any_value(n) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight
  FROM p, c GROUP BY t),
m AS (SELECT r, doc_id, 100 - 25 + ((25 * len(ws)::BIGINT * n) // l) AS norm FROM d, c WHERE len(ws) > 0),
s AS (
  SELECT item, item_id, r, doc_id,
    sum(times * weight * ((1000000000 * tf) // (1000 * tf + 12 * norm)))::BIGINT AS score
  FROM q JOIN p USING (t) JOIN w USING (t) JOIN m USING (r) GROUP BY ALL),
k AS (
  SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank
  FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 20
"""


@query("op13_lexical_search", OP13_SQL)
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
