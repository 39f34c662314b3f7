"""Near-duplicate join on word shingles with token-combination prefixes.

Texts with one shingle set are one node. A global order of shingles puts rare
ones first; documents that are similar enough share two shingles within their
extended prefixes. A rare shingle is an index entry by itself; of frequent ones
only pairs are, but for large sets, whose pairs would be too many. Within an index entry, lengths and histograms of the sets bound the
overlap from above, and what passes is kept as a spanning forest, not as pairs.
Its components hold all links; each is then verified with the whole sets.

The order needs frequencies of hash classes only: a table of fixed size. It
decides how much is compared, never what is found.

Edge cases: null and word-less texts have an empty set and are linked with
nothing; a text of fewer words than a shingle is one shingle; rows with a null
id have no component; rows that repeat an id share its component where their
texts are equal; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pixelframe.llm.common import (
    components,
    fingerprint,
    hinted,
    load,
    put_back,
    same_row,
    set_aside,
    store,
    without_repeats,
)
from pixelframe.llm.registry import query
from pixelframe.llm.tokens import Words, list_column, new_key, signed, word_chunks

CLASS_BITS = 18
#: Bins of the histogram of a set, doubled while a set holds more than so many shingles a bin.
BINS, PER_BIN = 64, 12
#: Shingles in the prefixes of more documents are indexed in pairs.
FREQUENT = 1000
#: Sets of more shingles have no pairs in the index.
PAIR_SET = 256
#: Rows of an index entry that are compared at once; larger ones go by pairs of blocks.
BLOCK_ROWS = 2000
#: Shingles and documents of a component that are compared at once, likewise.
BLOCK_SHINGLES, BLOCK_DOCUMENTS = 1_500_000, 400
#: Documents of a large component that every block is compared with first.
PIVOTS = 32


def shingles(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of every shingle, in order of documents."""
    at, document = words.places(width)
    values = words.windows(width)[at]
    counts = np.diff(words.first)
    for length in range(1, width):
        short = np.flatnonzero(counts == length)
        if len(short):
            document = np.concatenate([document, short])
            values = np.concatenate([values, words.windows(length)[words.first[short]]])
    order = np.argsort(document, kind="stable")
    return document[order], values[order]


def class_ranks(docs: DataFrame, width: int, key: int) -> np.ndarray:
    """Rank of each hash class by its number of shingles in the whole corpus, rarest first."""
    shift = np.uint64(64 - CLASS_BITS)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << CLASS_BITS, np.int64)
        for batch in batches:
            for _, _, words in word_chunks(batch, "text", True, key):
                _, values = shingles(words, width)
                counts += np.bincount((values >> shift).astype(np.int64), minlength=len(counts))
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], ["class", "n"])

    counted = docs.select("text").mapInArrow(rows, "class long, n long")
    table = counted.groupBy("class").agg(F.sum("n").alias("n")).toArrow()  # 2 ** CLASS_BITS rows at most
    total = np.zeros(1 << CLASS_BITS, np.int64)
    total[table["class"].to_numpy()] = table["n"].to_numpy()
    ranks = np.empty(len(total), np.uint64)
    ranks[np.argsort(total, kind="stable")] = np.arange(len(total), dtype=np.uint64)
    return ranks


def document_sets(words: Words, width: int, ranks: np.ndarray, n: int) -> Iterator[np.ndarray]:
    """The sorted set of every document; values order as the global order does."""
    shift = np.uint64(64 - CLASS_BITS)
    document, values = shingles(words, width)
    keys = (ranks[(values >> shift).astype(np.int64)] << shift) | (values & np.uint64((1 << (64 - CLASS_BITS)) - 1))
    ends = np.searchsorted(document, np.arange(n + 1))
    for i in range(n):
        yield np.unique(keys[ends[i] : ends[i + 1]])


def bin_count(n: int) -> int:
    """A power of two; sizes that may link differ by one doubling at most."""
    bins = BINS
    while bins * PER_BIN < n:
        bins *= 2
    return bins


def set_facts(docs: DataFrame, width: int, percent: int, ranks: np.ndarray, key: int) -> DataFrame:
    """(doc_id, print, n, digest, prefix, bins) of every document."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, to, words in word_chunks(batch, "text", True, key):
                size, digest, prefix, cut, bins = [], [], [], [], []
                for s in document_sets(words, width, ranks, to - row):
                    least = (percent * len(s) + 99) // 100
                    size.append(len(s))
                    digest.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                    prefix.append(s[: len(s) - least + 2])
                    cut.append(len(prefix[-1]))
                    count = np.bincount((s % np.uint64(bin_count(len(s)))).astype(np.int64), minlength=bin_count(len(s)))
                    bins.append(np.minimum(count, 255).astype(np.uint8).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(row, to - row),
                        batch.column("print").slice(row, to - row),
                        pa.array(size, pa.int32()),
                        pa.array(digest, pa.binary()),
                        list_column(signed(np.concatenate(prefix)), cut, pa.int64()),
                        pa.array(bins, pa.binary()),
                    ],
                    ["doc_id", "print", "n", "digest", "prefix", "bins"],
                )

    texts = docs.select("doc_id", fingerprint("text").alias("print"), "text")
    return texts.mapInArrow(
        rows, "doc_id long, print long, n int, digest binary, prefix array<long>, bins binary"
    )


def index_entries(nodes: DataFrame, percent: int) -> DataFrame:
    """(entry, rows, doc_id): rare prefix shingles, and pairs of frequent ones, that meet.

    The pairs of a prefix grow with its square, so only sets up to ``PAIR_SET``
    have them; larger sets, and those that may link with a larger one, have their
    frequent shingles as entries by themselves. A link joins two sets of either kind.
    """
    tokens = nodes.where("n > 1").select("doc_id", "n", F.explode("prefix").alias("token"))
    several = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    several = store(several, "shingles-several")
    met = store(tokens.join(several, "token"), "shingles-met")
    alone = (F.col("rows") <= FREQUENT) | (100 * F.col("n") > percent * PAIR_SET)
    single = met.where(alone).select(F.col("token").alias("entry"), "doc_id")
    # Only part of a frequent shingle's rows may be entries by themselves.
    counts = single.groupBy("entry").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    single = single.join(store(counts, "singles-several"), "entry").select("entry", "rows", "doc_id")
    frequent = met.where((F.col("rows") > FREQUENT) & (F.col("n") <= PAIR_SET))
    frequent = frequent.groupBy("doc_id").agg(F.sort_array(F.collect_set("token")).alias("t"))
    first = frequent.select("doc_id", "t", F.posexplode("t").alias("at", "u"))
    pairs = first.select(
        "doc_id", "u", F.explode(F.expr("slice(t, at + 2, size(t))")).alias("v")
    ).select(F.xxhash64("u", "v").alias("entry"), "doc_id")
    pairs = store(pairs, "shingle-pairs")
    shared = pairs.groupBy("entry").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    return single.unionByName(pairs.join(store(shared, "pairs-several"), "entry").select("entry", "rows", "doc_id"))


def by_blocks(rows: DataFrame, keys: list[str], blocks: Column, spread: Column) -> DataFrame:
    """Adds (i, j): a group of several blocks is dealt to all pairs of its blocks, i <= j."""
    dealt = rows.withColumn("blocks", blocks).withColumn("own", F.pmod(spread, F.col("blocks")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    columns = [c for c in rows.columns if c not in keys]
    return dealt.select("*", other).select(
        *keys, F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), *columns
    )


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of equal keys of a sorted partition, each as one table."""
    kept: list[pa.RecordBatch] = []
    last: tuple | None = None
    for batch in batches:
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(len(batch), bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), len(batch)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if a == b:
                continue
            key = tuple(c[a] for c in columns)
            if kept and key != last:
                yield pa.Table.from_batches(kept)
                kept = []
            kept.append(batch.slice(a, b - a))
            last = key
    if kept:
        yield pa.Table.from_batches(kept)


def forest(size: np.ndarray, near: Callable[[int, np.ndarray], np.ndarray]) -> list[tuple[int, int]]:
    """Edges of a spanning forest; ``near(x, rest)`` tells which of ``rest`` are linked with x.

    Only rows not yet reached are asked for, so a tight group takes few steps.
    """
    rest, edges = np.argsort(size, kind="stable")[::-1], []
    rest = np.concatenate([rest[len(rest) // 2 :], rest[: len(rest) // 2]])  # from the middle sizes on
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            x = queue.pop()
            hit = near(x, rest)
            edges.extend((x, y) for y in rest[hit])
            queue.extend(rest[hit])
            rest = rest[~hit]
    return edges


def may_link(size: np.ndarray, raw: list[bytes], percent: int) -> Callable[[int, np.ndarray], np.ndarray]:
    """Whether sizes and histograms leave room for the overlap that a link takes."""
    width = np.array([len(r) for r in raw])
    place = np.zeros(len(raw), np.int64)
    tables = {}
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        place[rows] = np.arange(len(rows))
        tables[w] = np.frombuffer(b"".join(raw[r] for r in rows), np.uint8).reshape(-1, w).astype(np.int16)

    def folded(bins: np.ndarray, w: int) -> np.ndarray:
        """Halved where it is wider than ``w``: bins are low bits, so halves add up."""
        return bins if bins.shape[1] == w else bins[:, :w] + bins[:, w:]

    def near(x: int, rest: np.ndarray) -> np.ndarray:
        out = np.zeros(len(rest), bool)
        mine = tables[width[x]][place[x]][None]
        for w in (width[x] // 2, width[x], width[x] * 2):
            there = np.flatnonzero(width[rest] == w)
            if len(there):
                other, least = rest[there], min(w, width[x])
                apart = np.abs(folded(tables[w][place[other]], least) - folded(mine, least)).sum(axis=1)
                total = size[other] + size[x]
                overlap = np.minimum(np.minimum(size[other], size[x]), (total - apart) // 2)
                out[there] = 100 * overlap >= percent * (total - overlap)
        return out

    return near


def links(size: np.ndarray, keys: np.ndarray, percent: int) -> Callable[[int, np.ndarray], np.ndarray]:
    """Whether whole sets are similar enough, exactly."""
    _, ids = np.unique(keys, return_inverse=True)
    ends = np.concatenate([[0], np.cumsum(size)])
    mark = np.zeros(int(ids.max()) + 1, bool)
    held: dict[str, np.ndarray] = {}

    def near(x: int, rest: np.ndarray) -> np.ndarray:
        if not held or len(rest) < 0.7 * len(held["rows"]):  # forget sets that were reached since
            held["rows"] = rest
            held["ids"] = np.concatenate([ids[ends[r] : ends[r + 1]] for r in rest])
            held["owner"] = np.repeat(rest, size[rest])
        own = ids[ends[x] : ends[x + 1]]
        mark[own] = True
        shared = np.bincount(held["owner"][mark[held["ids"]]], minlength=len(size))[rest]
        mark[own] = False
        return 100 * shared >= percent * (size[rest] + size[x] - shared)

    return near


EDGES = "a long, b long"


def _edge_batch(ids: np.ndarray, edges: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = (np.array([e[k] for e in edges], np.int64) for k in (0, 1))
    return pa.RecordBatch.from_arrays([pa.array(ids[a]), pa.array(ids[b])], ["a", "b"])


def candidate_edges(entries: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """(a, b): a spanning forest of each index entry, by the bound on the overlap."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, ["entry", "i", "j"]):
            ids = group["doc_id"].to_numpy()
            size = group["n"].to_numpy().astype(np.int64)
            if edges := forest(size, may_link(size, group["bins"].to_pylist(), percent)):
                yield _edge_batch(ids, edges)

    full = entries.join(nodes.select("doc_id", "n", "bins"), "doc_id")
    blocks = F.ceil(F.col("rows") / BLOCK_ROWS)
    dealt = by_blocks(full.select("entry", "rows", "doc_id", "n", "bins"), ["entry"], blocks, F.xxhash64("doc_id"))
    keys = ["entry", "i", "j"]
    sorted_rows = dealt.drop("rows").repartition(*keys).sortWithinPartitions(*keys)
    return sorted_rows.mapInArrow(rows, EDGES).distinct()


def exact_edges(sets: DataFrame, keys: list[str], percent: int) -> DataFrame:
    """(a, b): a spanning forest of the links among the rows of each group."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, keys):
            ids = group["doc_id"].to_numpy()
            raw = group["keys"].to_pylist()
            size = np.array([len(k) // 8 for k in raw], np.int64)
            if len(ids) < 2:
                continue
            values = np.frombuffer(b"".join(raw), np.uint64)
            if edges := forest(size, links(size, values, percent)):
                yield _edge_batch(ids, edges)

    return sets.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(rows, EDGES).distinct()


def set_rows(docs: DataFrame, chosen: DataFrame, width: int, ranks: np.ndarray, key: int) -> DataFrame:
    """``chosen`` with the whole sets (``keys``) of its documents, formed anew from the texts."""
    carried = [f.name for f in chosen.schema.fields]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, to, words in word_chunks(batch, "text", True, key):
                keys = [s.tobytes() for s in document_sets(words, width, ranks, to - row)]
                columns = [batch.column(c).slice(row, to - row) for c in carried]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(keys, pa.binary())], [*carried, "keys"])

    texts = docs.select("doc_id", fingerprint("text").alias("print"), "text")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in chosen.schema.fields)
    joined = texts.join(hinted(chosen, 48), ["doc_id", "print"])
    return joined.select(*carried, "text").mapInArrow(rows, f"{schema}, keys binary")


def verified_edges(
    docs: DataFrame, nodes: DataFrame, groups: DataFrame, width: int, percent: int, ranks: np.ndarray, key: int
) -> DataFrame:
    """(a, b): links that connect what is connected, within each candidate component.

    A component too large for one task is compared block by block, each with the
    same pivots. Only documents outside its largest part are then compared
    with all blocks.
    """
    members = nodes.join(groups, nodes["doc_id"] == groups["node"]).select("doc_id", "print", "n", "component")
    weight = members.groupBy("component").agg(F.sum("n").alias("weight"), F.count(F.lit(1)).alias("count"))
    weight = store(weight, "component-weights")
    chosen = store(members.join(weight, "component"), "component-members")
    sets = store(set_rows(docs, chosen, width, ranks, key), "component-sets")
    whole = (F.col("weight") <= BLOCK_SHINGLES) & (F.col("count") <= BLOCK_DOCUMENTS)
    small = sets.where(whole)
    edges = store(exact_edges(small.select("component", "doc_id", "keys"), ["component"], percent), "component-links")
    large = sets.where(~whole)
    if large.isEmpty():
        return edges
    blocks = F.greatest(F.ceil(F.col("weight") * 2 / BLOCK_SHINGLES), F.ceil(F.col("count") / BLOCK_DOCUMENTS))
    spread = F.xxhash64("doc_id")
    own = F.pmod(spread, blocks)
    in_block = large.select("component", own.alias("block"), "doc_id", "keys")
    is_pivot = F.pmod(F.shiftright(spread, 20), F.greatest(F.lit(1), F.expr(f"count div {PIVOTS}"))) == 0
    every = F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("block")
    pivots = large.where(is_pivot).select("component", own.alias("own"), every, "doc_id", "keys")
    pivots = pivots.where("block <> own").drop("own")
    first = store(exact_edges(in_block.unionByName(pivots), ["component", "block"], percent), "large-links")
    parts = components(first, "large-parts")
    labelled = large.join(parts, large["doc_id"] == parts["node"], "left").select(
        large["component"], "weight", "count", "doc_id", "keys", F.coalesce(parts["component"], "doc_id").alias("part")
    )
    most = labelled.groupBy("component", "part").agg(F.count(F.lit(1)).alias("c")).groupBy("component").agg(F.max_by("part", "c").alias("main"))
    labelled = labelled.join(store(most, "large-main"), "component")
    outside = labelled.where("part <> main")
    if outside.isEmpty():
        return edges.unionByName(first)
    each = F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1))
    left = outside.select("component", own.alias("i"), each.alias("j"), "doc_id", "keys")
    out_blocks = store(outside.select("component", own.alias("i")).distinct(), "outside-blocks")
    right = labelled.withColumn("j", own).join(out_blocks, "component").where("part = main or i <> j")
    dealt = left.unionByName(right.select("component", "i", "j", "doc_id", "keys"))
    second = store(exact_edges(dealt, ["component", "i", "j"], percent), "outside-links")
    return edges.unionByName(first).unionByName(second)


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, print, n_shingles, component_id) of every document."""
    key = new_key()
    ranks = class_ranks(docs, width, key)
    facts = store(set_facts(docs, width, percent, ranks, key), "set-facts")
    full = facts.where("n > 0 and doc_id is not null")
    row = F.struct("doc_id", "print", "n", "prefix", "bins")
    nodes = store(full.groupBy("digest").agg(F.min_by(row, "doc_id").alias("r")).select("digest", "r.*"), "set-nodes")
    edges = candidate_edges(store(index_entries(nodes, percent), "index-entries"), nodes, percent)
    groups = components(store(edges, "candidate-edges"), "candidates")
    found = components(verified_edges(docs, nodes, groups, width, percent, ranks, key), "links")
    heads = nodes.select("digest", F.col("doc_id").alias("head"))
    heads = heads.join(found, heads["head"] == found["node"], "left")
    heads = store(heads.select("digest", F.coalesce("component", "head").alias("component_id")), "set-heads")
    known = facts.select("doc_id", "print", "n", "digest")
    alone = known.where("n = 0 or doc_id is null").select("doc_id", "print", "n", F.col("doc_id").alias("component_id"))
    linked = known.where("n > 0 and doc_id is not null").join(heads, "digest").select(*alone.columns)
    return linked.unionByName(alone).withColumnRenamed("n", "n_shingles")


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document, that of the smallest id, for each group.

    Rows without an id or without words stay; of repeated rows of an id one stays.
    """
    own = set_aside(docs, ["doc_id", "text"])
    found = store(near_duplicates(own, width, percent), "near-duplicates")
    gone = found.where("doc_id <> component_id").select(F.col("doc_id").alias("_id"), F.col("print").alias("_print")).distinct()
    gone = hinted(store(gone, "near-gone"), 16)
    kept = own.join(gone, same_row(own, gone), "left_anti")
    repeated = found.where("n_shingles > 0").groupBy("doc_id", "print").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    repeated = store(repeated.select(F.col("doc_id").alias("_id"), F.col("print").alias("_print")), "near-repeated")
    return put_back(without_repeats(kept, hinted(repeated, 16)), docs, own)


OP10_SQL = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id,
    coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x20\x09-\x0D]+'), []) AS ws FROM documents),
s AS (
  SELECT DISTINCT r, doc_id, ws[i + 1 : i + least(3, len(ws))] AS g
  FROM (SELECT r, doc_id, ws, unnest(range(0, len(ws) - least(3, len(ws)) + 1)) AS i FROM d WHERE len(ws) > 0)),
n AS (SELECT r, doc_id, count(*) AS n FROM s GROUP BY r, doc_id),
o AS (SELECT a.r AS x, b.r AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.r <> b.r GROUP BY a.r, b.r),
e AS (
  SELECT p.doc_id AS a, q.doc_id AS b FROM o JOIN n p ON p.r = x JOIN n q ON q.r = y
  WHERE 100 * c >= 90 * (p.n + q.n - c)),
t(a, b) AS (SELECT doc_id, doc_id FROM d UNION SELECT t.a, e.b FROM t JOIN e ON t.b = e.a),
m AS (SELECT a, min(b) AS component_id FROM t GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id
FROM d LEFT JOIN n USING (r) LEFT JOIN m ON m.a = d.doc_id
"""


@query("op10_ngram_jaccard", OP10_SQL)
def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(load(spark, sf_dir, "documents"), width=3, percent=90)
    return found.select("doc_id", F.col("n_shingles").cast("long").alias("n_shingles"), "component_id")
