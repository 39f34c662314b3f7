"""Approximate nearest neighbours with balanced posting lists.

Centroids are fitted on a bounded sample, where large clusters are parted until the
lists are even, and searched by a graph that every task holds. Each vector joins the list of its nearest centroid and, near a
boundary, those of others at nearly the same distance. A query reads the lists
whose centroids are within a ratio of its nearest one; the ratio is set on the
sample so that the neighbours wanted are found. Long lists are dealt in blocks,
many queries of a list likewise, so a task holds one block of each.

Edge cases: null and zero vectors, those with null or non-finite components and
those not of the table's most frequent length take no part; rows with the
query's own id are not its candidates; a repeated row counts once, of rows with
one id the best counts; equal scores go to the smaller id; where there are fewer
candidates than asked for, all are returned.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pixelframe.llm.common import load, store
from pixelframe.llm.jaccard import grouped
from pixelframe.llm.registry import query
from pixelframe.llm.tokens import list_column

#: About so many vectors, chosen by hash, fit the centroids and the ratio.
SAMPLE = 20_000
MAX_CENTROIDS, ROUNDS = 4096, 8
#: A list with more of the sample than this many times the mean is parted, unless it has fewer than the second.
BALANCE, LEAST_LIST = 2.0, 8
NEIGHBOURS, BEAM = 16, 24
#: A vector joins lists up to this ratio of its nearest distance, so many at most.
BOUNDARY, REPLICAS = 1.08, 4
#: Share of the sample's true neighbours that the ratio must reach.
REACH, TRIALS = 0.98, 400
#: Ids that the lists of one query hold at least.
LEAST_ROWS = 400
BLOCK_VECTORS, BLOCK_QUERIES = 4096, 1024
FOUND = "query_id long, vec_id long, score double"


class Index(NamedTuple):
    centroids: np.ndarray
    graph: np.ndarray
    ratio: float
    beam: int


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def vector_matrix(column: pa.Array) -> np.ndarray:
    """The vectors as rows, each scaled by a power of two, so that no square overflows or vanishes.

    Such a scale changes no digit of a cosine.
    """
    flat = column.flatten().to_numpy().astype(np.float64)
    x = flat.reshape(len(column), -1)
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])


def usable(table: DataFrame) -> DataFrame:
    """(vec_id, vector) of the distinct rows that take part, in double precision."""
    sizes = table.groupBy(F.size("embedding").alias("d")).agg(F.count(F.lit(1)).alias("n")).where("d > 0")
    most = sizes.orderBy(F.desc("n"), "d").first()
    if most is None:
        return table.select("vec_id", F.col("embedding").cast("array<double>").alias("vector")).limit(0)
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    fits = table.where((F.size("embedding") == most["d"]) & ~bad & some & F.col("vec_id").isNotNull())
    return fits.select("vec_id", F.col("embedding").cast("array<double>").alias("vector")).dropDuplicates()


def cluster(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """Spherical k-means; an empty cluster takes over a random vector."""
    centroids = x[rng.choice(len(x), k, replace=False)]
    for _ in range(ROUNDS):
        own = np.argmax(x @ centroids.T, axis=1)
        total = np.zeros_like(centroids)
        np.add.at(total, own, x)
        norm = np.linalg.norm(total, axis=1)
        lost = norm < 1e-12
        total[lost] = x[rng.choice(len(x), lost.sum())]
        centroids = unit(total)
    return centroids


def balanced(x: np.ndarray, centroids: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Centroids whose shares of the sample are even: a list above ``BALANCE`` times the mean is parted.

    Vectors that are all equal cannot be parted; only the work on their list is dealt.
    """
    bound = max(LEAST_LIST, math.ceil(BALANCE * len(x) / len(centroids)))
    own = np.argmax(x @ centroids.T, axis=1)
    kept, open_parts = [], [x[own == c] for c in range(len(centroids))]
    while open_parts:
        part = open_parts.pop()
        room = MAX_CENTROIDS - len(kept) - len(open_parts)
        if len(part) <= bound or room < 2:
            kept.append(unit(part.sum(axis=0, keepdims=True) + 1e-300)[0] if len(part) else None)
            continue
        halves = cluster(part, 2, rng)
        side = np.argmax(part @ halves.T, axis=1)
        if side.all() or not side.any():
            kept.append(part[0])
        else:
            open_parts += [part[side == 0], part[side == 1]]
    return np.array([c for c in kept if c is not None])


def neighbour_graph(centroids: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Nearest centroids of each, and a few random ones so that all are reached."""
    near = np.argsort(-(centroids @ centroids.T), axis=1, kind="stable")[:, 1 : NEIGHBOURS + 1]
    far = rng.integers(0, len(centroids), (len(centroids), NEIGHBOURS // 4))
    return np.concatenate([near, far], axis=1)


def walk(index: Index, x: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """(centroid, distance) of the ``beam`` best found by best-first search, nearest first.

    All rows walk at once: each step expands the best open centroid of every row.
    """
    c, rows = index.centroids, np.arange(len(x))
    beam = min(beam, len(c))
    start = np.linspace(0, len(c) - 1, min(len(c), max(beam, 8))).astype(int)
    start = np.unique(start)
    ids = np.tile(start, (len(x), 1))
    score = x @ c[start].T
    done = np.zeros(ids.shape, bool)
    seen = np.zeros((len(x), len(c)), bool)
    seen[:, start] = True
    while True:
        open_score = np.where(done, -np.inf, score)
        pick = open_score.argmax(axis=1)
        live = np.isfinite(open_score[rows, pick])
        if not live.any():
            break
        done[rows, pick] = True
        near = index.graph[ids[rows, pick]]
        fresh = ~np.take_along_axis(seen, near, axis=1) & live[:, None]
        np.put_along_axis(seen, near, True, axis=1)
        gained = np.where(fresh, np.einsum("bkd,bd->bk", c[near], x), -np.inf)
        # a centroid may stand twice among the neighbours of one; the later one is dropped
        order = np.argsort(near, axis=1, kind="stable")
        put = np.take_along_axis(near, order, axis=1)
        twin = np.zeros(near.shape, bool)
        np.put_along_axis(twin, order[:, 1:], put[:, 1:] == put[:, :-1], axis=1)
        gained[twin] = -np.inf
        ids = np.concatenate([ids, near], axis=1)
        score = np.concatenate([score, gained], axis=1)
        done = np.concatenate([done, ~np.isfinite(gained)], axis=1)
        best = np.argsort(-score, axis=1, kind="stable")[:, :beam]
        ids, score, done = (np.take_along_axis(a, best, axis=1) for a in (ids, score, done))
    order = np.argsort(-score, axis=1, kind="stable")
    ids, score = (np.take_along_axis(a, order, axis=1) for a in (ids, score))
    return ids, np.sqrt(np.maximum(0, 2 - 2 * score))


def lists_of(index: Index, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(centroid, joined): candidates of each vector and which of their lists it joins."""
    ids, distance = walk(index, x, BEAM)
    ids, distance = ids[:, :REPLICAS], distance[:, :REPLICAS]
    return ids, distance <= BOUNDARY * distance[:, :1] + 1e-12


def fit(vectors: DataFrame, k: int, rows: int = SAMPLE, seed: int = 0) -> Index:
    """Centroids, their graph and the ratio, from a bounded sample."""
    total = vectors.count()
    drawn = F.pmod(F.xxhash64("vec_id", "vector", F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    sample = vectors.where(drawn < min(1.0, rows / max(1, total))) if total > rows else vectors
    table = sample.orderBy("vec_id", "vector").toArrow().combine_chunks()
    v_ids = table["vec_id"].to_numpy()
    x = unit(vector_matrix(table["vector"].combine_chunks()))
    rng = np.random.default_rng(seed)
    centroids = cluster(x, max(1, min(MAX_CENTROIDS, int(np.ceil(np.sqrt(total))), len(x))), rng)
    centroids = balanced(x, centroids, rng)
    index = Index(centroids, neighbour_graph(centroids, rng), 1.0, len(centroids))
    asked = rng.choice(len(x), min(TRIALS, len(x)), replace=False)
    similar = x[asked] @ x.T
    similar[v_ids[asked][:, None] == v_ids[None, :]] = -np.inf
    wanted = np.argsort(-similar, axis=1, kind="stable")[:, : min(k, len(x) - 1)]
    ids, joined = lists_of(index, x)
    seen = np.maximum(0, 2 - 2 * (x[asked] @ centroids.T)) ** 0.5
    place = np.argsort(np.argsort(seen, axis=1, kind="stable"), axis=1, kind="stable")
    ratios, places = [1.0], [0]
    for q in range(len(asked)):
        for v in wanted[q][np.isfinite(similar[q, wanted[q]])]:
            reached = ids[v][joined[v]]
            ratios.append(float((seen[q, reached] / max(seen[q].min(), 1e-9)).min()))
            places.append(int(place[q, reached].min()))
    beam = int(np.quantile(places, (1 + REACH) / 2)) + BEAM
    return index._replace(ratio=float(np.quantile(ratios, REACH)), beam=min(len(centroids), beam))


def posting_rows(vectors: DataFrame, index: Index) -> DataFrame:
    """(list, vec_id, vector): every vector in each list it joins."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), BLOCK_QUERIES):
                part = batch.slice(at, BLOCK_QUERIES)
                x = vector_matrix(part.column("vector"))
                ids, joined = lists_of(index, unit(x))
                row, nth = np.nonzero(joined)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[row, nth].astype(np.int32)),
                        pa.array(part.column("vec_id").to_numpy()[row]),
                        list_column(x[row].ravel(), np.full(len(row), x.shape[1]), pa.float64()),
                    ],
                    ["list", "vec_id", "vector"],
                )

    return vectors.mapInArrow(rows, "list int, vec_id long, vector array<double>")


def query_rows(queries: DataFrame, index: Index, sizes: np.ndarray) -> DataFrame:
    """(list, query_id, vector): every query in each list it reads.

    Those within the ratio, and nearer ones until they hold ``LEAST_ROWS`` ids.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), BLOCK_QUERIES):
                part = batch.slice(at, BLOCK_QUERIES)
                x = vector_matrix(part.column("vector"))
                ids, distance = walk(index, unit(x), index.beam)
                held = np.cumsum(sizes[ids], axis=1) - sizes[ids]
                row, nth = np.nonzero((distance <= index.ratio * distance[:, :1] + 1e-12) | (held < LEAST_ROWS))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[row, nth].astype(np.int32)),
                        pa.array(part.column("vec_id").to_numpy()[row]),
                        list_column(x[row].ravel(), np.full(len(row), x.shape[1]), pa.float64()),
                    ],
                    ["list", "vec_id", "vector"],
                )

    return queries.mapInArrow(rows, "list int, vec_id long, vector array<double>")


def best_of_block(q_ids: np.ndarray, q: np.ndarray, v_ids: np.ndarray, v: np.ndarray, k: int) -> list[np.ndarray]:
    """(query, vector, score) of the k best ids of each query, scored one pair at a time.

    The matrix product only preselects, with room for its rounding: equal vectors
    must get equal scores wherever they stand. Of rows with one id the best counts.
    """
    order = np.argsort(v_ids, kind="stable")
    v_ids, v = v_ids[order], v[order]
    starts = np.flatnonzero(np.r_[True, v_ids[1:] != v_ids[:-1]])
    repeated = len(starts) < len(v_ids)
    rough = unit(q) @ unit(v).T
    rough[q_ids[:, None] == v_ids[None, :]] = -np.inf
    by_id = np.maximum.reduceat(rough, starts, axis=1) if repeated else rough
    keep = min(k, len(starts))
    least = np.partition(by_id, len(starts) - keep, axis=1)[:, len(starts) - keep]
    row, at = np.nonzero((rough >= least[:, None] - 1e-9) & np.isfinite(rough))
    norm_q, norm_v = np.sqrt((q * q).sum(axis=1)), np.sqrt((v * v).sum(axis=1))
    score = np.empty(len(row))
    for a in range(0, len(row), 1 << 16):
        r, t = row[a : a + (1 << 16)], at[a : a + (1 << 16)]
        score[a : a + (1 << 16)] = (q[r] * v[t]).sum(axis=1) / (norm_q[r] * norm_v[t])
    order = np.lexsort((v_ids[at], -score, row))
    row, at, score = row[order], at[order], score[order]
    if repeated:
        number = np.searchsorted(v_ids[starts], v_ids[at])
        best = np.sort(np.unique(row * len(starts) + number, return_index=True)[1])
        row, at, score = row[best], at[best], score[best]
    nth = np.arange(len(row)) - np.searchsorted(row, row)
    first = nth < k
    return [q_ids[row[first]], v_ids[at[first]], score[first]]


def neighbours(table: DataFrame, wanted: str, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest of each row that ``wanted`` selects."""
    spark = table.sparkSession
    vectors = store(usable(table), "vectors")
    queries = vectors.where(wanted)
    if queries.isEmpty():
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    index = fit(vectors, k)
    postings = store(posting_rows(vectors, index), "postings")
    counts = postings.groupBy("list", "vec_id").agg(F.count(F.lit(1)).alias("rows"))
    counts = store(counts.groupBy("list").agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("ids")), "list-counts")
    sizes = np.zeros(len(index.centroids), np.int64)
    for r in counts.collect():  # a row per centroid, MAX_CENTROIDS at most
        sizes[r["list"]] = r["ids"]
    asked = store(query_rows(queries, index, sizes), "list-queries")
    blocks = asked.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / BLOCK_QUERIES).alias("qb")).join(
        counts.select("list", F.ceil(F.col("rows") / BLOCK_VECTORS).alias("vb")), "list"
    )
    blocks = store(blocks, "list-blocks")

    def dealt(rows: DataFrame, own: str, other: str, kind: int) -> DataFrame:
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1)).alias(other)
        placed = rows.join(blocks, "list").select(
            "list", F.pmod(F.xxhash64("vec_id", "vector"), F.col(own)).alias("own"), every, "vec_id", "vector"
        )
        return placed.select("list", F.col("own").alias(own), other, F.lit(kind).alias("kind"), "vec_id", "vector")

    both = dealt(asked, "qb", "vb", 0).unionByName(dealt(postings, "vb", "qb", 1))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, ["list", "qb", "vb"]):
            group = group.combine_chunks()
            ids, kind = group["vec_id"].to_numpy(), group["kind"].to_numpy()
            x = vector_matrix(group["vector"].combine_chunks())
            q, v = kind == 0, kind == 1
            if q.any() and v.any():
                found = best_of_block(ids[q], x[q], ids[v], x[v], k)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], ["query_id", "vec_id", "score"])

    keys = ["list", "qb", "vb"]
    found = both.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(rows, FOUND)
    by_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    ranked = best.withColumn("rank", F.row_number().over(by_query))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


@query("op9_nearest_vectors")
def op9_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours(load(spark, sf_dir, "embeddings"), "vec_id % 50 = 0")
