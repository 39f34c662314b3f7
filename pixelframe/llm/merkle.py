"""Merkle manifest of a table, with membership proofs by descent from the root.

A row's leaf hashes its fields. The leaves of a group, in order, are the bottom
of a tree; the groups' subroots, in order, are the bottom of the tree above
them. The manifest stores what each digest is made of, digest-to-children
records, in pages: the records below one node, ``PAGE_LEVELS`` levels deep.

A request for a leaf descends from the root. The digits of its rank say which
child to follow; the other children are collected, and the collected segment is
reversed at the end, as proofs are read upwards. Requests that pass one page go
through it together, so every page is read once and none is read by more
requests than it has slots; what was collected above a page is handed down to it.

Ranks come from a stored range sort: no task holds a whole group.

Edge cases: a null field has a mark of its own, and a null group comes first;
null ids come before others, rows with equal ids are ordered by their leaves; repeated rows
are leaves of their own; a group of one row has its leaf as subroot, one group's
subroot is the root; texts are hashed whole; other columns play no part; an empty
table has no root and no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pixelframe.llm.common import load, ranked, store
from pixelframe.llm.registry import query

FANOUT = 2
#: Levels of a page: it has at most ``fanout ** PAGE_LEVELS`` slots.
PAGE_LEVELS = 10
#: What a document's leaf is made of, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
GROUP, ORDER = "lang", "doc_id"


class Forest(NamedTuple):
    """One tree per number ``tree``.

    sizes: (tree, n, root); pages: (tree, n, round, page, root, digests, children),
    the records of the page in ``digests`` and ``children``.
    """

    sizes: DataFrame
    pages: DataFrame | None
    rounds: int
    fanout: int
    levels: int


class Manifest(NamedTuple):
    """leaves: (group, id, leaf, tree, n, rank), a row each; groups: (group, tree, n), ``tree`` in order;
    inner: the trees of the groups; upper: the tree above them, number 0; root: its digest as hex."""

    leaves: DataFrame
    groups: DataFrame
    inner: Forest
    upper: Forest
    root: str | None


def node_hash(children: Sequence[bytes]) -> bytes:
    return hashlib.sha256("".join(c.hex() for c in children).encode()).digest()


def depth(n: int, fanout: int) -> int:
    """Levels above the leaves of a tree of ``n`` leaves."""
    levels = 0
    while n > 1:
        n, levels = -(-n // fanout), levels + 1
    return levels


def levels_of(n: int, turn: int, fanout: int, levels: int) -> int:
    """How many levels a page of this round adds to a tree of ``n`` leaves; none above its root."""
    return max(0, min(levels, depth(n, fanout) - turn * levels))


def leaf_hash(fields: Sequence[str | Column]) -> Column:
    """SHA-256 of the fields: a dash for null, else the length in bytes, a colon and the value."""
    parts = []
    for field in fields:
        value = (F.col(field) if isinstance(field, str) else field).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def page_records(nodes: list[bytes], levels: int, fanout: int) -> tuple[bytes, dict[bytes, list[bytes]]]:
    """The node that ``levels`` levels above ``nodes`` end in, and what each node on the way is made of."""
    records = {}
    for _ in range(levels):
        above = []
        for k in range(0, len(nodes), fanout):
            children = nodes[k : k + fanout]
            above.append(node_hash(children))
            records[above[-1]] = children
        nodes = above
    return nodes[0], records


def descent(root: bytes, records: dict[bytes, list[bytes]], slot: int, levels: int, fanout: int) -> list[bytes]:
    """What is not selected on the way from ``root`` down to ``slot``, read upwards, each run left to right."""
    segments, node = [], root
    for level in range(levels - 1, -1, -1):
        children, digit = records[node], slot // fanout**level % fanout
        segments.append(children[:digit] + children[digit + 1 :])
        node = children[digit]
    return [sibling for segment in reversed(segments) for sibling in segment]


def fold(leaf: bytes, rank: int, n: int, siblings: Sequence[bytes], fanout: int) -> tuple[bytes, int]:
    """The root that a leaf and its siblings give, and how many siblings it took."""
    node, used = leaf, 0
    while n > 1:
        digit = rank % fanout
        others = min(fanout, n - (rank - digit)) - 1
        run = list(siblings[used : used + others])
        node = node_hash([*run[:digit], node, *run[digit:]])
        used += others
        rank, n = rank // fanout, -(-n // fanout)
    return node, used


PAGES = "tree long, n long, round int, page long, root binary, digests array<binary>, children array<array<binary>>"


def _round(nodes: DataFrame, turn: int, fanout: int, levels: int) -> DataFrame:
    """The pages above ``nodes`` (tree, n, rank, node)."""
    slots = fanout**levels

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            roots, digests, children = [], [], []
            for n, found in zip(batch.column("n").to_pylist(), batch.column("nodes").to_pylist(), strict=True):
                root, records = page_records([x["node"] for x in found], levels_of(n, turn, fanout, levels), fanout)
                roots.append(root)
                digests.append(list(records))
                children.append(list(records.values()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("tree"),
                    batch.column("n"),
                    pa.array([turn] * len(roots), pa.int32()),
                    batch.column("page"),
                    pa.array(roots, pa.binary()),
                    pa.array(digests, pa.list_(pa.binary())),
                    pa.array(children, pa.list_(pa.list_(pa.binary()))),
                ],
                ["tree", "n", "round", "page", "root", "digests", "children"],
            )

    page = F.expr(f"rank div {slots}").alias("page")
    grouped = nodes.groupBy("tree", "n", page).agg(F.array_sort(F.collect_list(F.struct("rank", "node"))).alias("nodes"))
    return grouped.mapInArrow(rows, PAGES)


def forest(nodes: DataFrame, name: str, fanout: int = FANOUT, levels: int = PAGE_LEVELS) -> Forest:
    """The trees of stored ``nodes`` (tree, n, rank, node), where n is the tree's number of leaves."""
    most = nodes.agg(F.max("n")).first()[0] or 0
    rounds, current, pages, roots = -(-depth(most, fanout) // levels), nodes, None, []
    for turn in range(rounds + 1):
        # A tree of up to this many leaves has its root here.
        done = fanout ** (turn * levels)
        roots.append(current.where(F.col("n") <= done).select("tree", "n", F.col("node").alias("root")))
        if turn == rounds:
            break
        added = store(_round(current.where(F.col("n") > done), turn, fanout, levels), f"{name}-pages")
        pages = added if pages is None else pages.unionByName(added)
        current = added.select("tree", "n", F.col("page").alias("rank"), F.col("root").alias("node"))
    sizes = roots[0]
    for more in roots[1:]:
        sizes = sizes.unionByName(more)
    return Forest(store(sizes, f"{name}-roots"), pages, rounds, fanout, levels)


def manifest(
    df: DataFrame,
    leaf: Column,
    group: str = GROUP,
    order: str = ORDER,
    carried: Sequence[Column] = (),
    fanout: int = FANOUT,
    levels: int = PAGE_LEVELS,
) -> Manifest:
    """The stored trees of ``df``, its leaves ordered by ``order`` within ``group``, and groups by value.

    ``carried`` are further columns of the leaves, under names of their own.
    """
    rows = df.select(F.col(group).alias("group"), F.col(order).alias("id"), leaf.alias("leaf"), *carried)
    leaves = ranked(rows, "group", ["id", "leaf"], "manifest-leaves")
    sizes = leaves.groupBy("group").agg(F.count(F.lit(1)).alias("n")).withColumn("all", F.lit(0))
    groups = ranked(store(sizes, "manifest-groups"), "all", ["group"], "manifest-groups")
    groups = store(groups.select("group", F.col("rank").alias("tree"), "n"), "manifest-trees")
    numbered = groups.withColumnRenamed("group", "_of")
    leaves = leaves.join(numbered, leaves["group"].eqNullSafe(numbered["_of"])).drop("_of")
    leaves = store(leaves, "manifest-leaves")
    inner = forest(leaves.select("tree", "n", "rank", F.col("leaf").alias("node")), "manifest-inner", fanout, levels)
    count = F.lit(groups.count()).cast("long").alias("n")
    tops = inner.sizes.select(F.lit(0).cast("long").alias("tree"), count, F.col("tree").alias("rank"), F.col("root").alias("node"))
    upper = forest(tops, "manifest-upper", fanout, levels)
    top = upper.sizes.first()
    return Manifest(leaves, groups, inner, upper, bytes(top.root).hex() if top else None)


def paths(trees: Forest, wanted: DataFrame, above: DataFrame | None = None) -> DataFrame:
    """(tree, rank, siblings) of ``wanted`` (tree, rank): the descent from the roots, read upwards.

    ``above`` (tree, siblings) is what was collected above each tree's root.
    """
    fanout, levels = trees.fanout, trees.levels
    slots = fanout**levels

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                records = dict(zip(r["digests"], r["children"], strict=True))
                deep, upper = levels_of(r["n"], r["round"], fanout, levels), r["siblings"] or []
                found = [descent(r["root"], records, s % slots, deep, fanout) + upper for s in r["ranks"]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([r["tree"]] * len(found), pa.int64()),
                        pa.array([r["n"]] * len(found), pa.int64()),
                        pa.array(r["ranks"], pa.int64()),
                        pa.array(found, pa.list_(pa.binary())),
                    ],
                    ["tree", "n", "rank", "siblings"],
                )

    starts = trees.sizes.select("tree", "n")
    if above is None:
        starts = starts.withColumn("siblings", F.array().cast("array<binary>"))
    else:
        starts = starts.join(above, "tree")
    starts = starts.select("tree", "n", F.lit(0).cast("long").alias("rank"), "siblings")
    handed: DataFrame | None = None
    for turn in range(trees.rounds - 1, -1, -1):
        # A tree whose root is in this round starts here, the others go on with what they were handed.
        inside = (F.col("n") > slots**turn) & (F.col("n") <= slots ** (turn + 1))
        here = starts.where(inside) if handed is None else handed.unionByName(starts.where(inside))
        slot = F.expr(f"rank div {slots**turn}")
        asked = wanted.select("tree", slot.alias("rank")).distinct().withColumn("page", F.expr(f"rank div {slots}"))
        asked = asked.groupBy("tree", "page").agg(F.collect_list("rank").alias("ranks"))
        pages = trees.pages.where(F.col("round") == turn).join(asked, ["tree", "page"])
        upper = here.select("tree", F.col("rank").alias("page"), "siblings")
        handed = store(
            pages.join(upper, ["tree", "page"]).mapInArrow(rows, "tree long, n long, rank long, siblings array<binary>"),
            "manifest-paths",
        )
    alone = starts.where("n = 1")
    found = alone if handed is None else handed.unionByName(alone)
    return found.select("tree", "rank", "siblings")


def proofs(built: Manifest, requests: DataFrame) -> DataFrame:
    """``requests`` (tree, rank, …) with their siblings up to the root, as binary digests, and ``subroot``.

    A tree's own siblings come first, each level left to right, then those above its subroot.
    """
    trees = requests.select("tree").distinct()
    top = paths(built.upper, trees.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("rank")))
    above = store(top.select(F.col("rank").alias("tree"), "siblings"), "manifest-above")
    found = paths(built.inner, requests.select("tree", "rank"), above)
    subroots = built.inner.sizes.select("tree", F.col("root").alias("subroot"))
    return requests.join(found, ["tree", "rank"]).join(subroots, "tree")


def folded(df: DataFrame, built: Manifest, leaf: str, keep: Sequence[str], added: str = "folded_root") -> DataFrame:
    """The columns ``keep`` and the root, as hex, to which ``leaf`` folds with its siblings.

    Reads tree, rank, n and siblings; nothing is taken from the trees but their numbers of leaves.
    """
    fanout, groups = built.inner.fanout, built.groups.count()
    kept = df.select(*keep).schema
    read = ["tree", "rank", "n", "siblings"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(len(keep) + k).to_pylist() for k in range(len(read) + 1)]
            out = []
            for tree, rank, n, siblings, start in zip(*columns, strict=True):
                node, used = fold(start, rank, n, siblings, fanout)
                node, more = fold(node, tree, groups, siblings[used:], fanout)
                out.append(node.hex() if used + more == len(siblings) else None)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(out, pa.string())], [*keep, added])

    return df.select(*keep, *(F.col(c).alias(f"\0{c}") for c in read), F.col(leaf).alias("\0leaf")).mapInArrow(
        rows, kept.add(added, "string")
    )


def tampered_leaf(divisor: int = 7) -> Column:
    """The leaf of a document with 1 added to n_chars where ``divisor`` divides the CRC-32 of its id."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor == 0
    size = F.when(hit, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    return leaf_hash([size if f == "n_chars" else f for f in FIELDS])


def _coded(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen({value}::VARCHAR) || ':' || {value}::VARCHAR END"


def _leaf_sql(size: str) -> str:
    return "sha256(" + " || ".join(_coded(size if f == "n_chars" else f) for f in FIELDS) + ")"


OP12_SQL = f"""
WITH RECURSIVE c AS (
  SELECT *, xor(4294967295, list_reduce(
    list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda a, b: list_reduce(list_concat([xor(a, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
      lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END))) AS crc
  FROM documents),
f AS (
  SELECT row_number() OVER () AS r, doc_id, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g,
    {_leaf_sql("n_chars")} AS leaf,
    CASE WHEN crc % 7 = 0 THEN {_leaf_sql("(n_chars + 1)")} ELSE {_leaf_sql("n_chars")} END AS claimed
  FROM c),
l AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM f),
t(lvl, g, i, n, d) AS (
  SELECT 0, g, i, count(*) OVER (PARTITION BY g), leaf FROM l
  UNION ALL
  SELECT any_value(lvl) + 1, g, i // 2, any_value((n + 1) // 2), sha256(string_agg(d, '' ORDER BY i))
  FROM t WHERE n > 1 GROUP BY g, i // 2),
u(lvl, i, n, d) AS (
  SELECT 0, g, count(*) OVER (), d FROM t WHERE n = 1
  UNION ALL
  SELECT any_value(lvl) + 1, i // 2, any_value((n + 1) // 2), sha256(string_agg(d, '' ORDER BY i))
  FROM u WHERE n > 1 GROUP BY i // 2),
s AS (
  SELECT l.r, t.lvl, t.i % 2 AS digit, o.d FROM l
  JOIN t ON t.g = l.g AND t.n > 1 AND t.i = l.i // (2 ** t.lvl)::BIGINT
  LEFT JOIN t o ON o.g = t.g AND o.lvl = t.lvl AND o.i = xor(t.i, 1)
  UNION ALL
  SELECT l.r, 1000 + u.lvl, u.i % 2, o.d FROM l
  JOIN u ON u.n > 1 AND u.i = l.g // (2 ** u.lvl)::BIGINT
  LEFT JOIN u o ON o.lvl = u.lvl AND o.i = xor(u.i, 1)),
p AS (
  SELECT r, sha256(coalesce(string_agg(d, '' ORDER BY lvl), '')) AS proof,
    list(digit::VARCHAR || coalesce(d, '') ORDER BY lvl) AS steps FROM s GROUP BY r),
x AS (
  SELECT l.doc_id, l.leaf, t.d AS subroot, u.d AS root, coalesce(proof, sha256('')) AS proof_sha256,
    list_reduce(list_concat([claimed], coalesce(steps, [])), lambda a, b:
      sha256(CASE WHEN b[1] = '0' THEN a || b[2:] ELSE b[2:] || a END)) AS folded_root
  FROM l JOIN t ON t.g = l.g AND t.n = 1 JOIN u ON u.n = 1 LEFT JOIN p USING (r))
SELECT *, folded_root = root AS verified FROM x
"""


@query("op12_merkle_manifest", OP12_SQL)
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    built = manifest(docs, leaf_hash(FIELDS), carried=[tampered_leaf().alias("claimed")])
    found = proofs(built, built.leaves)
    siblings = F.array_join(F.transform("siblings", lambda d: F.lower(F.hex(d))), "")
    listed = found.withColumns(
        {
            "doc_id": F.col("id"),
            "leaf": F.lower(F.hex("leaf")),
            "subroot": F.lower(F.hex("subroot")),
            "root": F.lit(built.root),
            "proof_sha256": F.sha2(siblings.cast("binary"), 256),
        }
    )
    result = folded(listed, built, "claimed", ["doc_id", "leaf", "subroot", "root", "proof_sha256"])
    return result.withColumn("verified", F.col("folded_root").eqNullSafe(F.col("root")))
