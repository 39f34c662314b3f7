"""The manifest against trees built by hand, over fan-outs, sizes and odd rows."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from pixelframe.llm import merkle

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, rank string, leaf string, tree int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    i, text, lang, source, size = row[:5]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, source, lang, size, text)))


def tree_of(leaves, fanout):
    """All levels, the leaves first."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        low = levels[-1]
        levels.append([sha("".join(low[k : k + fanout])) for k in range(0, len(low), fanout)])
    return levels


def path_of(levels, rank, fanout):
    """(digit, siblings) of each level upwards."""
    steps = []
    for level in levels[:-1]:
        start = rank - rank % fanout
        run = level[start : start + fanout]
        steps.append((rank % fanout, run[: rank % fanout] + run[rank % fanout + 1 :]))
        rank //= fanout
    return steps


def expected(rows, fanout):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees, kept = [], []
    for name in names:
        kept.append(sorted(groups[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r))))
        trees.append(tree_of([leaf_of(r) for r in kept[-1]], fanout))
    top = tree_of([t[-1][0] for t in trees], fanout)
    out = []
    for g, (tree, members) in enumerate(zip(trees, kept, strict=True)):
        for rank, row in enumerate(members):
            steps = path_of(tree, rank, fanout) + path_of(top, g, fanout)
            i, text, lang, source, size = row[:5]
            hit = i is not None and size is not None and zlib.crc32(str(i).encode()) % 7 == 0
            node = leaf_of((i, text, lang, source, size + 1)) if hit else leaf_of(row)
            for digit, run in steps:
                node = sha("".join(run[:digit] + [node] + run[digit:]))
            siblings = [x for _, run in steps for x in run]
            root = top[-1][0]
            out.append((i, leaf_of(row), tree[-1][0], root, sha("".join(siblings)), node, node == root))
    return out


def table(seed, sizes):
    rng = random.Random(seed)
    rows = []
    for lang, n in sizes.items():
        for _ in range(n):
            i = rng.choice([None, *range(3 * n)])
            text = rng.choice([None, "", "é: 5", "x" * rng.randint(1, 3000)])
            rows.append((i, text, lang, rng.choice([None, "a", "-"]), rng.choice([None, 0, 7]), "r", "l", 1))
    rng.shuffle(rows)
    return rows + rows[:2]


@pytest.mark.parametrize(
    "fanout,levels,sizes",
    [
        (2, 10, {None: 5, "": 1, "de": 33, "én": 2, "z": 1}),
        (2, 2, {"a": 70, "b": 17, "c": 4, "d": 5, "e": 1, "f": 16}),
        (3, 2, {"a": 100, "b": 9, "c": 10}),
        (2, 1, {"only": 13}),
        (5, 1, {str(k): 1 for k in range(30)}),
    ],
)
def test_proofs(spark, fanout, levels, sizes):
    rows = table(len(sizes), sizes)
    docs = spark.createDataFrame(rows, COLUMNS)
    built = merkle.manifest(
        docs, merkle.leaf_hash(merkle.FIELDS), carried=[merkle.tampered_leaf().alias("claimed")], fanout=fanout, levels=levels
    )
    found = merkle.proofs(built, built.leaves)
    listed = merkle.folded(found, built, "claimed", ["id", "leaf", "subroot", "siblings"]).collect()
    got = []
    for r in listed:
        siblings = "".join(bytes(s).hex() for s in r.siblings)
        got.append((r.id, r.leaf.hex(), r.subroot.hex(), built.root, sha(siblings), r.folded_root, r.folded_root == built.root))
    key = lambda x: tuple(map(str, x))
    assert sorted(got, key=key) == sorted(expected(rows, fanout), key=key)


def test_some_requests(spark):
    """Few requests read few pages, and get what all requests get."""
    docs = spark.createDataFrame(table(3, {"a": 90, "b": 20}), COLUMNS)
    built = merkle.manifest(docs, merkle.leaf_hash(merkle.FIELDS), levels=3)
    everything = {(r.tree, r.rank): r.siblings for r in merkle.proofs(built, built.leaves).collect()}
    some = built.leaves.where("rank % 31 = 3")
    found = merkle.proofs(built, some).collect()
    assert len(found) == some.count() and all(everything[r.tree, r.rank] == r.siblings for r in found)
    cut = merkle.proofs(built, some).withColumn("siblings", F.expr("slice(siblings, 1, size(siblings) - 1)"))
    assert {r.folded_root for r in merkle.folded(cut, built, "leaf", ["id"]).collect()} != {built.root}


def test_query(spark, tmp_path):
    rows = table(4, {"a": 40, None: 3})
    spark.createDataFrame(rows, COLUMNS).write.parquet(str(tmp_path / "full" / "documents.parquet"))
    got = [tuple(r) for r in merkle.op12_merkle_manifest(spark, str(tmp_path / "full")).collect()]
    key = lambda x: tuple(map(str, x))
    assert sorted(got, key=key) == sorted(expected(rows, 2), key=key)
    assert any(not r[-1] for r in got) and any(r[-1] for r in got)
    spark.createDataFrame([], COLUMNS).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert merkle.op12_merkle_manifest(spark, str(tmp_path / "none")).count() == 0
