"""Ranked search against all scores, with small runs and blocks, and the stopping rule."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from pixelframe.llm import lexical

WORDS = [f"w{i}" for i in range(60)]
COLUMNS = "doc_id long, text string, rank string, terms int, n int, item long"


def terms(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute(docs, items, limit):
    held = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs if terms(t)]
    n, total = len(held), sum(size for *_, size in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        rows = []
        for i, counts, size in held:
            m, score = 75 + 25 * size * n // total, 0
            for t in terms(text):
                if counts[t]:
                    weight = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                    score += weight * (1_000_000_000 * counts[t] // (1000 * counts[t] + 12 * m))
            if score > 0:
                rows.append((-score, i is None, i or 0, i))
        out += [(item, k + 1, i, -s) for k, (s, _, _, i) in enumerate(sorted(rows)[:limit])]
    return out


def tables(seed, n=150):
    rng = random.Random(seed)
    weights = [1 / (k + 1) for k in range(len(WORDS))]
    texts = [" ".join(rng.choices(WORDS, weights, k=rng.randint(1, 60))) for _ in range(n)]
    docs = list(enumerate(texts)) + [(None, texts[3]), (3, texts[3]), (500, texts[3]), (501, None), (502, " .,"), (503, "É-é W1_w2")]
    items = [(k, rng.choice(texts).upper()) for k in range(12)]
    items += [(12, "absent words"), (13, None), (14, ""), (15, "é"), (15, "w59"), (None, "w7 w8-w7"), (16, "w0 " * 40)]
    return docs, items


def searched(spark, docs, items, limit):
    found = lexical.search(
        spark.createDataFrame([(*d, "r", 1, 2, 3) for d in docs], COLUMNS),
        spark.createDataFrame([(*i, "x", 9) for i in items], "item_id long, text string, doc_id string, score int"),
        limit,
    )
    return sorted((tuple(r) for r in found.collect()), key=str)


@pytest.mark.parametrize("limit", [1, 20])
def test_search(spark, limit):
    docs, items = tables(limit)
    assert searched(spark, docs, items, limit) == sorted(brute(docs, items, limit), key=str)


def test_small_bounds(spark, monkeypatch):
    """Runs of few documents or postings, steps of one position, several blocks of items."""
    docs, items = tables(5)
    expected = sorted(brute(docs, items, 7), key=str)
    for name, value in (("RUN_DOCUMENTS", 11), ("RUN_POSTINGS", 90), ("FIRST_STEP", 1), ("LAST_STEP", 2), ("BLOCK_BYTES", 900)):
        monkeypatch.setattr(lexical, name, value)
    assert searched(spark, docs, items, 7) == expected


def test_empty(spark):
    docs, items = tables(6, n=5)
    assert searched(spark, [], items, 20) == searched(spark, docs, [], 20) == searched(spark, [(1, None)], items, 20) == []


def run_of(counts, n):
    """A run from a matrix of counts (documents, terms)."""
    document, term = np.nonzero(counts)
    weights = np.full(counts.shape[1], 100, np.int64)
    known = lexical.Statistics(len(n), int(n.sum()), weights)
    return lexical.Run(n, document, term, counts[document, term], known), known


def test_stops_early():
    """Three documents stand out in both lists, and the other two lists' depths are not read."""
    counts = np.ones((4000, 2), np.int64)
    counts[[7, 70, 700]] = 50
    n = np.full(4000, 100, np.int64)
    run, known = run_of(counts, n)
    best = lexical.Best(3)
    read = lexical.best_positions(run, np.array([0, 1]), known.weights, best, np.arange(4000), np.zeros(4000, bool))
    assert best.id.tolist() == [7, 70, 700] and read <= 2 * lexical.FIRST_STEP


def test_ties_are_read_to_the_end():
    """While the bound equals the least score, an unread document could win by its id."""
    counts = np.ones((500, 1), np.int64)
    run, known = run_of(counts, np.full(500, 10, np.int64))
    best = lexical.Best(2)
    ids = np.arange(500)[::-1].copy()
    read = lexical.best_positions(run, np.array([0]), known.weights, best, ids, np.zeros(500, bool))
    assert best.id.tolist() == [0, 1] and read == 500


def test_direct_access_tightens():
    """Places seen by direct access count: the second list is seen to its end without being read so far."""
    counts = np.zeros((300, 2), np.int64)
    counts[:, 0] = 1
    counts[:200, 0] = 9
    counts[:200, 1] = 1
    run, known = run_of(counts, np.full(300, 10, np.int64))
    best = lexical.Best(200)
    read = lexical.best_positions(run, np.array([0, 1]), known.weights, best, np.arange(300), np.zeros(300, bool))
    assert sorted(best.id.tolist()) == list(range(200)) and read < 500
