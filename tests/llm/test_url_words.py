"""Segmentation and scores of url words against brute force, and what unseen names score."""

import math
import random
import time
from collections import Counter

import pytest

from pixelframe.llm import urls

WORDS = [("ab", 50), ("abc", 9), ("c", 5), ("bca", 20), ("a", 3), ("cab", 30), ("zz", 7)]


def chance_of(words, table):
    """Log probability of a split, unknown words by their length."""
    total = sum(table.values())
    return sum(math.log(table[w] / total) if w in table else -14.0 - 2.5 * (len(w) - 1) for w in words)


def splits(token):
    if not token:
        yield []
    for k in range(1, len(token) + 1):
        for rest in splits(token[k:]):
            yield [token[:k], *rest]


def test_split_is_the_most_probable():
    rng = random.Random(3)
    table = dict(WORDS)
    total = sum(table.values())
    for _ in range(150):
        token = "".join(rng.choices("abcz", k=rng.randint(1, 9)))
        found = [(s, s + len(w), math.log(table[w] / total)) for s, w in urls.pieces_of(token) if w in table]
        best = max(chance_of(s, table) for s in splits(token))
        assert math.isclose(chance_of(urls.best_split(token, found), table), best)


def test_sent_and_joined_tables_agree(spark, monkeypatch):
    rng = random.Random(4)
    tokens = {"".join(rng.choices("abcz", k=rng.randint(1, 60))) for _ in range(80)} | {"zz", "qqq"}
    frame = spark.createDataFrame([(t,) for t in tokens], "token string")
    words = spark.createDataFrame(WORDS, "word string, n long")
    sent = {r.token: r.words for r in urls.segments(frame, words).collect()}
    monkeypatch.setattr(urls, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(urls, "PIECE_ROWS", 50)
    joined = {r.token: r.words for r in urls.segments(frame, words).collect()}
    assert set(sent) == tokens and all(sent[t] == w for t, w in joined.items())
    assert set(joined) == {t for t in tokens if any(w in t for w, _ in WORDS)}


def test_long_name(spark):
    pages = spark.createDataFrame([(1, "http://a.com/" + "wikinews" * 12_500, 0)], "page_id long, url string, score int")
    start = time.monotonic()
    assert urls.judge(pages).first().verdict == "allow"
    assert time.monotonic() - start < 60


def test_scores_are_those_of_naive_bayes(spark):
    """Log odds from word counts of the labelled names, recomputed word by word."""
    names = ["http://free-casino.org/win/news", "http://b.org/library", "http://c.org/123", "http://d.org/casino/casino"]
    pages = spark.createDataFrame(list(enumerate(names)), "page_id long, url string")
    got = {r.page_id: r.score for r in urls.judge(pages).collect()}
    counts = [Counter(w for n in group for w in n.split()) for group in (urls.WANTED, urls.UNWANTED)]
    vocabulary = set(counts[0]) | set(counts[1])
    total = [sum(c.values()) + len(vocabulary) for c in counts]

    def odds(words):
        known = [w for w in words if w in vocabulary]
        return sum(math.log((counts[1][w] + 1) / total[1] * total[0] / (counts[0][w] + 1)) for w in known) - math.log(urls.PRIOR)

    words = [["free", "casino", "win", "news"], ["library"], [], ["casino", "casino"]]
    for k, expected in enumerate(words):
        assert got[k] == pytest.approx(odds(expected))


def test_names_left_out_of_the_table():
    """Each labelled name judged by the table without it."""
    right = 0
    for group, unwanted in ((urls.WANTED, False), (urls.UNWANTED, True)):
        for name in group:
            rest = [tuple(n for n in g if n != name) for g in (urls.WANTED, urls.UNWANTED)]
            weights = urls.word_weights(*rest)
            right += (sum(weights.get(w, 0) for w in name.split()) - math.log(urls.PRIOR) > 0) == unwanted
    assert right / (len(urls.WANTED) + len(urls.UNWANTED)) >= 0.8
