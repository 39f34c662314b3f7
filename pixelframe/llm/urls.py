"""URL filters: rules first, else naive Bayes on segmented host and path words.

Names that run words together are split by a unigram model, the most probable
split by dynamic programming. Its words are those of a small labelled table and
those that hyphenated names of the table's urls show as words. Multinomial
naive Bayes is trained on the labelled table; every url without a rule is
scored by the words of its host and path.

Edge cases: a null url, and one without ``://``, has an empty host and path and
is allowed by the prior; of rules that fit, the longest wins, and rules differ;
urls that repeat are scored once; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import islice
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pixelframe.llm.common import BROADCAST_BYTES, load, store
from pixelframe.llm.registry import query


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str


RULES = (
    Rule("com", "/", "allow"),
    Rule("example.com", "/en/", "block"),
    Rule("www.example.com", "/en/", "allow"),
    Rule("net", "/es/", "block"),
    Rule("net", "/fr/", "block"),
)
#: Labelled names: words of hosts and paths that are wanted, and of those that are not.
WANTED = (
    "news daily world", "travel notes diary", "wiki open science", "research university library", "city weather report",
    "learn python code", "music review blog", "health care clinic", "school math lessons", "history museum archive",
    "food recipes kitchen", "garden plants guide", "photo art gallery", "book club review", "sports team news",
    "data journal papers", "local events calendar", "public radio stories", "film festival", "docs help support",
    "shop home garden", "free software project", "green energy forum", "family pets care", "mail contact about",
)
UNWANTED = (
    "casino win bonus", "free bets odds", "online poker slots jackpot", "cheap pills viagra", "adult xxx video",
    "porn sex cams", "spam farm links", "ads track click", "payday loans fast cash", "buy cheap meds pharmacy",
    "betting tips win money", "hot singles dating", "adult live sex", "casino slots spins", "replica watches cheap",
    "crack keygen warez", "free money lottery win", "escort girls adult", "bet gambling casino", "tracker pixel ads",
    "click fraud bot farm", "diet pills cheap", "xxx porn free", "crypto double money scam", "spam seo backlinks",
    "blog adult webcam", "news casino win", "mail free money", "shop replica bags", "blog ads track", "live bets now",
)
#: How many urls without a rule are wanted for each that is not, before any word is seen.
PRIOR = 2.0
#: Longest word of the unigram model, and the weight of a labelled word in it.
LONGEST, LABELLED_WEIGHT = 20, 50
#: What a word of the unigram table takes in a task besides its letters, and substrings of a name handed on at once.
WORD_BYTES, PIECE_ROWS = 150, 100_000


def url_parts(url: str = "url") -> tuple[Column, Column]:
    """Host, in small letters, and path."""
    column = F.coalesce(F.col(url), F.lit(""))
    at = F.locate("://", column)
    rest = F.when(at > 0, column.substr(at + 3, F.length(column))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def longest_rule(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, or null."""
    fits = [
        F.when(
            ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path)),
            F.struct(F.lit(r.host + r.path).alias("rule"), F.lit(r.verdict).alias("verdict")),
        )
        for r in sorted(rules, key=lambda r: -len(r.host + r.path))
    ]
    return F.coalesce(*fits)


def word_weights(wanted: tuple[str, ...] = WANTED, unwanted: tuple[str, ...] = UNWANTED) -> dict[str, float]:
    """Log odds of each labelled word for the unwanted class, with add-one smoothing."""
    counts = [Counter(w for name in names for w in name.split()) for names in (wanted, unwanted)]
    vocabulary = counts[0].keys() | counts[1].keys()
    total = [sum(c.values()) + len(vocabulary) for c in counts]
    return {
        w: math.log((counts[1][w] + 1) / total[1]) - math.log((counts[0][w] + 1) / total[0]) for w in sorted(vocabulary)
    }


def tokens_of(host: Column, path: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.concat(host, path)), F.lit("[a-z]+"), F.lit(0))


def unigrams(urls: DataFrame) -> DataFrame:
    """(word, n): words that hyphens part in the names of all urls, and the labelled ones."""
    spark = urls.sparkSession
    names = F.regexp_extract_all(F.lower(F.concat("host", "path")), F.lit("(?<![a-z])[a-z]++(?:[-_][a-z]++)+"), F.lit(0))
    parted = urls.select(F.explode(names).alias("name"), "n").select(F.explode(F.split("name", "[-_]")).alias("word"), "n")
    labelled = Counter(w for name in WANTED + UNWANTED for w in name.split())
    known = spark.createDataFrame([(w, LABELLED_WEIGHT * c) for w, c in sorted(labelled.items())], "word string, n long")
    short = parted.where(F.length("word") <= LONGEST)
    return short.unionByName(known).groupBy("word").agg(F.sum("n").alias("n"))


def best_split(token: str, found: list[tuple[int, int, float]]) -> list[str]:
    """The most probable words of a token; ``found`` has (start, end, log probability).

    Letters between known words are a word of their own, the less probable the longer.
    """
    at: dict[int, list[tuple[int, float]]] = {}
    for start, end, chance in found:
        at.setdefault(start, []).append((end, chance))
    # Two states at each place, after a known word and within an unknown one: (score, place and state before).
    none = (-math.inf, 0, 0)
    best = [[(0.0, 0, 0), none]] + [[none, none] for _ in token]
    for start in range(len(token)):
        for state in (0, 1):
            score = best[start][state][0]
            if score == -math.inf:
                continue
            # a letter costs more where it opens an unknown word than where it goes on with one
            steps = [(start + 1, 1, -2.5 if state else -14.0), *((e, 0, c) for e, c in at.get(start, ()))]
            for end, to, chance in steps:
                if score + chance > best[end][to][0]:
                    best[end][to] = (score + chance, start, state)
    words, end = [], len(token)
    state = int(best[end][1][0] > best[end][0][0])
    while end:
        _, start, before = best[end][state]
        while state and start and before:  # all letters of an unknown word
            _, start, before = best[start][1]
        words.append(token[start:end])
        end, state = start, before
    return words[::-1]


def pieces_of(token: str) -> Iterator[tuple[int, str]]:
    """(start, word) of all substrings that are no longer than a word of the unigram model."""
    for start in range(len(token)):
        for end in range(start + 1, min(len(token), start + LONGEST) + 1):
            yield start, token[start:end]


def segments(tokens: DataFrame, words: DataFrame) -> DataFrame:
    """(token, words) of distinct tokens, by the stored unigram table.

    The table is sent to the tasks where its counted size allows it, and joined
    to the substrings otherwise; both give the same words.
    """
    total, size = words.agg(F.sum("n"), F.sum(F.octet_length("word") + WORD_BYTES)).first()
    chances = words.select("word", F.log(F.col("n") / F.lit(float(total or 1))).alias("chance"))
    return _sent_segments(tokens, chances) if (size or 0) <= BROADCAST_BYTES else _joined_segments(tokens, chances)


def _sent_segments(tokens: DataFrame, chances: DataFrame) -> DataFrame:
    known = {r["word"]: r["chance"] for r in chances.collect()}  # its size was counted
    sent = tokens.sparkSession.sparkContext.broadcast(known)

    @F.pandas_udf("array<string>")
    def split(token: pd.Series) -> pd.Series:
        chance = sent.value
        return pd.Series([best_split(t, [(s, s + len(w), chance[w]) for s, w in pieces_of(t) if w in chance]) for t in token])

    return tokens.select("token", split("token").alias("words"))


def _joined_segments(tokens: DataFrame, chances: DataFrame) -> DataFrame:
    """A row per substring has its token's number, not the token, so a long name costs no more than its length."""

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for number, token in zip(frame["number"], frame["token"], strict=True):
                pieces = pieces_of(token)
                while part := list(islice(pieces, PIECE_ROWS)):
                    found = pd.DataFrame(part, columns=["start", "word"])
                    yield found.assign(number=number)

    numbered = store(tokens.withColumn("number", F.monotonically_increasing_id()), "url-names")
    pieces = numbered.select("number", "token").mapInPandas(rows, "start int, word string, number long")
    end = (F.col("start") + F.length("word")).alias("end")
    known = pieces.join(chances, "word").select("number", F.struct("start", end, "chance").alias("piece"))
    found = known.groupBy("number").agg(F.collect_list("piece").alias("pieces"))

    @F.pandas_udf("array<string>")
    def split(token: pd.Series, pieces: pd.Series) -> pd.Series:
        return pd.Series(
            [best_split(t, [(p["start"], p["end"], p["chance"]) for p in ps]) for t, ps in zip(token, pieces, strict=True)]
        )

    return numbered.join(found, "number").select("token", split("token", "pieces").alias("words"))


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, score): ``score`` is the log odds where no rule fits."""
    spark = pages.sparkSession
    host, path = url_parts()
    parts = pages.select("page_id", host.alias("host"), path.alias("path"))
    urls = store(parts.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n")), "urls")
    ruled = longest_rule(F.col("host"), F.col("path"), rules)
    judged = parts.withColumn("found", ruled)
    open_urls = urls.where(ruled.isNull())
    tokens = open_urls.select("host", "path", F.explode(tokens_of(F.col("host"), F.col("path"))).alias("token"))
    per_url = store(tokens.groupBy("host", "path", "token").agg(F.count(F.lit(1)).alias("times")), "url-tokens")
    words = store(unigrams(urls), "url-unigrams")
    split = store(segments(per_url.select("token").distinct(), words), "url-segments")
    weights = spark.createDataFrame(sorted(word_weights().items()), "word string, weight double")
    by_token = split.select("token", F.explode("words").alias("word")).join(weights, "word")
    by_token = store(by_token.groupBy("token").agg(F.sum("weight").alias("weight")), "token-weights")
    scored = per_url.join(by_token, "token").groupBy("host", "path").agg(F.sum(F.col("weight") * F.col("times")).alias("evidence"))
    scored = store(scored, "url-scores")
    score = F.coalesce("evidence", F.lit(0.0)) - F.lit(math.log(PRIOR))
    return judged.join(scored, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("found.rule").alias("rule"),
        F.coalesce("found.verdict", F.when(score > 0, "block").otherwise("allow")).alias("verdict"),
        F.when(F.col("found").isNull(), score).alias("score"),
    )


@query("op8_url_filter")
def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(load(spark, sf_dir, "pages")).drop("score")
