"""Benchmark decontamination with a positional inverted index.

The corpus' token postings (term, document, position) are stored for the terms
that matter: of every benchmark window the two rarest by corpus count. Their
lists are shifted by the term's place in the item and intersected, so a match
is a diagonal (document, item, offset); the remaining words of the window are
compared on the few diagonals that are left.

Edge cases: a null or word-less text has no words and no hits; an item without
words is ignored; items with a null id mark words but are not counted or
listed; rows that repeat an id are looked up by id and text; empty tables give
rows without hits, or none.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pixelframe.llm.common import fingerprint, hinted, load, put_back, same_row, set_aside, store
from pixelframe.llm.registry import query

WINDOW = 10
#: How far the two rarest terms of a window may be off their distance in it.
SLOP = 5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What separates words, once A-Z are lower-case.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: str) -> Column:
    """The words of a text; none of a null."""
    split = F.split(F.translate(F.col(text), UPPER, LOWER), GAP)
    return F.coalesce(F.array_remove(split, ""), F.array().cast("array<string>"))


def phrase_items(benchmark: DataFrame) -> DataFrame:
    """(item, item_id, terms, length): items with words; length is that of their windows."""
    return (
        benchmark.select("item_id", words_of("text").alias("terms"))
        .where(F.size("terms") > 0)
        .withColumn("item", F.xxhash64("item_id", "terms"))
        .dropDuplicates(["item"])
        .withColumn("length", F.least(F.lit(WINDOW), F.size("terms")))
    )


def term_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, n): how often each of ``terms`` stands in the corpus."""
    tokens = docs.select(F.explode(words_of("text")).alias("term"))
    return tokens.join(terms, "term", "left_semi").groupBy("term").agg(F.count(F.lit(1)).alias("n"))


def postings(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, doc_id, print, position) of the given terms in every whole text."""
    tokens = docs.select(
        "doc_id", fingerprint("text").alias("print"),
        F.posexplode(words_of("text")).alias("position", "term"),
    )
    return tokens.join(terms, "term", "left_semi")


def rarest_terms(items: DataFrame, counts: DataFrame, keep: int = 2) -> DataFrame:
    """(item, start, rank, place, term): the ``keep`` rarest words of every window.

    Windows with a word that the corpus lacks can't occur and are left out.
    """
    windows = items.select("item", "terms", "length", F.explode(
        F.sequence(F.lit(0), F.size("terms") - F.col("length"))).alias("start"))
    places = windows.select(
        "item", "start", "length",
        F.posexplode(F.expr("slice(terms, start + 1, length)")).alias("offset", "term"),
    )
    window = Window.partitionBy("item", "start")
    return (
        places.join(counts, "term")
        .withColumn("known", F.count(F.lit(1)).over(window))
        .where("known = length")
        .withColumn("rank", F.row_number().over(window.orderBy("n", "offset")))
        .where(F.col("rank") <= keep)
        .select("item", "start", "rank", (F.col("start") + F.col("offset")).alias("place"), "term")
    )


def diagonals(index: DataFrame, rare: DataFrame) -> DataFrame:
    """(doc_id, print, item, shift) where the rarest terms of some window all agree."""
    places = rare.select("item", "place", "term").distinct()
    shifted = index.join(places, "term").select(
        "doc_id", "print", "item", (F.col("position") - F.col("place")).alias("shift"), "place"
    )
    met = shifted.groupBy("doc_id", "print", "item", "shift").agg(F.collect_set("place").alias("met"))
    wanted = (
        rare.groupBy("item", "start").agg(F.collect_set("place").alias("need"))
        .groupBy("item").agg(F.collect_set("need").alias("needs"))
    )
    return (
        met.join(wanted, "item")
        .where(F.exists("needs", lambda need: F.size(F.array_except(need, "met")) == 0))
        .select("doc_id", "print", "item", "shift")
    )


class Index(NamedTuple):
    """items with words; rare: the rarest terms of their windows; postings of those terms, stored."""

    items: DataFrame
    rare: DataFrame
    postings: DataFrame


def benchmark_index(docs: DataFrame, benchmark: DataFrame) -> Index:
    items = store(phrase_items(benchmark), "phrase-items")
    terms = store(items.select(F.explode("terms").alias("term")).distinct(), "phrase-terms")
    counts = store(term_counts(docs, terms), "phrase-counts")
    rare = store(rarest_terms(items, counts), "phrase-rare")
    return Index(items, rare, store(postings(docs, rare.select("term").distinct()), "phrase-postings"))


def phrase_matches(docs: DataFrame, index: Index) -> DataFrame:
    """Exact windows: (doc_id, print, item, item_id, shift, starts, length), starts in the item."""
    items = index.items
    found = store(diagonals(index.postings, index.rare), "phrase-diagonals")
    texts = docs.select(F.col("doc_id").alias("id"), fingerprint("text").alias("fp"), "text")
    spread = texts.join(hinted(found, 32), F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("fp") == F.col("print")))
    words = spread.join(items, "item").select(
        "doc_id", "print", "item", "item_id", "shift", "terms", "length", words_of("text").alias("words")
    )
    bounds = words.withColumn("low", F.greatest(F.lit(0), -F.col("shift"))).withColumn(
        "high", F.least(F.size("terms"), F.size("words") - F.col("shift")) - F.col("length")
    )
    starts = F.expr(
        "filter(sequence(low, high), s -> slice(words, shift + s + 1, length) = slice(terms, s + 1, length))"
    )
    return (
        bounds.where("high >= low")
        .select("doc_id", "print", "item", "item_id", "shift", "length", starts.alias("starts"))
        .where(F.size("starts") > 0)
        .dropDuplicates(["doc_id", "print", "item", "shift"])
    )


def proximity_matches(index: Index, slop: int = SLOP) -> DataFrame:
    """(doc_id, print, item, item_id, shift): the two rarest terms of a window within ``slop`` of their distance.

    The offset-adjusted lists need not agree, only lie near each other. Meeting
    places are found by bins of the shift, so no list is paired with all of another.
    """
    shift = (F.col("position") - F.col("place")).alias("shift")
    hits = index.postings.join(index.rare, "term").select("doc_id", "print", "item", "start", "rank", shift)
    width = slop + 1
    first = hits.where("rank = 1").withColumn(
        "bin", F.explode(F.expr(f"sequence(floor(shift / {width}) - 1, floor(shift / {width}) + 1)"))
    )
    names = {c: f"{c}_2" for c in ("doc_id", "print", "item", "start", "shift")}
    second = hits.where("rank = 2").withColumnsRenamed(names).withColumn("bin_2", F.floor(F.col("shift_2") / width))
    same = F.col("doc_id").eqNullSafe(F.col("doc_id_2"))
    for c in ("print", "item", "start", "bin"):
        same &= F.col(c) == F.col(f"{c}_2")
    near = first.join(second, same & (F.abs(F.col("shift") - F.col("shift_2")) <= slop))
    return near.join(index.items, "item").select("doc_id", "print", "item", "item_id", "shift").distinct()


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row per document with its words, hit words and items, see ``op2_decontaminate``."""
    index = benchmark_index(docs, benchmark)
    matches = store(phrase_matches(docs, index), "phrase-matches")
    key = ["doc_id", "print"]
    hit = matches.select(*key, F.explode(F.expr(
        "flatten(transform(starts, s -> sequence(shift + s, shift + s + length - 1)))")).alias("at"))
    item = F.col("item_id").cast("string").alias("item_id")
    none = F.lit(None)
    # One aggregation over all kinds of facts, as a join by a null id would lose it.
    facts = hit.distinct().select(*key, "at", none.cast("string").alias("item_id"), none.cast("string").alias("near"))
    facts = facts.unionByName(matches.select(*key, item).distinct(), allowMissingColumns=True)
    near = proximity_matches(index).select(*key, F.col("item_id").cast("string").alias("near")).distinct()
    facts = facts.unionByName(near, allowMissingColumns=True)
    per = facts.groupBy(*key).agg(
        F.count("at").alias("n_hit"), F.collect_set("item_id").alias("ids"), F.count("near").alias("n_near")
    )
    per = store(per, "phrase-documents").withColumnsRenamed({"doc_id": "id", "print": "fp"})
    size = docs.select("doc_id", fingerprint("text").alias("print"), F.size(words_of("text")).alias("n"))
    joined = size.join(per, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("print") == F.col("fp")), "left")
    ids = F.coalesce("ids", F.array().cast("array<string>"))
    return joined.select(
        "doc_id",
        F.col("n").cast("long").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(ids), ",").cast("binary"), 256).alias("items_sha256"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        "print",
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without those that hold a benchmark window."""
    own = set_aside(docs, ["doc_id", "text"])
    matches = phrase_matches(own, benchmark_index(own, benchmark))
    marked = matches.select(F.col("doc_id").alias("_id"), F.col("print").alias("_print")).distinct()
    bad = hinted(store(marked, "contaminated"), 16)
    return put_back(own.join(bad, same_row(own, bad), "left_anti"), docs, own)


OP2_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    coalesce(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS ws FROM documents),
b AS (
  SELECT item_id, coalesce(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS ws FROM benchmark),
bw AS (
  SELECT item_id, least({WINDOW}, len(ws)) AS k, ws[s + 1 : s + least({WINDOW}, len(ws))] AS win
  FROM (SELECT item_id, ws, unnest(range(0, len(ws) - least({WINDOW}, len(ws)) + 1)) AS s FROM b WHERE len(ws) > 0)),
k AS (SELECT DISTINCT k FROM bw),
dw AS (
  SELECT r, s, k, ws[s + 1 : s + k] AS win
  FROM (SELECT r, ws, k, unnest(range(0, len(ws) - k + 1)) AS s FROM d, k WHERE len(ws) >= k)),
m AS (SELECT DISTINCT r, s, dw.k, item_id FROM dw JOIN bw ON dw.k = bw.k AND dw.win = bw.win),
h AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + k)) AS p FROM m) GROUP BY r),
i AS (
  SELECT r, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM (SELECT DISTINCT r, item_id FROM m WHERE item_id IS NOT NULL) GROUP BY r),
c AS (SELECT t, count(*) AS n FROM (SELECT unnest(ws) AS t FROM d) WHERE t IN (SELECT unnest(ws) FROM b) GROUP BY t),
bi AS (SELECT row_number() OVER () AS item, * FROM (SELECT DISTINCT item_id, ws FROM b WHERE len(ws) > 0)),
bs AS (
  SELECT item, item_id, ws, least({WINDOW}, len(ws)) AS k,
    unnest(range(0, len(ws) - least({WINDOW}, len(ws)) + 1)) AS s FROM bi),
bt AS (SELECT item, item_id, s, k, o, ws[s + o + 1] AS t FROM (SELECT *, unnest(range(0, k)) AS o FROM bs)),
br AS (
  SELECT item, item_id, t, s + o AS place, s,
    row_number() OVER (PARTITION BY item, s ORDER BY n, o) AS rank, count(*) OVER (PARTITION BY item, s) = k AS known
  FROM bt JOIN c USING (t)),
rp AS (
  SELECT r, ps AS position, t FROM (SELECT r, unnest(ws) AS t, unnest(range(0, len(ws))) AS ps FROM d)
  WHERE t IN (SELECT t FROM br WHERE rank <= 2 AND known)),
ns AS (SELECT r, item, item_id, s, rank, position - place AS shift FROM br JOIN rp USING (t) WHERE rank <= 2 AND known),
nr AS (
  SELECT x.r, count(DISTINCT x.item_id) AS n_near FROM ns x
  JOIN ns y ON x.r = y.r AND x.item = y.item AND x.s = y.s AND x.rank = 1 AND y.rank = 2
    AND abs(x.shift - y.shift) <= {SLOP} GROUP BY x.r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near, 0)::BIGINT AS n_near
FROM d LEFT JOIN h USING (r) LEFT JOIN i USING (r) LEFT JOIN nr USING (r)
"""


@query("op2_decontaminate", OP2_SQL)
def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = contamination(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
    return marked.drop("print")
