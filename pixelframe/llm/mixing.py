"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks.

Each source's documents are shuffled by a hash of their id and laid end to end;
the words of a source, repeated as often as its target asks, are cut into
blocks of equal size. A golden-ratio point sequence, mapped through the
cumulated slot counts of the sources, says whose turn it is at each slot; the
k-th slot of a source takes its k-th block.

Edge cases: a null text has no words and is never taken; a null source is a
source of its own, last in order; an empty table gives an empty mix; repeated
rows are separate documents; other columns are carried by none of the results.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pixelframe.llm.common import (
    fingerprint,
    hinted,
    load,
    put_back,
    root_of,
    running_total,
    same_row,
    set_aside,
    store,
    without_repeats,
)
from pixelframe.llm.registry import query

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5
REPEATS = 2
BLOCK_WORDS = 1000
#: The golden ratio's fraction as a multiple of 1 / CYCLE.
CYCLE, GOLDEN = 2**31, 1327217885
BINS = 1024
MIX_COLUMNS = ("size", "source_size", "target", "taken", "first_slot")


class Mix(NamedTuple):
    """documents: a row each, with its place; sources: targets and slots;
    schedule: (slot, sid, block); pieces: which words of a document fill which block."""

    documents: DataFrame
    sources: DataFrame
    schedule: DataFrame
    pieces: DataFrame


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS
) -> DataFrame:
    """Targets of the sources in (source, size): weights by code point, filled like water.

    A target is level * weight, or the cap where that is above it; the level is
    the one at which all targets sum to ``share`` of all words. One row per
    source goes through one task, documents never do.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    by_ratio = Window.orderBy("ratio", "sid")
    weight = F.element_at(F.array(*map(F.lit, weights)), F.col("sid") % len(weights) + 1)
    table = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("sid", F.row_number().over(by_name) - 1)
        .withColumn("weight", weight.cast("double"))
        .withColumn("cap", (F.col("source_size") * repeats).cast("double"))
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("whole", F.sum("source_size").over(everything).cast("double") * share)
        .withColumn("place", F.row_number().over(by_ratio))
        .withColumn("filled", F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("open", F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", (F.col("whole") - F.coalesce("filled", F.lit(0.0))) / F.col("open"))
        .withColumn(
            "first",
            F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("place", "level"))).over(everything),
        )
        .withColumn(
            "target",
            F.when(F.col("place") < F.col("first.place"), F.col("cap")).otherwise(
                F.least(F.col("cap"), F.coalesce("first.level", F.col("ratio")) * F.col("weight"))
            ),
        )
    )
    return table.select("source", "sid", "source_size", "target")


def with_slots(targets: DataFrame, block_words: int) -> DataFrame:
    """Adds the words to take (``goal``), their blocks and the source's interval of slots."""
    upto = Window.orderBy("sid")
    goal = F.floor("target").cast("long")
    return (
        targets.withColumn("goal", goal)
        .withColumn("blocks", F.expr(f"(goal + {block_words - 1}) div {block_words}"))
        .withColumn("upper", F.sum("blocks").over(upto))
        .withColumn("lower", F.col("upper") - F.col("blocks"))
    )


def slot_schedule(spark: SparkSession, sources: DataFrame) -> DataFrame:
    """(slot, sid, block): golden-ratio points mapped to sources and ranked within them.

    Slots beyond a source's blocks stay empty, blocks left over follow at the
    end; both are as few as the sequence's discrepancy.
    """
    slots = int(sources.agg(F.sum("blocks")).first()[0] or 0)
    whole, bins = F.lit(max(1, slots)), F.lit(BINS)
    point = (F.col("id") % CYCLE * GOLDEN % CYCLE) / F.lit(float(CYCLE)) * whole
    points = spark.range(slots).withColumn("x", point).withColumn("bin", F.floor(F.col("x") * bins / whole))
    spans = sources.where("blocks > 0").select(
        "sid", "lower", "upper", "blocks",
        F.explode(
            F.sequence(F.floor(F.col("lower") * bins / whole), F.floor(F.col("upper") * bins / whole))
        ).alias("bin"),
    )
    chunk = F.expr(f"id div {root_of(slots)}")
    owned = (
        points.join(store(spans, "mix-spans"), "bin")
        .where("x >= lower and x < upper")
        .select("id", "sid", "blocks", chunk.alias("chunk"), F.lit(1).alias("one"))
    )
    ranked = store(
        running_total(owned, "sid", "chunk", [F.col("id")], "one").select(
            F.col("id").alias("slot"), "sid", F.col("before").alias("block"), "blocks"
        ),
        "mix-slots",
    )
    had = ranked.groupBy("sid").agg(F.count(F.lit(1)).alias("had"))
    rest = (
        sources.join(had, "sid", "left")
        .withColumn("had", F.coalesce("had", F.lit(0)))
        .where("had < blocks")
        .withColumn("block", F.explode(F.expr("sequence(had, blocks - 1)")))
        .select((F.lit(slots) + F.col("lower") + F.col("block")).alias("slot"), "sid", "block")
    )
    return ranked.where("block < blocks").select("slot", "sid", "block").unionByName(rest)


def mix(docs: DataFrame, block_words: int = BLOCK_WORDS) -> Mix:
    """The mix of (doc_id, source, text): who is taken, how much, and when."""
    spark = docs.sparkSession
    facts = docs.select("doc_id", fingerprint("text").alias("print"), "source", word_count("text").alias("size"))
    sizes = store(facts, "mix-sizes")
    sources = store(with_slots(source_targets(sizes), block_words), "mix-sources")
    buckets = root_of(sizes.count())
    shuffled = F.coalesce(F.md5(F.col("doc_id").cast("string").cast("binary")), F.lit(""))
    head = F.coalesce(F.conv(F.substring("shuffled", 1, 8), 16, 10).cast("long"), F.lit(0))
    placed = (
        sizes.join(sources, sizes["source"].eqNullSafe(sources["source"]))
        .select("doc_id", "print", sizes["source"], "size", "sid", "source_size", "target", "goal")
        .withColumn("shuffled", shuffled)
        .withColumn("bucket", F.floor(head * buckets / 2**32))
    )
    order = [F.col("shuffled"), F.col("doc_id").asc_nulls_first(), F.col("size")]
    documents = store(running_total(placed, "sid", "bucket", order, "size").drop("shuffled"), "mix-documents")
    pieces = (
        documents.where("size > 0")
        .withColumn("pass", F.explode(F.array(*(F.lit(i) for i in range(REPEATS)))))
        .withColumn("from", F.col("pass") * F.col("source_size") + F.col("before"))
        .withColumn("to", F.least(F.col("from") + F.col("size"), F.col("goal")))
        .where("to > from")
        .withColumn(
            "block", F.explode(F.expr(f"sequence(from div {block_words}, (to - 1) div {block_words})"))
        )
        .select(
            "sid", "bucket", "nth", "doc_id", "block",
            F.greatest(F.col("from"), F.col("block") * block_words).alias("from"),
            F.least(F.col("to"), (F.col("block") + 1) * block_words).alias("to"),
        )
    )
    return Mix(documents, sources, slot_schedule(spark, sources), pieces)


def taken_words(mixed: Mix) -> DataFrame:
    """A row per document: its size, its source's size and target, and the words taken."""
    place = ["sid", "bucket", "nth"]
    taken = (
        mixed.pieces.join(mixed.schedule, ["sid", "block"])
        .groupBy(*place)
        .agg(F.sum(F.col("to") - F.col("from")).alias("taken"), F.min("slot").alias("first_slot"))
    )
    return mixed.documents.join(taken, place, "left").select(
        "doc_id", "print", "source", "size", "source_size", "target",
        F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "first_slot",
    )


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The documents of the mix: ``docs`` that are taken, with how much, and at which slot first.

    Rows that repeat an id and a text become one, taken as often as they were together.
    The added columns ``MIX_COLUMNS`` replace those of the same name.
    """
    own = set_aside(docs, ["doc_id", "source", "text"])
    place = taken_words(mix(own)).withColumnsRenamed({"doc_id": "_id", "print": "_print"})
    per = place.groupBy("_id", "_print").agg(
        F.sum("size").alias("size"), F.max("source_size").alias("source_size"), F.max("target").alias("target"),
        F.sum("taken").alias("taken"), F.min("first_slot").alias("first_slot"), F.count(F.lit(1)).alias("c"),
    )
    per = store(per.where("taken > 0"), "mix-taken")
    single = without_repeats(own, hinted(store(per.where("c > 1").select("_id", "_print"), "mix-repeated"), 16))
    taken = hinted(per, 64).drop("c")
    return put_back(single.join(taken, same_row(single, taken)), docs, own, MIX_COLUMNS)


OP3_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS sid FROM d GROUP BY source),
w AS (
  SELECT *, [{", ".join(map(str, WEIGHTS))}][sid % {len(WEIGHTS)} + 1]::DOUBLE AS weight,
    ({REPEATS} * source_size)::DOUBLE AS cap FROM s),
r AS (SELECT *, cap / weight AS ratio FROM w),
l AS (
  SELECT *, row_number() OVER (ORDER BY ratio, sid) AS place,
    ((SELECT sum(source_size)::DOUBLE FROM s) * {SHARE}::DOUBLE
     - coalesce(sum(cap) OVER (ORDER BY ratio, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY ratio, sid ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM r),
f AS (SELECT min(place) AS place, arg_min(level, place) AS level FROM l WHERE level <= ratio),
t AS (
  SELECT source, sid, source_size,
    CASE WHEN l.place < f.place THEN cap ELSE least(cap, f.level * weight) END AS target FROM l, f),
p AS (
  SELECT r, doc_id, d.source, sid, size, source_size, target, floor(target)::BIGINT AS goal,
    coalesce(sum(size) OVER (PARTITION BY sid
      ORDER BY coalesce(md5(doc_id::VARCHAR), ''), doc_id NULLS FIRST, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
u AS (
  SELECT sid, blocks, sum(blocks) OVER (ORDER BY sid)::BIGINT AS upto
  FROM (SELECT sid, (floor(target)::BIGINT + {BLOCK_WORDS - 1}) // {BLOCK_WORDS} AS blocks FROM t)),
n AS (SELECT coalesce(sum(blocks), 0)::BIGINT AS slots FROM u),
x AS (
  SELECT slot, (slot % {CYCLE} * {GOLDEN} % {CYCLE})::DOUBLE / {CYCLE}::DOUBLE * slots AS x
  FROM (SELECT slots, unnest(range(0, slots)) AS slot FROM n)),
o AS (
  SELECT slot, sid, blocks, row_number() OVER (PARTITION BY sid ORDER BY slot) - 1 AS block
  FROM x JOIN u ON x >= upto - blocks AND x < upto),
z AS (
  SELECT slot, sid, block FROM o WHERE block < blocks
  UNION ALL
  SELECT slots + upto - blocks + block, sid, block FROM (
    SELECT sid, upto, blocks, unnest(range(coalesce(had, 0), blocks)) AS block
    FROM u LEFT JOIN (SELECT sid, count(*) AS had FROM o GROUP BY sid) USING (sid)), n),
i AS (
  SELECT r, sid, lo, least(lo + size, goal) AS hi
  FROM (SELECT *, unnest([0, 1]) * source_size + start AS lo FROM p) WHERE least(lo + size, goal) > lo),
s0 AS (
  SELECT r, min(slot) AS first_slot
  FROM (SELECT r, sid, unnest(range(lo // {BLOCK_WORDS}, (hi - 1) // {BLOCK_WORDS} + 1)) AS block FROM i)
  JOIN z USING (sid, block) GROUP BY r)
SELECT doc_id, size, source_size, target,
  (greatest(0, least(start + size, goal) - start)
   + greatest(0, least(source_size + start + size, goal) - source_size - start))::BIGINT AS taken, first_slot
FROM p LEFT JOIN s0 USING (r)
"""


@query("op3_mix_sources", OP3_SQL)
def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(load(spark, sf_dir, "documents"))
    return taken_words(mixed).select("doc_id", "size", "source_size", "target", "taken", "first_slot")
