"""Secret scans: patterns per kind, then corpus-wide ownership of every candidate value.

The patterns give the base spans. Long tokens with a digit are further
candidates. All values are counted over the corpus by distinct repositories
and owners: a value that many owners hold is an example that was copied
around, one that few owners hold looks live. Live tokens of mixed characters, and
bare copies of live base values, are added as spans of kind ``owner``.

Edge cases: a null text is empty; a null owner is an owner of its own; rows
that repeat an id are told apart by their text; empty tables give no rows.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pixelframe.llm.common import fingerprint, hinted, load, put_back, same_row, set_aside, store
from pixelframe.llm.registry import query


class Kind(NamedTuple):
    """gate: true wherever a match counts, and cheap; pattern: matches as they are
    consumed; group: the value's; least: the value's least length."""

    name: str
    gate: str
    pattern: str
    group: int
    least: int


_NAME = r"(password|passwd|secret|token|api_?key)"
_SET = r"""["']?\x20*[:=]\x20*["']?"""
_RUN = r"[A-Za-z0-9+/_.=-]"
#: In the order in which spans at one start are listed. Matches of the last three are
#: maximal runs, so a least length in the pattern finds the same ones.
KINDS = (
    Kind("assign", f"(?i:{_NAME}){_SET}{_RUN}{{12}}", f"(?i:{_NAME}){_SET}({_RUN}+)", 2, 12),
    Kind("access", r"AKIA[A-Z0-9]{14}", r"AKIA[A-Z0-9]{14,}", 0, 18),
    Kind("hex", r"[0-9a-f]{16}", r"[0-9a-f]{16,}", 0, 16),
    Kind("owner", f"{_RUN}{{16}}", f"(?<!{_RUN})(?=[A-Za-z+/_.=-]*[0-9]){_RUN}{{16,}}", 0, 16),
)
TOKEN = len(KINDS) - 1
#: From this length on, a token with a digit, a small and a capital letter is a candidate by itself.
LONG_TOKEN = 24
#: A value that more owners hold is a copied example.
LIVE_OWNERS = 2
KEY = ["doc_id", "print"]


def _pieces(number: int, kind: Kind) -> Column:
    text = F.col("text")
    hits = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(kind.group))
    gaps = F.transform(F.split(text, kind.pattern, -1), F.length)
    return F.when(
        text.rlike(kind.gate),
        F.struct(
            F.lit(number).alias("kind"),
            F.arrays_zip(gaps.alias("gap"), F.transform(hits, F.length).alias("width"), values.alias("value")).alias("parts"),
        ),
    )


def candidate_spans(docs: DataFrame, repository: str = "doc_id", owner: str = "source") -> DataFrame:
    """(doc_id, print, repository, owner, kind, start, end, value) of all kinds, in code points.

    A match starts after the gaps and matches before it; a running sum per
    document and kind adds them up.
    """
    scanned = docs.select(
        "doc_id", fingerprint("text").alias("print"),
        F.col(repository).alias("repository"), F.col(owner).alias("owner"),
        F.explode(F.array_compact(F.array(*(_pieces(i, k) for i, k in enumerate(KINDS))))).alias("found"),
    )
    parts = scanned.select(
        *KEY, "repository", "owner", "found.kind", F.posexplode("found.parts").alias("nth", "part")
    ).select(*KEY, "repository", "owner", "kind", "nth", "part.gap", "part.width", "part.value")
    in_order = Window.partitionBy(*KEY, "repository", "owner", "kind").orderBy("nth")
    least = F.element_at(F.array(*(F.lit(k.least) for k in KINDS)), F.col("kind") + 1)
    end = F.sum(F.col("gap") + F.coalesce("width", F.lit(0))).over(in_order)
    return (
        parts.dropDuplicates([*KEY, "repository", "owner", "kind", "nth"])
        .withColumn("end", end)
        .where((F.col("width") > 0) & (F.length("value") >= least))
        .withColumn("start", F.col("end") - F.col("width"))
        .drop("gap", "width", "nth")
    )


def ownership(spans: DataFrame) -> DataFrame:
    """(hash, owners, repositories, known): who holds a value; known: some pattern found it.

    Distinct holders are formed step by step, each combined before its shuffle.
    """
    held = spans.groupBy("hash", "owner", "repository").agg(F.max(F.col("kind") < TOKEN).alias("known"))
    by_owner = held.groupBy("hash", "owner").agg(
        F.count(F.lit(1)).alias("repositories"), F.max("known").alias("known")
    )
    return by_owner.groupBy("hash").agg(
        F.count(F.lit(1)).alias("owners"),
        F.sum("repositories").alias("repositories"),
        F.max("known").alias("known"),
    )


def secret_spans(docs: DataFrame, repository: str = "doc_id", owner: str = "source") -> DataFrame:
    """(doc_id, print, kind, start, end, owners, repositories, live): base and added spans."""
    found = store(
        candidate_spans(docs, repository, owner).withColumn("hash", F.sha2(F.col("value").cast("binary"), 256)),
        "secret-candidates",
    )
    owned = store(ownership(found), "secret-owners")
    value = F.col("value")
    mixed = value.rlike("[a-z]") & value.rlike("[A-Z]") & (F.length(value) >= LONG_TOKEN)
    by_place = Window.partitionBy(*KEY).orderBy("start", "kind")
    base = F.col("kind") < TOKEN
    before = F.max(F.when(base, F.col("end"))).over(by_place)
    after = F.min(F.when(base, F.col("start"))).over(by_place.rowsBetween(0, Window.unboundedFollowing))
    clear = (F.coalesce(before, F.lit(0)) <= F.col("start")) & (
        F.coalesce(after, F.col("end")) >= F.col("end")
    )
    return (
        found.withColumn("mixed", mixed)
        .join(owned, "hash")
        .withColumn("live", F.col("owners") <= LIVE_OWNERS)
        .dropDuplicates([*KEY, "kind", "start"])
        .withColumn("clear", clear)
        .where(base | (F.col("clear") & F.col("live") & (F.col("known") | F.col("mixed"))))
        .select(*KEY, "kind", "start", "end", "owners", "repositories", "live")
    )


def _listed(spans: Column) -> Column:
    names = F.array(*(F.lit(k.name) for k in KINDS))
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])
        ),
        ",",
    )


def secrets_by_document(docs: DataFrame) -> DataFrame:
    """A row per document: counts and lists of its spans, and their places (``places``)."""
    spans = secret_spans(docs)
    place = F.struct("start", "kind", "end")
    per = spans.groupBy(*KEY).agg(
        *(F.count(F.when(F.col("kind") == i, 1)).alias(f"n_{k.name}") for i, k in enumerate(KINDS)),
        F.array_sort(F.collect_list(place)).alias("places"),
        F.count(F.when(F.col("live"), 1)).alias("n_live"),
    )
    per = store(per, "secret-documents").withColumnsRenamed({"doc_id": "id", "print": "fp"})
    ids = docs.select("doc_id", fingerprint("text").alias("print"))
    joined = ids.join(per, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("print") == F.col("fp")), "left")
    places = F.coalesce("places", F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>"))
    base = F.filter(places, lambda s: s["kind"] < TOKEN)
    counts = [F.coalesce(f"n_{k.name}", F.lit(0)).cast("long").alias(f"n_{k.name}") for k in KINDS]
    return joined.select(
        "doc_id", *counts,
        F.sha2(_listed(base).cast("binary"), 256).alias("base_sha256"),
        _listed(places).alias("spans"),
        F.coalesce("n_live", F.lit(0)).cast("long").alias("n_live"),
        "print", places.alias("places"),
    )


def redact(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """``docs`` with every span replaced by ``mark``; overlapping spans by one.

    ``n_chars``, if there, follows the text. Documents without a span pass as they are.
    """
    own = set_aside(docs, ["doc_id", "source", "text", "n_chars"])
    found = secrets_by_document(own).where(F.size("places") > 0)
    hit = store(
        found.select("doc_id", "print", "places").dropDuplicates(KEY), "secret-hits"
    ).withColumnsRenamed({"doc_id": "_id", "print": "_print", "places": "_places"})
    start = F.struct(F.lit("").alias("text"), F.lit(0).cast("long").alias("at"))

    def cut(done: Column, span: Column) -> Column:
        """Add the text since the last span and the mark; a span inside the last adds nothing."""
        gap = F.col("text").substr((done["at"] + 1).cast("int"), (span["start"] - done["at"]).cast("int"))
        added = F.when(span["start"] >= done["at"], F.concat(done["text"], gap, F.lit(mark)))
        return F.struct(
            F.coalesce(added, done["text"]).alias("text"), F.greatest(done["at"], span["end"]).alias("at")
        )

    tail = F.col("text").substr(F.col("_cut.at").cast("int") + 1, F.length("text"))
    hit = hinted(hit, 24, F.size("_places"))
    cleaned = own.join(hit, same_row(own, hit), "left").withColumn("_cut", F.aggregate("_places", start, cut))
    text = F.when(F.col("_places").isNotNull(), F.concat("_cut.text", tail)).otherwise(F.col("text"))
    cleaned = cleaned.withColumn("text", text)
    if "n_chars" in docs.columns:
        length = F.when(F.col("_places").isNotNull(), F.length("text").cast("long")).otherwise(F.col("n_chars"))
        cleaned = cleaned.withColumn("n_chars", length)
    return put_back(cleaned, docs, own)


_DUCK_NAME = "([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
_DUCK = {
    0: (_DUCK_NAME + _SET.replace("'", "''") + f"({_RUN}+)", 2, "length(v) >= 12"),
    1: (r"AKIA[A-Z0-9]+", 0, "length(v) >= 18"),
    2: (r"[0-9a-f]+", 0, "length(v) >= 16"),
    3: (f"{_RUN}+", 0, "length(v) >= 16 AND regexp_matches(v, '[0-9]')"),
}
_DUCK_PARTS = " UNION ALL ".join(
    f"""SELECT r, doc_id, source, {k} AS kind, unnest(regexp_split_to_array(text, '{p}')) AS gap,
      unnest(list_concat(regexp_extract_all(text, '{p}'), [''])) AS hit,
      unnest(list_concat(regexp_extract_all(text, '{p}', {g}), [''])) AS v,
      unnest(range(0, len(regexp_extract_all(text, '{p}')) + 1)) AS i FROM d WHERE text <> ''"""
    for k, (p, g, _) in _DUCK.items()
)
OP7_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, text FROM documents),
p AS ({_DUCK_PARTS}),
e AS (SELECT *, sum(length(gap) + length(hit)) OVER (PARTITION BY r, kind ORDER BY i)::BIGINT AS stop FROM p),
c AS (
  SELECT r, doc_id, source, kind, v, stop - length(hit) AS start, stop FROM e
  WHERE hit <> '' AND CASE kind {" ".join(f"WHEN {k} THEN {w}" for k, (_, _, w) in _DUCK.items())} END),
o AS (
  SELECT v, count(DISTINCT coalesce('s' || source, '')) AS owners, bool_or(kind < {TOKEN}) AS known
  FROM c GROUP BY v),
b AS (
  SELECT c.*, owners, known,
    max(CASE WHEN kind < {TOKEN} THEN stop END) OVER (PARTITION BY r ORDER BY start, kind) AS upto,
    min(CASE WHEN kind < {TOKEN} THEN start END) OVER (PARTITION BY r ORDER BY start, kind
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS since
  FROM c JOIN o USING (v)),
s AS (
  SELECT *, ['{"', '".join(k.name for k in KINDS)}'][kind + 1] || ':' || start || ':' || stop AS shown FROM b
  WHERE kind < {TOKEN} OR (coalesce(upto, 0) <= start AND coalesce(since, stop) >= stop
    AND owners <= {LIVE_OWNERS} AND (known OR (length(v) >= {LONG_TOKEN}
      AND regexp_matches(v, '[a-z]') AND regexp_matches(v, '[A-Z]'))))),
g AS (
  SELECT r, count(*) FILTER (kind = 0) AS a, count(*) FILTER (kind = 1) AS k, count(*) FILTER (kind = 2) AS h,
    string_agg(shown, ',' ORDER BY start, kind) FILTER (kind < {TOKEN}) AS base,
    string_agg(shown, ',' ORDER BY start, kind) AS spans
  FROM s GROUP BY r)
SELECT doc_id, coalesce(a, 0)::BIGINT AS n_assign, coalesce(k, 0)::BIGINT AS n_access,
  coalesce(h, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (r)
"""


@query("op7_secret_scan", OP7_SQL)
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets_by_document(load(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")
