"""Audit and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from pixelframe.operators import audit, profile
from pixelframe.plans.checks.registry import query
from pixelframe.plans.checks.standins import table
from pixelframe.sources import files, sinks, tables
from pixelframe.storage import materialize, scratch_path

SENSOR_SQL = "CASE l_returnflag WHEN 'R' THEN 's2' WHEN 'A' THEN 's1' ELSE 'label' END"
EXPECTED = {"s2": 2, "s1": 1, "label": 1}


@query(
    "incomplete_patches",
    """WITH n AS (
      SELECT l_orderkey, count(*) FILTER (l_returnflag = 'R') AS s2,
        count(*) FILTER (l_returnflag = 'A') AS s1, count(*) FILTER (l_returnflag = 'N') AS label
      FROM lineitem GROUP BY l_orderkey)
    SELECT o_orderkey AS patch_id, coalesce(s2, 0)::INTEGER AS ns2bands,
      coalesce(s1, 0)::INTEGER AS ns1bands, coalesce(label, 0)::INTEGER AS nlabelbands
    FROM orders LEFT JOIN n ON o_orderkey = l_orderkey
    WHERE coalesce(s2, 0) <> 2 OR coalesce(s1, 0) <> 1 OR coalesce(label, 0) <> 1""",
)
def incomplete_patches(spark, sf_dir):
    found = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("patch_id"), F.expr(SENSOR_SQL).alias("sensor")
    )
    patches = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("patch_id"))
    counts = materialize(audit.count_files(found), "file-counts")
    return audit.incomplete_patches(patches, counts, expected=EXPECTED)


@query(
    "directory_audit",
    """WITH n AS (
      SELECT l_orderkey, count(*) FILTER (l_returnflag = 'R') AS s2,
        count(*) FILTER (l_returnflag = 'A') AS s1, count(*) FILTER (l_returnflag = 'N') AS label
      FROM lineitem GROUP BY l_orderkey)
    SELECT concat('s3://store/s2/', o_orderkey, '/') AS s2_path,
      coalesce(s2, 0)::INTEGER AS ns2bands, coalesce(s1, 0)::INTEGER AS ns1bands,
      coalesce(label, 0)::INTEGER AS nlabelbands
    FROM orders LEFT JOIN n ON o_orderkey = l_orderkey
    WHERE coalesce(s2, 0) <> 2 OR coalesce(s1, 0) <> 1 OR coalesce(label, 0) <> 1""",
)
def directory_audit(spark, sf_dir):
    def directory(sensor, key, scheme="s3"):
        return F.concat(F.lit(f"{scheme}://store/"), sensor, F.lit("/"), F.col(key), F.lit("/"))

    # The inventory names half of the files by another scheme than the catalogue.
    sensor = F.expr(SENSOR_SQL)
    place = F.when(F.col("l_linenumber") % 2 == 0, directory(sensor, "l_orderkey", "s3a"))
    # Some lie deeper than right in their patch's directory.
    nested = F.when(F.col("l_linenumber") % 3 == 0, "older/x/").otherwise("")
    name = F.concat(nested, F.lit("f"), "l_linenumber", F.lit(".tif"))
    inventory = table(spark, sf_dir, "lineitem").select(
        F.concat(place.otherwise(directory(sensor, "l_orderkey")), name).alias("path")
    )
    patches = table(spark, sf_dir, "orders").select(
        *[directory(F.lit(s), "o_orderkey").alias(p) for s, p in files.SENSOR_PATHS.items()]
    )
    counts = materialize(audit.count_by_directory(inventory), "directory-counts")
    counted = audit.with_directory_counts(patches, counts)
    path = scratch_path(spark, "audit")
    sinks.write_audit(counted.where(audit.is_incomplete(EXPECTED)), path)
    return tables.read_table(spark, path).select("s2_path", *audit.COUNT_COLUMNS.values())


@query(
    "audit_delta",
    """WITH n AS (
      SELECT l_orderkey, count(DISTINCT l_linenumber) FILTER (l_returnflag = 'R') AS s2,
        count(DISTINCT l_linenumber) FILTER (l_returnflag = 'A') AS s1,
        count(DISTINCT l_linenumber) FILTER (l_returnflag = 'N') AS label
      FROM lineitem WHERE NOT (l_orderkey % 10 = 1 AND l_linenumber % 2 = 1) GROUP BY l_orderkey)
    SELECT o_orderkey AS patch_id, coalesce(s2, 0)::INTEGER AS ns2bands,
      coalesce(s1, 0)::INTEGER AS ns1bands, coalesce(label, 0)::INTEGER AS nlabelbands
    FROM orders LEFT JOIN n ON o_orderkey = l_orderkey
    WHERE coalesce(s2, 0) <> 2 OR coalesce(s1, 0) <> 1 OR coalesce(label, 0) <> 1""",
)
def audit_delta(spark, sf_dir):
    """An audit that follows an inventory: a tenth of the patches get files, another tenth lose some."""

    def directory(sensor, key):
        return F.concat(F.lit("s3://store/"), sensor, F.lit("/"), F.col(key), F.lit("/"))

    name = F.concat(F.lit("f"), "l_linenumber", F.lit(".tif"))
    place = directory(F.expr(SENSOR_SQL), "l_orderkey")
    rows = table(spark, sf_dir, "lineitem").select(
        F.concat(place, name).alias("path"), F.lit(9).alias("length"), "l_orderkey", "l_linenumber"
    )
    rows = rows.dropDuplicates(["path"])
    odd = F.col("l_linenumber") % 2 == 1
    before = rows.where(~((F.col("l_orderkey") % 10 == 0) & odd)).select("path", "length")
    longer = F.when(F.col("l_orderkey") % 10 == 2, 10).otherwise(F.col("length")).alias("length")
    after = rows.where(~((F.col("l_orderkey") % 10 == 1) & odd)).select("path", longer)
    patches = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("patch_id"),
        *[directory(F.lit(s), "o_orderkey").alias(p) for s, p in files.SENSOR_PATHS.items()],
    )
    counts = materialize(audit.count_by_directory(before), "counts-before")
    previous = audit.with_directory_counts(patches, counts).where(audit.is_incomplete(EXPECTED))
    delta = materialize(audit.inventory_delta(before, after), "inventory-delta")
    counts = materialize(audit.updated_counts(counts, delta), "counts-after")
    found = audit.updated_audit(patches, materialize(previous, "audit-before"), counts, delta, expected=EXPECTED)
    return found.select("patch_id", *audit.COUNT_COLUMNS.values())


@query("row_count", "SELECT count(*) AS rows FROM lineitem")
def row_count(spark, sf_dir):
    return profile.row_count(table(spark, sf_dir, "lineitem"))


SHAPES = {"orders": 6, "lineitem": 11, "events": 6, "embeddings": 3, "pages": 3, "documents": 5}


@query(
    "dataset_shapes",
    " UNION ALL ".join(
        f"SELECT '{t}' AS dataset, count(*) AS rows, {n} AS columns FROM {t}"
        for t, n in SHAPES.items()
    ),
)
def dataset_shapes(spark, sf_dir):
    return profile.dataset_shapes({t: table(spark, sf_dir, t) for t in SHAPES})


@query(
    "split_share",
    """SELECT o_orderstatus, round(count(*) / (SELECT count(*) FROM orders), 2) AS share
    FROM orders GROUP BY o_orderstatus""",
)
def split_share(spark, sf_dir):
    return profile.split_share(table(spark, sf_dir, "orders"), "o_orderstatus")


@query(
    "label_count",
    """SELECT lang, count(quality) AS n FROM documents LEFT JOIN labels USING (doc_id)
    GROUP BY lang""",
)
def label_count(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang")
    labelled = documents.join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return profile.label_count(labelled, "quality", "lang")


EVENT_TYPES = {
    "event_id": "bigint",
    "ts": "timestamp_ntz",
    "user_id": "bigint",
    "event_type": "string",
    "value": "double",
    "props": "string",
}


@query(
    "column_summary",
    " UNION ALL ".join(
        f"""SELECT {i} AS position, '{c}' AS "column", '{t}' AS type, count({c}) AS non_null
        FROM events"""
        for i, (c, t) in enumerate(EVENT_TYPES.items())
    ),
)
def column_summary(spark, sf_dir):
    return profile.column_summary(table(spark, sf_dir, "events"))
