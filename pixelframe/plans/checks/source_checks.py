"""Scans, sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from pixelframe.operators import catalog, sampling
from pixelframe.plans.checks.registry import query
from pixelframe.plans.checks.standins import PIXELS_SQL, pixel_rows, table
from pixelframe.sources import files, rasters, sinks, tables
from pixelframe.storage import scratch_path


@query("scan_pruned", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def scan_pruned(spark, sf_dir):
    schema = T.StructType(
        [
            T.StructField("o_orderkey", T.LongType()),
            T.StructField("o_orderstatus", T.StringType()),
            T.StructField("o_totalprice", T.DoubleType()),
        ]
    )
    return table(spark, sf_dir, "orders", schema)


@query("scan_footer_schema", "SELECT * FROM customer")
def scan_footer_schema(spark, sf_dir):
    return table(spark, sf_dir, "customer")


@query(
    "metadata_ingest",
    """SELECT o_orderkey::VARCHAR AS o_orderkey, o_orderstatus, o_custkey::DOUBLE AS o_custkey
    FROM orders""",
)
def metadata_ingest(spark, sf_dir):
    declared = T.StructType(
        [
            T.StructField("o_orderkey", T.StringType()),
            T.StructField("o_orderstatus", T.StringType()),
            T.StructField("o_custkey", T.DoubleType()),
        ]
    )
    return tables.read_metadata(spark, f"{sf_dir}/orders.parquet", declared)


@query(
    "drop_metadata_columns",
    "SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem",
)
def drop_metadata_columns(spark, sf_dir):
    dropped = [
        "l_partkey", "l_suppkey", "l_extendedprice", "l_discount", "l_tax", "l_linestatus",
        "l_shipdate",
    ]
    return catalog.drop_columns(table(spark, sf_dir, "lineitem"), dropped)


@query(
    "csv_dictionary",
    """SELECT c_custkey::VARCHAR AS "ID", c_nationkey::VARCHAR AS "ID_NEW", c_name AS "DESC"
       FROM customer""",
)
def csv_dictionary(spark, sf_dir):
    path = scratch_path(spark, "dictionary")
    table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("ID"),
        F.col("c_nationkey").alias("ID_NEW"),
        F.col("c_name").alias("DESC"),
    ).write.csv(path, header=True)
    return tables.read_label_dictionary(spark, path)


@query(
    "csv_inferred",
    """SELECT p_partkey::INTEGER AS p_partkey, p_name, p_brand, p_size, p_retailprice FROM part""",
)
def csv_inferred(spark, sf_dir):
    path = scratch_path(spark, "inferred")
    part = table(spark, sf_dir, "part")
    part.select("p_partkey", "p_name", "p_brand", "p_size", "p_retailprice").write.csv(
        path, sep=";", header=True
    )
    return tables.read_csv_inferred(spark, path, sep=";")


@query("sink_roundtrip", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def sink_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "orders")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    sinks.write_table(orders, path, ["o_orderstatus"])
    stored = tables.read_table(spark, path)
    return sampling.split_rows(stored, "F", "o_orderstatus").select("o_orderkey", "o_totalprice")


@query(
    "pixel_sink",
    f"""WITH {PIXELS_SQL}
    SELECT vec_id, VV, VH, B, G, R, NIR, label FROM px WHERE split = 'train'""",
)
def pixel_sink(spark, sf_dir):
    path = scratch_path(spark, "pixels")
    rows = pixel_rows(spark, sf_dir).drop("pos")
    sinks.write_pixels(rows.withColumn(rasters.ERROR, F.lit(None).cast("string")), path)
    return sampling.split_rows(sinks.read_pixels(spark, path), "train").drop("split")


@query(
    "file_inventory",
    """SELECT o_orderstatus AS status, o_orderpriority AS priority
       FROM orders GROUP BY ALL""",
)
def file_inventory(spark, sf_dir):
    path = scratch_path(spark, "inventory")
    sinks.write_table(
        table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority"),
        path,
        ["o_orderstatus", "o_orderpriority"],
    )
    found = files.list_root(spark, path, ".parquet", levels=1).where(F.col("length") > 0)
    part = r"o_orderstatus=([^/]*)/o_orderpriority=([^/]*)/"
    return found.select(
        F.regexp_extract("path", part, 1).alias("status"),
        F.url_decode(F.regexp_extract("path", part, 2)).alias("priority"),
    ).distinct()


@query(
    "load_files",
    "SELECT o_orderstatus AS status, count(*) AS rows FROM orders GROUP BY o_orderstatus",
)
def load_files(spark, sf_dir):
    path = scratch_path(spark, "loaded")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    sinks.write_table(orders.withColumn("part", F.col("o_orderstatus")), path, ["part"])
    loaded = files.load_files(spark, path, format="parquet", suffix=".parquet")
    return loaded.groupBy(F.col("o_orderstatus").alias("status")).agg(
        F.count(F.lit(1)).alias("rows")
    )


@query(
    "schema_drift",
    """SELECT o_orderkey, o_custkey::VARCHAR AS o_custkey, o_totalprice, NULL AS reason FROM orders WHERE o_orderkey % 4 < 3
    UNION ALL SELECT NULL, NULL, NULL, 'column o_custkey is array<bigint>, not string'
    UNION ALL SELECT NULL, NULL, NULL, 'column o_totalprice is missing'""",
)
def schema_drift(spark, sf_dir):
    """Files of five shapes: three are brought to one schema, the other two are rejects with a reason."""
    root = scratch_path(spark, "drift")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    own = [orders.where(F.col("o_orderkey") % 4 == i).coalesce(1) for i in range(4)]
    shapes = [
        own[0],
        own[1].withColumn("o_custkey", F.col("o_custkey").cast("string")),
        own[2].select("o_totalprice", "o_orderkey", "o_custkey"),
        own[3].withColumn("o_custkey", F.array("o_custkey")),
        own[3].drop("o_totalprice"),
    ]
    for i, df in enumerate(shapes):
        df.write.parquet(f"{root}/{i}")
    wanted = T.StructType.fromDDL("o_orderkey bigint, o_custkey string, o_totalprice double")
    found = files.list_root(spark, root, suffix=".parquet", levels=1)
    drift = tables.read_drifting(spark, found, wanted)
    return drift.rows.unionByName(drift.rejects.select("reason"), allowMissingColumns=True)
