"""Samples, splits and partitions."""

from __future__ import annotations

from pyspark.sql import functions as F

from pixelframe.operators import sampling
from pixelframe.plans.checks.registry import query
from pixelframe.plans.checks.standins import HASH_SQL, table

FLAG_SPLIT_SQL = (
    "CASE l_returnflag WHEN 'A' THEN 'train' WHEN 'N' THEN 'validation' ELSE 'test' END"
)


@query(
    "split_filter",
    "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag = 'N'",
)
def split_filter(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").withColumn("split", F.expr(FLAG_SPLIT_SQL))
    return sampling.split_rows(rows, "validation").select("l_orderkey", "l_linenumber")


ORDER_HASH_SQL = HASH_SQL.format("o_orderkey")


@query(
    "hash_split",
    f"""SELECT o_orderkey,
      CASE WHEN {ORDER_HASH_SQL} < 0.8::DOUBLE THEN 'train' ELSE 'test' END AS part FROM orders""",
)
def hash_split(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    return sampling.hash_split(orders, "o_orderkey", {"train": 0.8, "test": 0.2})


STATUS_FRACTIONS = {"F": 0.5, "O": 0.25, "P": 0.1}


@query(
    "hash_stratified_sample",
    f"""SELECT o_orderkey, o_orderstatus FROM orders WHERE {ORDER_HASH_SQL} <
      CASE o_orderstatus WHEN 'F' THEN 0.5 WHEN 'O' THEN 0.25 WHEN 'P' THEN 0.1 ELSE 0
      END::DOUBLE""",
)
def hash_stratified_sample(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return sampling.hash_sample_by_split(orders, STATUS_FRACTIONS, "o_orderkey", "o_orderstatus")


@query("stratified_sample")
def stratified_sample(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return sampling.sample_by_split(orders, STATUS_FRACTIONS, "o_orderstatus")


@query("random_split")
def random_split(spark, sf_dir):
    train, test = sampling.random_split(table(spark, sf_dir, "orders").select("o_orderkey"))
    return train.withColumn("part", F.lit("train")).union(test.withColumn("part", F.lit("test")))


@query(
    "stratified_sample_ends",
    "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('F', 'P')",
)
def stratified_sample_ends(spark, sf_dir):
    """Fractions of one and zero: whole strata are kept and left out."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    fractions = {"F": 1.0, "O": 0.0, "P": 1.0}
    return sampling.sample_by_split(orders, fractions, "o_orderstatus")


@query("random_split_union", "SELECT o_orderkey FROM orders")
def random_split_union(spark, sf_dir):
    """Both parts together are the table: no row is lost or doubled."""
    train, test = sampling.random_split(table(spark, sf_dir, "orders").select("o_orderkey"))
    return train.union(test)


@query(
    "first_n",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 10000",
)
def first_n(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return sampling.first_rows(orders, 10000, ["o_orderkey"])


@query("partition_report", "SELECT 16::BIGINT AS partitions, count(*) AS rows FROM orders")
def partition_report(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    spread = sampling.hash_partition(orders, 16, "o_orderkey")
    return sampling.partition_report(spread).select("partitions", "rows")


@query(
    "partition_report_few_keys",
    "SELECT 100::BIGINT AS partitions, count(*) AS rows, 0::BIGINT AS min_rows FROM orders",
)
def partition_report_few_keys(spark, sf_dir):
    """Three keys leave most of 100 partitions empty; they are counted all the same."""
    orders = table(spark, sf_dir, "orders").select("o_orderstatus")
    spread = sampling.hash_partition(orders, 100, "o_orderstatus")
    return sampling.partition_report(spread).select("partitions", "rows", "min_rows")


#: Rows wanted of each status; the last is more than there are.
EXACT = {"F": 1234, "O": 700, "P": 10**9}
EXACT_SQL = " ".join(f"WHEN '{v}' THEN {n}" for v, n in EXACT.items())


@query(
    "exact_sample",
    f"""SELECT o_orderkey, o_orderstatus FROM (SELECT o_orderkey, o_orderstatus,
      row_number() OVER (PARTITION BY o_orderstatus ORDER BY md5(o_orderkey::VARCHAR)) AS nth FROM orders)
    WHERE nth <= CASE o_orderstatus {EXACT_SQL} END""",
)
def exact_sample(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return sampling.exact_sample(orders, EXACT, "o_orderkey", "o_orderstatus")


@query(
    "first_many",
    "SELECT o_custkey, o_orderkey FROM orders ORDER BY o_custkey, o_orderkey LIMIT 12000",
)
def first_many(spark, sf_dir):
    """More first rows than a partition holds."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey").repartition(8)
    return sampling.first_many(orders, 12_000, ["o_custkey", "o_orderkey"])


@query("balanced_partitions", "SELECT 16::BIGINT AS partitions, true AS even, count(*) AS rows FROM lineitem")
def balanced_partitions(spark, sf_dir):
    """A third of all rows have one key; the fullest partition is at most 1.2 times the mean."""
    key = F.when(F.col("l_orderkey") % 3 == 0, 0).otherwise(F.col("l_suppkey"))
    rows = table(spark, sf_dir, "lineitem").select(key.alias("key"), "l_orderkey", "l_linenumber")
    report = sampling.partition_report(sampling.balanced_partition(rows, 16, "key"))
    even = (F.col("max_rows") * F.col("partitions") <= 1.2 * F.col("rows")).alias("even")
    return report.select("partitions", even, "rows")
