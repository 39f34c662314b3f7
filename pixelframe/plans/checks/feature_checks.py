"""Features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pixelframe.functions import indices
from pixelframe.operators import features, models, profile
from pixelframe.operators.categories import CategoryIndexer, sparse_assembler
from pixelframe.plans.checks.registry import query
from pixelframe.plans.checks.standins import BANDS_SQL, INDEX_SQL, LINEITEM_BANDS, table

LINEITEM_FEATURES_SQL = f"""WITH {BANDS_SQL},
f AS (SELECT l_orderkey, l_linenumber, {INDEX_SQL["NDVI"]} AS NDVI, {INDEX_SQL["BVI"]} AS BVI,
  {INDEX_SQL["RRadio"]} AS RRadio FROM bands)
SELECT l_orderkey, l_linenumber, NDVI, BVI, RRadio FROM f
WHERE NDVI IS NOT NULL AND BVI IS NOT NULL AND RRadio IS NOT NULL"""
RATIOS = ["NDVI", "BVI", "RRadio"]


def lineitem_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = indices.index_columns(LINEITEM_BANDS)
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", *[values[r].alias(r) for r in RATIOS]
    )


@query("skip_nulls", LINEITEM_FEATURES_SQL)
def skip_nulls(spark, sf_dir):
    return features.drop_incomplete(lineitem_ratios(spark, sf_dir), RATIOS)


@query("vector_assembly", LINEITEM_FEATURES_SQL)
def vector_assembly(spark, sf_dir):
    ids = ["l_orderkey", "l_linenumber"]
    assembled = features.assemble(
        lineitem_ratios(spark, sf_dir), "l_orderkey", keep=["l_linenumber"]
    )
    return features.vector_elements(assembled, "features", RATIOS, ids)


@query(
    "typed_columns",
    """SELECT 'c_name' AS "column", 'categorical' AS kind, count(c_name) AS non_null FROM customer
    UNION ALL SELECT 'c_mktsegment', 'categorical', count(c_mktsegment) FROM customer
    UNION ALL SELECT 'c_nationkey', 'numerical', count(c_nationkey) FROM customer""",
)
def typed_columns(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    categorical, numerical = features.columns_by_type(customer, "c_acctbal")
    chosen = customer.select(*categorical, *numerical)
    kind = F.when(F.col("column").isin(categorical), "categorical").otherwise("numerical")
    return profile.column_summary(chosen).select("column", kind.alias("kind"), "non_null")


PRIORITY_INDEX_SQL = """codes AS (
  SELECT o_orderpriority, (row_number() OVER (ORDER BY count(*) DESC, o_orderpriority) - 1)::DOUBLE
    AS idx FROM orders GROUP BY o_orderpriority)"""


@query(
    "string_index",
    f"""WITH {PRIORITY_INDEX_SQL}
    SELECT o_orderkey, o_orderpriority, idx FROM orders JOIN codes USING (o_orderpriority)""",
)
def string_index(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    indexed = CategoryIndexer(inputCols=["o_orderpriority"]).fit(orders).transform(orders)
    return indexed.select(
        "o_orderkey", "o_orderpriority", F.col("o_orderpriority_index").alias("idx")
    )


@query(
    "category_codes",
    """SELECT c_custkey, o_totalprice, idx FROM (
      SELECT o_custkey AS c_custkey,
        (row_number() OVER (ORDER BY count(*) DESC, o_custkey) - 1)::DOUBLE AS idx
      FROM orders GROUP BY o_custkey) JOIN orders ON c_custkey = o_custkey""",
)
def category_codes(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("c_custkey"), "o_totalprice"
    )
    return features.index_categories(orders, ["c_custkey"]).select(
        "c_custkey", "o_totalprice", F.col("c_custkey_index").alias("idx")
    )


@query(
    "category_keep",
    """WITH priced AS (SELECT o_orderkey,
        CASE WHEN o_orderkey % 7 <> 0 THEN o_custkey END AS customer, o_orderstatus FROM orders),
    codes AS (SELECT customer,
        (row_number() OVER (ORDER BY count(*) DESC, customer) - 1)::DOUBLE AS idx
      FROM priced WHERE o_orderstatus = 'F' AND customer IS NOT NULL GROUP BY customer)
    SELECT o_orderkey, coalesce(idx, (SELECT count(*) FROM codes)::DOUBLE) AS idx
    FROM priced LEFT JOIN codes USING (customer)""",
)
def category_keep(spark, sf_dir):
    """NULL and values unseen at the fit share one extra index."""
    customer = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_custkey")).alias("customer")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", customer, "o_orderstatus")
    index = features.fit_categories(rows.where("o_orderstatus = 'F'"), ["customer"])
    return index.transform(rows).select("o_orderkey", F.col("customer_index").alias("idx"))


@query(
    "one_hot",
    f"""WITH {PRIORITY_INDEX_SQL}
    SELECT o_orderkey, {", ".join(f"(idx = {i})::INTEGER::DOUBLE AS c{i}" for i in range(5))}
    FROM orders JOIN codes USING (o_orderpriority)""",
)
def one_hot(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    index = CategoryIndexer(inputCols=["o_orderpriority"]).fit(orders)
    encoded = sparse_assembler(index, orders, []).transform(index.transform(orders))
    return features.vector_elements(encoded, "features", [f"c{i}" for i in range(5)], ["o_orderkey"])


@query(
    "standard_scale",
    """SELECT o_orderkey, round(o_totalprice / (SELECT stddev_samp(o_totalprice) FROM orders), 6)
      AS scaled FROM orders""",
)
def standard_scale(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    stages = [
        features.assembler(["o_totalprice"], "raw", "error"),
        features.scaler("raw", "scaled_vector"),
    ]
    scaled = models.fit(stages, orders).transform(orders)
    rows = features.vector_elements(scaled, "scaled_vector", ["scaled"], ["o_orderkey"])
    return rows.withColumn("scaled", F.round("scaled", 6))
