"""The test tables and their mapping onto the three source roles.

The test data has no product master, shop posts or link table; these views cast
TPC-H-like tables into those roles (column renames and projections only, so
Parquet column pruning and filter pushdown reach the scan):

* product master (erp)  <- lineitem: one order key repeats over its lines,
  so the per-key MAX dedup has real work.
* link (liaison)        <- orders: order key -> customer key.
* shop posts (web)      <- customer: customer key, segment as post type.

The test tables hold no NULLs, so ``discount`` carries ``NULLIF(l_discount, 0)``
as one more required column of the product master: the cleaning rule then has
rows to drop.

``erp_dirty``, ``web_dirty`` and ``link_dirty`` are the same roles with defects put
in by expressions on the keys (NULL, zero and negative prices, outlier prices,
NULL and repeated keys, ties and NULLs in the date), the same in Spark and in
SQL, so that every cleaning and dedup rule meets rows it has to act on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The test tables, as listed with the test data.
TEST_TABLES = [
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
]

# Fixed values of the mapping: the returned-flag value marking an item "on sale
# on the web", the line status counting as "in stock", and the segment kept as
# the "product" post type.
ONSALE_FLAG = "N"
INSTOCK_STATUS = "O"
PRODUCT_POST_TYPE = "BUILDING"

# Schemas of the test tables the queries read, as stored (declared,
# so no scan infers them; timestamps carry no time zone).
TEST_TABLE_SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "pages": "page_id bigint, url string, html string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}

ERP_REQUIRED = ["product_id", "onsale_web", "price", "stock_quantity", "stock_status", "discount"]
ERP_POSITIVE = ["price"]
ERP_MAX_COLUMNS = ["onsale_web", "price", "stock_quantity", "stock_status"]
WEB_REQUIRED = ["sku"]
LINK_REQUIRED = ["product_id", "id_web"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = TEST_TABLE_SCHEMAS.get(name)
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def erp_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("product_id"),
        F.when(F.col("l_returnflag") == F.lit(ONSALE_FLAG), F.lit(1)).otherwise(F.lit(0)).alias("onsale_web"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").cast("bigint").alias("stock_quantity"),
        F.col("l_linestatus").alias("stock_status"),
        F.nullif(F.col("l_discount"), F.lit(0.0)).alias("discount"),
    )


def link_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("product_id"), F.col("o_custkey").alias("id_web"))


def web_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("sku"),
        F.col("c_mktsegment").alias("post_type"),
        F.col("c_acctbal").alias("post_date"),
        F.col("c_name").alias("post_title"),
        F.col("c_name").alias("post_excerpt"),
        F.col("c_nationkey").cast("string").alias("post_status"),
        F.col("c_acctbal").alias("average_rating"),
        F.col("c_nationkey").cast("double").alias("total_sales"),
    )


# One SQL expression per column with defects; both engines evaluate the same text.
DIRTY_ERP = {
    "price": "CASE WHEN l_partkey % 50 = 0 THEN 0.0 WHEN l_partkey % 50 = 1 THEN -l_extendedprice "
    "WHEN l_partkey % 50 = 2 THEN NULL WHEN l_orderkey % 97 = 0 THEN l_extendedprice * 20 ELSE l_extendedprice END",
}
DIRTY_WEB = {
    "sku": "CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_custkey - c_custkey % 4 END",
    "post_date": "CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE floor(c_acctbal / 4000.0) END",
}
DIRTY_LINK = {"id_web": "CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE o_custkey - o_custkey % 4 END"}
DIRTY_LINK_AGAIN = {"id_web": "CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE o_custkey - o_custkey % 4 - 4 END"}
DIRTY_EVENT = {
    "value": "CASE WHEN event_id % 40 = 0 THEN NULL WHEN event_id % 40 = 1 THEN CAST('NaN' AS DOUBLE) ELSE value END",
}
INFINITE_EVENT = {
    "value": "CASE WHEN event_id % 50 = 0 THEN CAST('Infinity' AS DOUBLE) WHEN event_id % 50 = 1 THEN CAST('-Infinity' AS DOUBLE) "
    "WHEN event_id % 50 = 2 THEN CAST('NaN' AS DOUBLE) WHEN event_id % 50 = 3 THEN NULL ELSE value END",
}


def erp_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("product_id"),
        F.when(F.col("l_returnflag") == F.lit(ONSALE_FLAG), F.lit(1)).otherwise(F.lit(0)).alias("onsale_web"),
        F.expr(DIRTY_ERP["price"]).alias("price"),
        F.col("l_quantity").cast("bigint").alias("stock_quantity"),
        F.col("l_linestatus").alias("stock_status"),
        F.nullif(F.col("l_discount"), F.lit(0.0)).alias("discount"),
    )


def link_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order once, and every third once more with another target: keys repeat."""
    o = table(spark, sf_dir, "orders")
    one = o.select(F.col("o_orderkey").alias("product_id"), F.expr(DIRTY_LINK["id_web"]).alias("id_web"))
    two = o.filter("o_orderkey % 3 = 0").select(F.col("o_orderkey").alias("product_id"), F.expr(DIRTY_LINK_AGAIN["id_web"]).alias("id_web"))
    return one.unionByName(two)


def web_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.expr(DIRTY_WEB["sku"]).alias("sku"),
        F.col("c_mktsegment").alias("post_type"),
        F.expr(DIRTY_WEB["post_date"]).cast("double").alias("post_date"),
        F.col("c_name").alias("post_title"),
        F.col("c_name").alias("post_excerpt"),
        F.col("c_nationkey").cast("string").alias("post_status"),
        F.col("c_acctbal").alias("average_rating"),
        F.col("c_nationkey").cast("double").alias("total_sales"),
    )


# The same mapping as SQL text, for the DuckDB oracle (one definition per role).
ERP_RAW_SQL = f"""
SELECT l_orderkey AS product_id,
       CASE WHEN l_returnflag = '{ONSALE_FLAG}' THEN 1 ELSE 0 END AS onsale_web,
       l_extendedprice AS price,
       CAST(l_quantity AS BIGINT) AS stock_quantity,
       l_linestatus AS stock_status,
       NULLIF(l_discount, 0.0) AS discount
FROM lineitem"""

LINK_RAW_SQL = "SELECT o_orderkey AS product_id, o_custkey AS id_web FROM orders"

WEB_RAW_SQL = """
SELECT c_custkey AS sku, c_mktsegment AS post_type, c_acctbal AS post_date,
       c_name AS post_title, c_name AS post_excerpt,
       CAST(c_nationkey AS VARCHAR) AS post_status,
       c_acctbal AS average_rating, CAST(c_nationkey AS DOUBLE) AS total_sales
FROM customer"""

ERP_DIRTY_SQL = ERP_RAW_SQL.replace("l_extendedprice AS price", DIRTY_ERP["price"] + " AS price")

LINK_DIRTY_SQL = f"""
SELECT o_orderkey AS product_id, {DIRTY_LINK["id_web"]} AS id_web FROM orders
UNION ALL
SELECT o_orderkey, {DIRTY_LINK_AGAIN["id_web"]} FROM orders WHERE o_orderkey % 3 = 0"""

WEB_DIRTY_SQL = WEB_RAW_SQL.replace("c_custkey AS sku", DIRTY_WEB["sku"] + " AS sku").replace(
    "c_acctbal AS post_date", f"CAST({DIRTY_WEB['post_date']} AS DOUBLE) AS post_date"
)
