"""Expected figures, computed from the data by a second route.

The rules on row counts and amounts compare the chain with figures that do not
come from it: products are counted by semi joins on distinct keys, amounts are
summed in decimals, and outliers are counted against a threshold. A caller who
knows the figures can pass them instead; without either, ``passed`` is NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators import metrics
from ledgerline.plans.chain import Chain


def surviving_products(ch: Chain) -> DataFrame:
    """One row: ``fused``, ``revenue_rows``, ``revenue_total`` of the products that keep a link to a kept post."""
    status = ch.rules.instock_status
    products = ch.erp_clean.groupBy("product_id").agg(
        F.max(F.col("price").cast("decimal(18,6)")).alias("price"),
        F.max("stock_quantity").alias("quantity"),
        F.count_if(F.col("stock_status") == F.lit(status)).alias("at"),
        F.count_if(F.col("stock_status") > F.lit(status)).alias("above"),
    )
    posts = ch.web_clean.filter(F.col("post_type") == F.lit(ch.rules.product_post_type)).select(F.col("sku").alias("id_web")).distinct()
    linked = ch.link_clean.groupBy("product_id").agg(F.min("id_web").alias("id_web")).join(posts, "id_web", "left_semi").select("product_id")
    alive = products.join(linked, "product_id", "left_semi")
    sold = (F.col("quantity") > 0) & (F.col("at") > 0) & (F.col("above") == 0)
    amount = F.round(F.col("price") * F.col("quantity").cast("decimal(18,0)"), 2).cast("decimal(38,2)")
    return alive.agg(F.count(F.lit(1)).alias("fused"), F.count_if(sold).alias("revenue_rows"), F.sum(F.when(sold, amount)).alias("revenue_total"))


def outliers_above_threshold(df: DataFrame, value: str) -> DataFrame:
    """One row ``outliers``: values above mean + threshold x sample deviation (none without spread)."""
    v = df.filter(F.col(value).isNotNull() & ~F.isnan(value)).select(F.col(value).alias("v"))
    line = v.agg((F.avg("v") + F.lit(metrics.Z_THRESHOLD) * F.nullif(F.stddev_samp("v"), F.lit(0.0))).alias("line")).scalar()
    return v.agg(F.count_if(F.col("v") > line).alias("outliers"))


def wanted(figures: DataFrame, rows: list[tuple[str, str, str, int]]) -> DataFrame:
    """``rule, table_name, places, value`` from a one-row table; ``rows``: (rule, table, column, places)."""
    parts = [
        F.struct(F.lit(rule).alias("rule"), F.lit(table).alias("table_name"), F.lit(places).alias("places"), F.col(c).cast("double").alias("value"))
        for rule, table, c, places in rows
    ]
    return figures.select(F.inline(F.array(*parts)))
