"""Three-way fusion of product master, link table and shop posts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The fused table's columns, master columns first, then post columns.
FUSION_ERP_COLUMNS = ["product_id", "onsale_web", "price", "stock_quantity", "stock_status"]
FUSION_WEB_COLUMNS = ["post_title", "post_excerpt", "post_status", "post_type", "average_rating", "total_sales"]


def fuse(
    erp: DataFrame,
    link: DataFrame,
    web: DataFrame,
    erp_key: str = "product_id",
    link_source: str = "product_id",
    link_target: str = "id_web",
    web_key: str = "sku",
    erp_columns: Sequence[str] = FUSION_ERP_COLUMNS,
    web_columns: Sequence[str] = FUSION_WEB_COLUMNS,
) -> DataFrame:
    """``erp JOIN link ON erp_key = link_source JOIN web ON link_target = web_key``.

    Inner joins: unmatched rows on any side drop out. Neither link column is kept.
    With deduplicated inputs (unique keys on every side) no row fans out.

    Plan: the first join is on the key both dedup aggregates are already
    hash-partitioned by, so it adds no exchange; only the link target is
    re-shuffled for the second join. A side is broadcast only when its size --
    estimated from the scan at planning, or measured by AQE at run time -- is
    under ``spark.sql.autoBroadcastJoinThreshold``; otherwise sort-merge joins
    run, with AQE splitting skewed partitions.
    """
    lk = link.select(
        F.col(link_source).alias("__link_src"),
        F.col(link_target).alias("__link_tgt"),
    )
    e = erp.select(*erp_columns)
    w = web.select(F.col(web_key).alias("__web_key"), *web_columns)
    joined = e.join(lk, e[erp_key] == lk["__link_src"], "inner").join(
        w, F.col("__link_tgt") == w["__web_key"], "inner"
    )
    return joined.select(*[e[c] for c in erp_columns], *[w[c] for c in web_columns])
