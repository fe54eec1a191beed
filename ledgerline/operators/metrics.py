"""Revenue and z-score outlier classification."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.numeric import exact_moments, exact_sum, nan_to_null, round_half_away

# The two z-score labels and the threshold (z strictly above it is an outlier).
OUTLIER_LABEL = "millésimé"
ORDINARY_LABEL = "ordinaire"
Z_THRESHOLD = 2.0


def sellable(quantity: str = "stock_quantity", status: str = "stock_status", instock_status: str = "instock"):
    """Predicate of a sellable product: quantity > 0 and status = ``instock_status``."""
    return (F.col(quantity) > F.lit(0)) & (F.col(status) == F.lit(instock_status))


def revenue_amount(price: str = "price", quantity: str = "stock_quantity"):
    """``round(price * quantity, 2)``, half away from zero on the binary product."""
    return round_half_away(F.col(price) * F.col(quantity), 2)


def revenue_per_product(
    fused: DataFrame,
    instock_status: str = "instock",
    key: str = "product_id",
    title: str = "post_title",
    price: str = "price",
    quantity: str = "stock_quantity",
    status: str = "stock_status",
) -> DataFrame:
    """Sellable products with ``chiffre_affaires = round(price * quantity, 2)``. Map-only."""
    return fused.filter(sellable(quantity, status, instock_status)).select(
        key, title, price, quantity, revenue_amount(price, quantity).alias("chiffre_affaires")
    )


def fused_figures(fused: DataFrame, instock_status: str = "instock") -> DataFrame:
    """One row, one pass over the fused table: fused rows, revenue rows, revenue total."""
    ok = sellable(instock_status=instock_status)
    return fused.agg(
        F.count(F.lit(1)).alias("fused_rows"),
        F.count_if(ok).alias("revenue_rows"),
        exact_sum(F.when(ok, revenue_amount()), places=2).alias("revenue_total"),
    )


def revenue_total(revenue: DataFrame, amount: str = "chiffre_affaires") -> DataFrame:
    """One row ``ca_total``: exact sum of 2-place amounts (NULL when there are none)."""
    return revenue.agg(exact_sum(amount, places=2).alias("ca_total"))


def zscore_classify(
    df: DataFrame,
    value: str,
    keep: list[str] | None = None,
    label_col: str = "type",
    outlier_label: str = OUTLIER_LABEL,
    ordinary_label: str = ORDINARY_LABEL,
    threshold: float = Z_THRESHOLD,
) -> DataFrame:
    """``z = (value - mean) / sd`` over rows with a value; label ``z > threshold``.

    Rows with a NULL value are dropped; a NaN value is kept with a NULL z and
    skipped by the statistics. With one row or no spread, z is NULL (not an
    error, not NaN) and the row is ordinary; a finiteness rule then reports it.

    Mean and *sample* standard deviation come from ``exact_moments``, so z and label are the same bit by bit on every
    partitioning, also for values next to the threshold.

    Plan: the statistics are scalar subqueries over the value column, each a partial/final aggregate, inlined into a
    map-only projection. No join, and no global ``Window.partitionBy()`` (which would move every row to one task).
    """
    keep = list(keep) if keep is not None else list(df.columns)
    rows = df.filter(F.col(value).isNotNull())
    v = nan_to_null(F.col(value))
    stats = rows.select(v.alias("__v"))
    mean, sd = exact_moments(stats, "__v")
    # NaN z (an infinite value makes the mean infinite and sd NaN) -> NULL, so it
    # is never "> threshold" (NaN sorts above every number in Spark SQL).
    z = nan_to_null(F.try_divide(v - mean, F.nullif(sd, F.lit(0.0))))
    out = rows.select(*[F.col(c) for c in keep], z.alias("z_score"))
    return out.withColumn(
        label_col,
        F.when(F.col("z_score") > F.lit(threshold), F.lit(outlier_label)).otherwise(F.lit(ordinary_label)),
    )


def label_counts(classified: DataFrame, label_col: str = "type") -> DataFrame:
    """Rows per label (``type``, ``n``)."""
    return classified.groupBy(label_col).agg(F.count(F.lit(1)).alias("n"))


def select_label(classified: DataFrame, label: str, label_col: str = "type") -> DataFrame:
    return classified.filter(F.col(label_col) == F.lit(label))
