"""The stage chain over the test tables: raw -> clean -> dedup -> fusion -> figures.

Every stage is a lazy DataFrame; nothing runs until a query is executed or the
batch run writes the stage.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators import clean, dedup, fuse, metrics
from ledgerline.sources import tables as T


@dataclass(frozen=True)
class Rules:
    """Column rules of the three sources. Defaults are the product-shop rules;
    ``TEST_TABLE_RULES`` fits the test-table mapping."""

    erp_required: tuple = ("product_id", "onsale_web", "price", "stock_quantity", "stock_status")
    erp_positive: tuple = ("price",)
    erp_max_columns: tuple = ("onsale_web", "price", "stock_quantity", "stock_status")
    web_required: tuple = ("sku",)
    link_required: tuple = ("product_id", "id_web")
    # The post type kept as a product, and the sellable stock status.
    product_post_type: str = "product"
    instock_status: str = "instock"
    # auto: numeric when every set key of both sides is a number, else text (typed number columns: their own order).
    link_ordering: str = "auto"
    # Deterministic winner among posts with the same date: every other column decides.
    web_tie_breakers: tuple | str = "all"

    def keep_predicates(self):
        return {
            "erp": clean.required_predicate(self.erp_required, self.erp_positive),
            "web": clean.required_predicate(self.web_required),
            "liaison": clean.required_predicate(self.link_required),
        }


TEST_TABLE_RULES = Rules(
    erp_required=tuple(T.ERP_REQUIRED),
    erp_positive=tuple(T.ERP_POSITIVE),
    erp_max_columns=tuple(T.ERP_MAX_COLUMNS),
    web_required=tuple(T.WEB_REQUIRED),
    link_required=tuple(T.LINK_REQUIRED),
    product_post_type=T.PRODUCT_POST_TYPE,
    instock_status=T.INSTOCK_STATUS,
    link_ordering="native",
)


class Chain:
    """The stages over the test tables, each built on first use.

    A query touching one stage never analyses the others (building all of
    them eagerly costs about a second of driver time per query).
    """

    def __init__(self, spark: SparkSession, sf_dir: str, rules: Rules = TEST_TABLE_RULES, dirty: bool = False):
        """``dirty``: the roles with defects put in (see ``ledgerline.sources.tables``)."""
        self.spark, self.sf_dir, self.rules, self.dirty = spark, sf_dir, rules, dirty

    @cached_property
    def erp_raw(self) -> DataFrame:
        return (T.erp_dirty if self.dirty else T.erp_raw)(self.spark, self.sf_dir)

    @cached_property
    def web_raw(self) -> DataFrame:
        return (T.web_dirty if self.dirty else T.web_raw)(self.spark, self.sf_dir)

    @cached_property
    def link_raw(self) -> DataFrame:
        return (T.link_dirty if self.dirty else T.link_raw)(self.spark, self.sf_dir)

    @cached_property
    def erp_clean(self) -> DataFrame:
        return clean.clean_required(self.erp_raw, self.rules.erp_required, self.rules.erp_positive)

    @cached_property
    def web_clean(self) -> DataFrame:
        return clean.clean_required(self.web_raw, self.rules.web_required)

    @cached_property
    def link_clean(self) -> DataFrame:
        return clean.clean_required(self.link_raw, self.rules.link_required)

    @cached_property
    def erp_dedup(self) -> DataFrame:
        return dedup_erp(self.erp_clean, self.rules)

    @cached_property
    def web_dedup(self) -> DataFrame:
        return dedup_web(self.web_clean, self.rules)

    @cached_property
    def link_dedup(self) -> DataFrame:
        return dedup_link(self.link_clean, self.rules, self.web_clean)

    @cached_property
    def fused(self) -> DataFrame:
        return fuse.fuse(self.erp_dedup, self.link_dedup, self.web_dedup)

    @cached_property
    def revenue(self) -> DataFrame:
        return metrics.revenue_per_product(self.fused, instock_status=self.rules.instock_status)

    @cached_property
    def total(self) -> DataFrame:
        return metrics.revenue_total(self.revenue)

    @property
    def keep_predicates(self):
        return self.rules.keep_predicates()


def dedup_erp(erp_clean: DataFrame, rules: Rules = TEST_TABLE_RULES) -> DataFrame:
    return dedup.max_per_key(erp_clean, "product_id", rules.erp_max_columns)


def dedup_web(web_clean: DataFrame, rules: Rules = TEST_TABLE_RULES) -> DataFrame:
    return dedup.latest_per_key(
        web_clean,
        "sku",
        "post_date",
        tie_breakers=rules.web_tie_breakers,
        where=F.col("post_type") == F.lit(rules.product_post_type),
    )


def dedup_link(link_clean: DataFrame, rules: Rules = TEST_TABLE_RULES, web_clean: DataFrame | None = None) -> DataFrame:
    ordering = rules.link_ordering
    if ordering == "auto":
        if web_clean is None:
            raise ValueError("link_ordering 'auto' is decided from both key columns: pass web_clean")
        ordering = dedup.link_ordering(link_clean, "id_web", web_clean, "sku")
    return dedup.min_link(link_clean, "product_id", "id_web", ordering)


def clean_stage(erp_raw: DataFrame, web_raw: DataFrame, link_raw: DataFrame, rules: Rules = TEST_TABLE_RULES):
    return (
        clean.clean_required(erp_raw, rules.erp_required, rules.erp_positive),
        clean.clean_required(web_raw, rules.web_required),
        clean.clean_required(link_raw, rules.link_required),
    )


def dedup_stage(erp_clean: DataFrame, web_clean: DataFrame, link_clean: DataFrame, rules: Rules = TEST_TABLE_RULES):
    return dedup_erp(erp_clean, rules), dedup_web(web_clean, rules), dedup_link(link_clean, rules, web_clean)


def figures_stage(erp_dedup: DataFrame, web_dedup: DataFrame, link_dedup: DataFrame, rules: Rules = TEST_TABLE_RULES):
    fused = fuse.fuse(erp_dedup, link_dedup, web_dedup)
    revenue = metrics.revenue_per_product(fused, instock_status=rules.instock_status)
    total = metrics.revenue_total(revenue)
    return fused, revenue, total


def build_chain(spark: SparkSession, sf_dir: str, rules: Rules = TEST_TABLE_RULES, dirty: bool = False) -> Chain:
    return Chain(spark, sf_dir, rules, dirty)


def events_classified(spark: SparkSession, sf_dir: str, value: str = "value") -> DataFrame:
    """z-score outlier labels on ``events.value`` (the price role of the test data), or on a SQL expression of it."""
    ev = T.table(spark, sf_dir, "events").withColumn("value", F.expr(value))
    return metrics.zscore_classify(ev, "value", keep=["event_id", "user_id", "value"])
