"""Named queries over the test tables, each with an equivalent SQL text.

``QUERIES[name](spark, sf_dir)`` returns a DataFrame built from the library's
operators; ``ORACLE_SQL[name]`` computes the same rows in plain SQL over views
named after the test tables. Output column names and types are the same on
both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.names import last_path_component, safe_name
from ledgerline.functions.numeric import nan_to_null, round_half_away
from ledgerline.operators import clean, dedup, metrics, quality, report
from ledgerline.operators.fuse import FUSION_ERP_COLUMNS, FUSION_WEB_COLUMNS, fuse
from ledgerline.operators.increments import IncrementalDedup
from ledgerline.plans import acceptance, reporting
from ledgerline.plans import chain as C
from ledgerline.session import scratch_path
from ledgerline.sources import files, infer, publication, snapshots, versions
from ledgerline.sources import tables as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn

    return deco


def _sql_list(xs):
    return ", ".join(xs)


def _sql_required(cols, positive=()):
    preds = [f"{c} IS NOT NULL" for c in cols] + [f"{c} > 0" for c in positive]
    return " AND ".join(preds)


# ---------------------------------------------------------------------------
# The stage chain as SQL common table expressions, restated from the rules.
# ---------------------------------------------------------------------------
_WEB_ORDER = ["post_date", "post_type", "post_title", "post_excerpt", "post_status", "average_rating", "total_sales"]


def _chain_sql(erp: str, link: str, web: str, event_value: str = "value") -> str:
    return f"""
WITH erp_raw AS ({erp}),
erp_clean AS (SELECT * FROM erp_raw WHERE {_sql_required(T.ERP_REQUIRED, T.ERP_POSITIVE)}),
erp_dedup AS (
  SELECT product_id, {_sql_list(f"MAX({c}) AS {c}" for c in T.ERP_MAX_COLUMNS)}
  FROM erp_clean GROUP BY product_id),
link_raw AS ({link}),
link_clean AS (SELECT * FROM link_raw WHERE {_sql_required(T.LINK_REQUIRED)}),
link_dedup AS (SELECT product_id, MIN(id_web) AS id_web FROM link_clean GROUP BY product_id),
web_raw AS ({web}),
web_clean AS (SELECT * FROM web_raw WHERE {_sql_required(T.WEB_REQUIRED)}),
web_dedup AS (
  SELECT DISTINCT ON (sku) * FROM web_clean WHERE post_type = '{T.PRODUCT_POST_TYPE}'
  ORDER BY sku, {_sql_list(f"{c} DESC NULLS LAST" for c in _WEB_ORDER)}),
target AS (SELECT product_id, id_web AS sku FROM link_dedup),
fusion AS (
  SELECT {_sql_list(FUSION_ERP_COLUMNS)}, {_sql_list(FUSION_WEB_COLUMNS)}
  FROM erp_dedup JOIN target USING (product_id) JOIN web_dedup USING (sku)),
sold AS (
  SELECT product_id FROM erp_clean GROUP BY product_id
  HAVING MAX(stock_quantity) > 0 AND bool_or(stock_status = '{T.INSTOCK_STATUS}') AND NOT bool_or(stock_status > '{T.INSTOCK_STATUS}')),
revenue AS (
  SELECT product_id, post_title, price, stock_quantity,
    CAST(ROUND(CAST(price AS DECIMAL(18,6)) * CAST(stock_quantity AS DECIMAL(18,0)), 2) AS DOUBLE) AS chiffre_affaires
  FROM fusion SEMI JOIN sold USING (product_id)),
total AS (SELECT CAST(SUM(CAST(chiffre_affaires AS DECIMAL(18,2))) AS DOUBLE) AS ca_total FROM revenue),
ev AS (SELECT event_id, user_id, value FROM (SELECT event_id, user_id, {event_value} AS value FROM events) WHERE value IS NOT NULL),
ev_stats AS (
  SELECT AVG(CASE WHEN isnan(value) THEN NULL ELSE value END) AS m,
         STDDEV_SAMP(CASE WHEN isnan(value) THEN NULL ELSE value END) AS sd FROM ev),
ev_z0 AS (
  SELECT event_id, user_id, value,
         (CASE WHEN isnan(value) THEN NULL ELSE value END - m) / NULLIF(sd, 0) AS z0
  FROM ev CROSS JOIN ev_stats),
ev_z AS (SELECT event_id, user_id, value, CASE WHEN isnan(z0) THEN NULL ELSE z0 END AS z FROM ev_z0),
zscore AS (
  SELECT event_id, user_id, value, ROUND(z, 6) AS z_score,
         CASE WHEN z > {metrics.Z_THRESHOLD} THEN '{metrics.OUTLIER_LABEL}' ELSE '{metrics.ORDINARY_LABEL}' END AS type
  FROM ev_z),
fz0 AS (SELECT product_id, post_title, price FROM fusion WHERE price IS NOT NULL),
fz_stats AS (
  SELECT AVG(CASE WHEN isnan(price) THEN NULL ELSE price END) AS m,
         STDDEV_SAMP(CASE WHEN isnan(price) THEN NULL ELSE price END) AS sd FROM fz0),
fz1 AS (
  SELECT product_id, post_title, price,
         (CASE WHEN isnan(price) THEN NULL ELSE price END - m) / NULLIF(sd, 0) AS z0
  FROM fz0 CROSS JOIN fz_stats),
fused_zscore AS (
  SELECT product_id, post_title, price, ROUND(z, 6) AS z_score,
         CASE WHEN z > {metrics.Z_THRESHOLD} THEN '{metrics.OUTLIER_LABEL}' ELSE '{metrics.ORDINARY_LABEL}' END AS type
  FROM (SELECT product_id, post_title, price, CASE WHEN isnan(z0) THEN NULL ELSE z0 END AS z FROM fz1))
"""


CHAIN_SQL = _chain_sql(T.ERP_RAW_SQL, T.LINK_RAW_SQL, T.WEB_RAW_SQL)
# The same chain over the roles with defects put in.
DIRTY_SQL = _chain_sql(T.ERP_DIRTY_SQL, T.LINK_DIRTY_SQL, T.WEB_DIRTY_SQL, T.DIRTY_EVENT["value"])


def _dirty(spark, d):
    return C.build_chain(spark, d, dirty=True)


def _zscore(spark, d, value="value"):
    z = C.events_classified(spark, d, value)
    # z is compared at 6 places (the mean/sd of two engines may differ in the
    # last bits); the label is taken from the unrounded z.
    return z.select("event_id", "user_id", "value", round_half_away("z_score", 6).alias("z_score"), "type")


# ---------------------------------------------------------------------------
# Cleaning
# ---------------------------------------------------------------------------
@register("clean_required", DIRTY_SQL + "SELECT * FROM erp_clean")
def q_clean_required(spark, d):
    return _dirty(spark, d).erp_clean


@register("clean_link", DIRTY_SQL + "SELECT * FROM link_clean")
def q_clean_link(spark, d):
    return _dirty(spark, d).link_clean


@register("clean_web", DIRTY_SQL + "SELECT * FROM web_clean")
def q_clean_web(spark, d):
    return _dirty(spark, d).web_clean


LINEITEM_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]


def _lineitem_with_empty_rows(spark, d):
    """lineitem where every column is NULL on the rows without discount."""
    li = T.table(spark, d, "lineitem")
    keep = F.col("l_discount") != F.lit(0.0)
    return li.select(*[F.when(keep, F.col(c)).alias(c) for c in LINEITEM_COLUMNS])


_EMPTY_ROWS_SQL = (
    "WITH p AS (SELECT "
    + _sql_list(f"CASE WHEN l_discount <> 0 THEN {c} END AS {c}" for c in LINEITEM_COLUMNS)
    + " FROM lineitem) "
)
_ALL_NULL_SQL = " AND ".join(f"{c} IS NULL" for c in LINEITEM_COLUMNS)


@register("drop_empty_rows", _EMPTY_ROWS_SQL + f"SELECT * FROM p WHERE NOT ({_ALL_NULL_SQL})")
def q_drop_empty_rows(spark, d):
    return clean.drop_empty_rows(_lineitem_with_empty_rows(spark, d))


@register(
    "count_empty_rows",
    _EMPTY_ROWS_SQL + f"SELECT COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE {_ALL_NULL_SQL}) AS n_empty_rows FROM p",
)
def q_count_empty_rows(spark, d):
    return clean.count_empty_rows(_lineitem_with_empty_rows(spark, d))


@register("drop_empty_columns", f"SELECT {_sql_list(LINEITEM_COLUMNS)} FROM lineitem")
def q_drop_empty_columns(spark, d):
    li = T.table(spark, d, "lineitem")
    with_void = li.withColumn("l_void", F.nullif(F.col("l_linestatus"), F.col("l_linestatus")))
    return clean.drop_empty_columns(with_void)


@register("clean_frame", _EMPTY_ROWS_SQL + f"SELECT * FROM p WHERE NOT ({_ALL_NULL_SQL})")
def q_clean_frame(spark, d):
    framed = _lineitem_with_empty_rows(spark, d).withColumn("l_void", F.lit(None).cast("string"))
    return clean.clean_frame(framed)


# ---------------------------------------------------------------------------
# Deduplication
# ---------------------------------------------------------------------------
@register("dedup_max_per_key", CHAIN_SQL + "SELECT * FROM erp_dedup")
def q_dedup_max_per_key(spark, d):
    return C.build_chain(spark, d).erp_dedup


@register(
    "dedup_min_link",
    "SELECT l_partkey AS product_id, MIN(l_suppkey) AS id_web FROM lineitem GROUP BY l_partkey",
)
def q_dedup_min_link(spark, d):
    li = T.table(spark, d, "lineitem").select(
        F.col("l_partkey").alias("product_id"), F.col("l_suppkey").alias("id_web")
    )
    return dedup.min_link(li, "product_id", "id_web")


# Text targets: one in seven isn't a number, and one in five is a number with a leading zero (equal in rank to another).
_MIXED_TARGET = (
    "CASE WHEN l_suppkey % 7 = 0 THEN concat('bon-', CAST(l_suppkey AS STRING)) "
    "WHEN l_linenumber % 5 = 0 THEN concat('0', CAST(l_suppkey AS STRING)) ELSE CAST(l_suppkey AS STRING) END"
)
_MIXED_SQL = f"WITH link AS (SELECT l_partkey AS product_id, {_MIXED_TARGET.replace('STRING', 'VARCHAR')} AS id_web FROM lineitem) "


def _mixed_links(spark, d):
    return T.table(spark, d, "lineitem").select(F.col("l_partkey").alias("product_id"), F.expr(_MIXED_TARGET).alias("id_web"))


@register(
    "dedup_min_link_numeric",
    _MIXED_SQL
    + "SELECT DISTINCT ON (product_id) product_id, id_web FROM link "
    "ORDER BY product_id, TRY_CAST(id_web AS DECIMAL(38,10)) NULLS LAST, id_web",
)
def q_dedup_min_link_numeric(spark, d):
    return dedup.min_link(_mixed_links(spark, d), "product_id", "id_web", "numeric")


@register("dedup_min_link_text", _MIXED_SQL + "SELECT product_id, MIN(id_web) AS id_web FROM link GROUP BY product_id")
def q_dedup_min_link_text(spark, d):
    """The order is decided from both key columns: some targets aren't numbers, so it is that of text."""
    links = _mixed_links(spark, d)
    posts = T.table(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("sku"))
    return dedup.min_link(links, "product_id", "id_web", dedup.link_ordering(links, "id_web", posts, "sku"))


@register("dedup_link", DIRTY_SQL + "SELECT * FROM link_dedup")
def q_dedup_link(spark, d):
    return _dirty(spark, d).link_dedup


@register("dedup_web", DIRTY_SQL + "SELECT * FROM web_dedup")
def q_dedup_web(spark, d):
    return _dirty(spark, d).web_dedup


def _in_drops(spark, label, rows, rule, prepare):
    """``rows`` in five uneven drops, each absorbed by itself: a key's rows are dealt over drops. Jobs at build time."""
    table = IncrementalDedup(spark, scratch_path(spark, label), rule, prepare)
    drop = F.pmod(F.xxhash64(*[F.col(c) for c in rows.columns]), F.lit(16))
    edges = (0, 8, 9, 11, 12, 16)
    for low, high in zip(edges, edges[1:], strict=False):
        table.absorb(rows.filter((drop >= low) & (drop < high)))
    return table.read()


@register("dedup_increments_erp", DIRTY_SQL + "SELECT * FROM erp_dedup")
def q_dedup_increments_erp(spark, d):
    """The master rule over five drops landed one after another: the same rows as in one go."""
    ch = _dirty(spark, d)
    return _in_drops(spark, "drops-erp", ch.erp_raw, C.dedup_erp, lambda rows: rows.filter(ch.keep_predicates["erp"]))


@register("dedup_increments_link", DIRTY_SQL + "SELECT * FROM link_dedup")
def q_dedup_increments_link(spark, d):
    ch = _dirty(spark, d)
    return _in_drops(spark, "drops-link", ch.link_raw, C.dedup_link, lambda rows: rows.filter(ch.keep_predicates["liaison"]))


@register("dedup_increments_web", DIRTY_SQL + "SELECT * FROM web_dedup")
def q_dedup_increments_web(spark, d):
    ch = _dirty(spark, d)
    return _in_drops(spark, "drops-web", ch.web_raw, C.dedup_web, lambda rows: rows.filter(ch.keep_predicates["web"]))


@register(
    "latest_per_key",
    """SELECT * EXCLUDE (rn) FROM (
         SELECT *, ROW_NUMBER() OVER (
           PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) AS rn
         FROM events WHERE event_type = 'purchase')
       WHERE rn = 1""",
)
def q_latest_per_key(spark, d):
    ev = T.table(spark, d, "events")
    return dedup.latest_per_key(
        ev, "user_id", "ts", tie_breakers=["event_id"], where=F.col("event_type") == F.lit("purchase")
    )


# ---------------------------------------------------------------------------
# Fusion and figures
# ---------------------------------------------------------------------------
@register("fusion", CHAIN_SQL + "SELECT * FROM fusion")
def q_fusion(spark, d):
    return C.build_chain(spark, d).fused


@register("revenue_per_product", CHAIN_SQL + "SELECT * FROM revenue")
def q_revenue_per_product(spark, d):
    return C.build_chain(spark, d).revenue


@register("revenue_total", CHAIN_SQL + "SELECT * FROM total")
def q_revenue_total(spark, d):
    return C.build_chain(spark, d).total


@register(
    "rounding_check",
    "SELECT l_orderkey, l_linenumber, ROUND(l_extendedprice * (1 - l_discount), 2) AS amount FROM lineitem",
)
def q_rounding_check(spark, d):
    li = T.table(spark, d, "lineitem")
    return li.select(
        "l_orderkey",
        "l_linenumber",
        round_half_away(F.col("l_extendedprice") * (F.lit(1) - F.col("l_discount")), 2).alias("amount"),
    )


@register("zscore_classify", CHAIN_SQL + "SELECT * FROM zscore")
def q_zscore_classify(spark, d):
    return _zscore(spark, d)


@register("zscore_missing", DIRTY_SQL + "SELECT event_id, user_id, CASE WHEN isnan(value) THEN NULL ELSE value END AS value, z_score, type FROM zscore")
def q_zscore_missing(spark, d):
    """Values that are NULL (dropped) or NaN (kept without a score) among the events."""
    return _zscore(spark, d, T.DIRTY_EVENT["value"]).withColumn("value", nan_to_null("value"))


@register("zscore_fusion", DIRTY_SQL + "SELECT * FROM fused_zscore")
def q_zscore_fusion(spark, d):
    """The outlier rule on the fused table's price, as the source pipeline applies it.

    The statistics subquery and the labelling projection both read the fused
    table: it is written once, so the join chain runs once, not twice."""
    from ledgerline.plans.batch import Stager

    fused = Stager(spark, scratch_path(spark, "zscore-stages")).put("fusion", _dirty(spark, d).fused)
    z = metrics.zscore_classify(fused, "price", keep=["product_id", "post_title", "price"])
    return z.select("product_id", "post_title", "price", round_half_away("z_score", 6).alias("z_score"), "type")


@register("zscore_counts", CHAIN_SQL + "SELECT type, COUNT(*) AS n FROM zscore GROUP BY type")
def q_zscore_counts(spark, d):
    return metrics.label_counts(C.events_classified(spark, d))


@register("outliers_only", CHAIN_SQL + f"SELECT * FROM zscore WHERE type = '{metrics.OUTLIER_LABEL}'")
def q_outliers_only(spark, d):
    return metrics.select_label(_zscore(spark, d), metrics.OUTLIER_LABEL)


@register("ordinary_only", CHAIN_SQL + f"SELECT * FROM zscore WHERE type = '{metrics.ORDINARY_LABEL}'")
def q_ordinary_only(spark, d):
    return metrics.select_label(_zscore(spark, d), metrics.ORDINARY_LABEL)


# ---------------------------------------------------------------------------
# Data-quality rules (one aggregate pass per table)
# ---------------------------------------------------------------------------
def _rule_sql(rule, table, subject, actual, expected, passed, source=None):
    passed_sql = "true" if passed is None else passed.format(a=f"({actual})")
    return (
        f"SELECT '{rule}' AS rule, '{table}' AS table_name, '{subject}' AS subject, "
        f"CAST({actual} AS DOUBLE) AS actual, '{expected}' AS expected, {passed_sql} AS passed "
        f"FROM {source or table}"
    )


def _union_sql(parts):
    return "\n UNION ALL ".join(parts)


_STAGES_NON_EMPTY = ["erp_clean", "web_clean", "link_clean", "erp_dedup", "web_dedup", "link_dedup"]


def _source_counts(ch: C.Chain) -> dict[str, DataFrame]:
    """One row ``raw, clean, dedup`` per source, one pass over each."""
    keep = ch.keep_predicates
    product = F.col("post_type") == F.lit(ch.rules.product_post_type)
    return {
        "erp": report.stage_counts(ch.erp_raw, keep["erp"], "product_id"),
        "web": report.stage_counts(ch.web_raw, keep["web"], "sku", product),
        "link": report.stage_counts(ch.link_raw, keep["liaison"], "product_id"),
    }


@register(
    "dq_non_empty",
    CHAIN_SQL + _union_sql([_rule_sql("non_empty", t, "*", "COUNT(*)", "> 0", "{a} > 0") for t in _STAGES_NON_EMPTY]),
)
def q_dq_non_empty(spark, d):
    counts = _source_counts(C.build_chain(spark, d))
    return quality.union_results(
        [
            quality.counts_table(one, {f"{name}_{stage}": [quality.counted("non_empty", stage)] for stage in ("clean", "dedup")})
            for name, one in counts.items()
        ]
    )


_NOT_NULL = [
    ("erp", T.ERP_REQUIRED, T.ERP_POSITIVE),
    ("web", T.WEB_REQUIRED, ()),
    ("link", T.LINK_REQUIRED, ()),
]
_REVENUE_COLUMNS = ["product_id", "post_title", "price", "stock_quantity", "chiffre_affaires"]


def _any_null_sql(cols):
    return " OR ".join(f"{c} IS NULL" for c in cols)


@register(
    "dq_not_null",
    DIRTY_SQL
    + _union_sql(
        [
            _rule_sql("not_null", f"{t}_{stage}", ",".join(cols), f"COUNT(*) FILTER (WHERE {_any_null_sql(cols)})", "= 0", "{a} = 0")
            for t, cols, _ in _NOT_NULL
            for stage in ("raw", "clean")
        ]
        + [_rule_sql("not_null", "revenue", ",".join(_REVENUE_COLUMNS), f"COUNT(*) FILTER (WHERE {_any_null_sql(_REVENUE_COLUMNS)})", "= 0", "{a} = 0")]
    ),
)
def q_dq_not_null(spark, d):
    """The raw sources fail the rule and the cleaned ones pass it; both come from one scan of each source."""
    ch = _dirty(spark, d)
    parts = []
    for t, cols, positive in _NOT_NULL:
        keep = F.coalesce(clean.required_predicate(cols, positive), F.lit(False))
        rules = {f"{t}_raw": [quality.not_null(cols)], f"{t}_clean": [quality.not_null(cols, where=keep)]}
        parts.append(quality.counts_table(getattr(ch, f"{t}_raw"), rules))
    parts.append(quality.evaluate(ch.revenue, "revenue", [quality.not_null(_REVENUE_COLUMNS)]))
    return quality.union_results(parts)


_UNIQUE = [("erp_dedup", "product_id"), ("web_dedup", "sku"), ("link_dedup", "product_id")]


@register(
    "dq_unique",
    CHAIN_SQL
    + _union_sql(
        [_rule_sql("unique", t, k, f"COUNT(*) - COUNT(DISTINCT {k})", "= 0", "{a} = 0") for t, k in _UNIQUE]
        + [_rule_sql("unique", "lineitem", "l_orderkey", "COUNT(*) - COUNT(DISTINCT l_orderkey)", "= 0", "{a} = 0")]
    ),
)
def q_dq_unique(spark, d):
    ch = C.build_chain(spark, d)
    parts = [quality.evaluate(getattr(ch, t), t, [quality.unique(k)]) for t, k in _UNIQUE]
    # Raw order keys repeat over their lines: this rule must fail.
    parts.append(quality.evaluate(T.table(spark, d, "lineitem"), "lineitem", [quality.unique("l_orderkey")]))
    return quality.union_results(parts)


# The second route in SQL: products by semi joins on distinct keys, amounts in decimals, outliers by a threshold.
_SECOND_SQL = f"""
, product AS (
  SELECT product_id, MAX(CAST(price AS DECIMAL(18,6))) AS price, MAX(stock_quantity) AS quantity,
         bool_or(stock_status = '{T.INSTOCK_STATUS}') AND NOT bool_or(stock_status > '{T.INSTOCK_STATUS}') AND MAX(stock_quantity) > 0 AS sold
  FROM erp_clean
  WHERE product_id IN (
    SELECT product_id FROM (SELECT product_id, MIN(id_web) AS w FROM link_clean GROUP BY product_id)
    WHERE w IN (SELECT sku FROM web_clean WHERE post_type = '{T.PRODUCT_POST_TYPE}'))
  GROUP BY product_id),
wanted AS (
  SELECT COUNT(*) AS fused, COUNT(*) FILTER (WHERE sold) AS revenue_rows,
         SUM(ROUND(price * CAST(quantity AS DECIMAL(18,0)), 2)) FILTER (WHERE sold) AS revenue_total FROM product),
wanted_outliers AS (
  SELECT COUNT(*) AS outliers FROM events
  WHERE value > (SELECT AVG(value) + {metrics.Z_THRESHOLD} * NULLIF(STDDEV_SAMP(value), 0) FROM events))
"""


def _compared_sql(rule, table, subject, actual, wanted, places, source, wanted_table="wanted"):
    value = f"(SELECT {wanted} FROM {wanted_table})"
    return (
        f"SELECT '{rule}' AS rule, '{table}' AS table_name, '{subject}' AS subject, CAST({actual} AS DOUBLE) AS actual, "
        f"'= ' || CAST(CAST({value} AS DECIMAL(38,{places})) AS VARCHAR) AS expected, "
        f"COALESCE(CAST(ROUND(CAST({actual} AS DOUBLE), 2) AS DECIMAL(38,2)) = CAST({value} AS DECIMAL(38,2)), false) AS passed FROM {source}"
    )


@register(
    "dq_row_count",
    CHAIN_SQL
    + _SECOND_SQL
    + _union_sql(
        [
            _compared_sql("row_count", "fused", "*", "COUNT(*)", "fused", 0, "fusion"),
            _compared_sql("row_count", "revenue", "*", "COUNT(*)", "revenue_rows", 0, "revenue"),
            _compared_sql("row_count", "outliers", "*", "COUNT(*)", "outliers", 0, f"zscore WHERE type = '{metrics.OUTLIER_LABEL}'", "wanted_outliers"),
        ]
    ),
)
def q_dq_row_count(spark, d):
    """Fused and revenue rows come from one aggregate over the chain; what they should be, from the second route."""
    ch = C.build_chain(spark, d)
    figures = metrics.fused_figures(ch.fused, ch.rules.instock_status)
    rows = quality.counts_table(figures, {"fused": [quality.counted("row_count", "fused_rows")], "revenue": [quality.counted("row_count", "revenue_rows")]})
    outliers = metrics.select_label(C.events_classified(spark, d), metrics.OUTLIER_LABEL)
    results = quality.union_results([rows, quality.evaluate(outliers, "outliers", [quality.row_count(None)])])
    wanted = acceptance.wanted(acceptance.surviving_products(ch), [("row_count", "fused", "fused", 0), ("row_count", "revenue", "revenue_rows", 0)])
    above = acceptance.outliers_above_threshold(T.table(spark, d, "events"), "value")
    return quality.compare(results, wanted.unionByName(acceptance.wanted(above, [("row_count", "outliers", "outliers", 0)])))


_FUSION_KEY_COLUMNS = ["product_id", "price", "stock_status", "post_title"]


@register(
    "dq_columns",
    "WITH cols AS (SELECT column_name FROM (DESCRIBE ("
    + CHAIN_SQL
    + " SELECT * FROM fusion))), req AS (SELECT * FROM (VALUES "
    + ", ".join(f"('{c}')" for c in _FUSION_KEY_COLUMNS)
    + ") t(subject)) "
    + "SELECT 'column_present' AS rule, 'fused' AS table_name, req.subject, "
    + "CASE WHEN cols.column_name IS NULL THEN 0.0 ELSE 1.0 END::DOUBLE AS actual, '= 1' AS expected, "
    + "cols.column_name IS NOT NULL AS passed FROM req LEFT JOIN cols ON req.subject = cols.column_name",
)
def q_dq_columns(spark, d):
    ch = C.build_chain(spark, d)
    return quality.columns_present(spark, ch.fused, "fused", _FUSION_KEY_COLUMNS)


@register("dq_amount", CHAIN_SQL + _SECOND_SQL + _compared_sql("amount", "total", "ca_total", "SUM(ca_total)", "revenue_total", 2, "total"))
def q_dq_amount(spark, d):
    ch = C.build_chain(spark, d)
    results = quality.evaluate(ch.total, "total", [quality.amount_equals("ca_total", None)])
    return quality.compare(results, acceptance.wanted(acceptance.surviving_products(ch), [("amount", "total", "revenue_total", 2)]))


@register(
    "dq_non_negative",
    DIRTY_SQL
    + _union_sql(
        [
            _rule_sql("non_negative", t, c, f"COUNT(*) FILTER (WHERE {c} < 0)", "= 0", "{a} = 0")
            for t, c in (("erp_raw", "price"), ("revenue", "chiffre_affaires"))
        ]
    ),
)
def q_dq_non_negative(spark, d):
    """Raw prices fail the rule, the revenue passes it."""
    ch = _dirty(spark, d)
    return quality.union_results(
        [
            quality.evaluate(ch.erp_raw, "erp_raw", [quality.non_negative("price")]),
            quality.evaluate(ch.revenue, "revenue", [quality.non_negative("chiffre_affaires")]),
        ]
    )


def _finite_sql(table, cols, source):
    missing = " + ".join(f"COUNT(*) FILTER (WHERE {c} IS NULL OR isnan({c}))" for c in cols.values())
    infinite = " + ".join(f"COUNT(*) FILTER (WHERE isinf({c}))" for c in cols.values())
    names = ",".join(cols)
    return [
        _rule_sql("no_missing", table, names, missing, "= 0", "{a} = 0", source=source),
        _rule_sql("no_infinite", table, names, infinite, "= 0", "{a} = 0", source=source),
    ]


@register(
    "dq_finite",
    CHAIN_SQL
    + f", odd AS (SELECT {T.INFINITE_EVENT['value']} AS value FROM events) "
    + _union_sql(_finite_sql("zscore", {"value": "value", "z_score": "z"}, "ev_z") + _finite_sql("events", {"value": "value"}, "odd")),
)
def q_dq_finite(spark, d):
    """The scored events pass; events with NULL, NaN and infinite values put in fail both rules."""
    z = C.events_classified(spark, d)
    odd = T.table(spark, d, "events").select(F.expr(T.INFINITE_EVENT["value"]).alias("value"))
    return quality.union_results(
        [
            quality.evaluate(df, name, [quality.no_missing(cols), quality.no_infinite(cols)])
            for df, name, cols in ((z, "zscore", ["value", "z_score"]), (odd, "events", ["value"]))
        ]
    )


# ---------------------------------------------------------------------------
# Reports
# ---------------------------------------------------------------------------
def _summary_sql():
    parts = []
    for name, raw, cols, pos in [
        ("erp", "erp_raw", T.ERP_REQUIRED, T.ERP_POSITIVE),
        ("web", "web_raw", T.WEB_REQUIRED, ()),
        ("liaison", "link_raw", T.LINK_REQUIRED, ()),
    ]:
        pred = _sql_required(cols, pos)
        parts.append(
            f"SELECT '{name}' AS source, COUNT(*) AS nb_lignes_initiales, "
            f"COUNT(*) FILTER (WHERE {pred}) AS nb_apres_nettoyage, "
            f"COUNT(*) - COUNT(*) FILTER (WHERE {pred}) AS nb_exclues FROM {raw}"
        )
    return DIRTY_SQL + _union_sql(parts)


@register("clean_summary", _summary_sql())
def q_clean_summary(spark, d):
    ch = _dirty(spark, d)
    keep = ch.keep_predicates
    return report.clean_summary(
        [("erp", ch.erp_raw, keep["erp"]), ("web", ch.web_raw, keep["web"]), ("liaison", ch.link_raw, keep["liaison"])]
    )


_REPORT_SOURCES = [
    *(f"(SELECT CAST(COUNT(*) AS DOUBLE) AS v FROM {t}_{stage})" for stage in ("raw", "clean", "dedup") for t in ("erp", "web", "link")),
    "(SELECT CAST(COUNT(*) AS DOUBLE) AS v FROM fusion)",
    "(SELECT CAST(COUNT(*) AS DOUBLE) AS v FROM revenue)",
    "(SELECT ca_total AS v FROM total)",
    f"(SELECT CAST(COUNT(*) AS DOUBLE) AS v FROM fused_zscore WHERE type = '{metrics.OUTLIER_LABEL}')",
]
_REPORT_WANTED = {10: ("fused", 0), 11: ("revenue_rows", 0), 12: ("revenue_total", 2)}


def _report_sql():
    parts = []
    for no, (label, src) in enumerate(zip(reporting.REPORT_LABELS, _REPORT_SOURCES, strict=True), start=1):
        if no in _REPORT_WANTED:
            column, places = _REPORT_WANTED[no]
            value = f"(SELECT {column} FROM wanted)"
            expected = f"CAST(CAST({value} AS DECIMAL(38,{places})) AS VARCHAR)"
            passed = f"COALESCE(CAST(ROUND(v, 2) AS DECIMAL(38,2)) = CAST({value} AS DECIMAL(38,2)), false)"
            passed = f"CAST({passed} AS VARCHAR)"
        else:
            expected, passed = "''", "CAST(NULL AS VARCHAR)"
        parts.append(f"SELECT {no} AS step_no, '{label}' AS etape, v AS resultat, {expected} AS attendu, {passed} AS passed FROM {src}")
    return DIRTY_SQL + _SECOND_SQL + _union_sql(parts)


@register("stage_report", _report_sql())
def q_stage_report(spark, d):
    """The report over the roles with defects; the figures of the fused table are expected from the second route.
    ``passed`` is given as text here: 'true', 'false', or NULL on a line without an expected figure.

    Jobs at build time: the fused stage is written (two lines read it) and the expected figures, one row, are computed."""
    from ledgerline.plans.batch import Stager

    ch = _dirty(spark, d)
    fused = Stager(spark, scratch_path(spark, "report-stages")).put("fusion", ch.fused)
    want = acceptance.surviving_products(ch).first()
    outliers = metrics.select_label(metrics.zscore_classify(fused, "price"), metrics.OUTLIER_LABEL)
    counts = _source_counts(ch)
    expected = {"fused": want["fused"], "revenue_rows": want["revenue_rows"], "revenue_total": want["revenue_total"]}
    lines = reporting.stage_report([counts["erp"], counts["web"], counts["link"]], fused, ch.rules.instock_status, outliers, expected)
    return lines.withColumn("passed", F.col("passed").cast("string"))


# ---------------------------------------------------------------------------
# Sources, sinks and names
# ---------------------------------------------------------------------------
_MANIFEST = [f"{t}.parquet" for t in T.TEST_TABLES]


@register(
    "manifest_check",
    "SELECT name, true AS present FROM (VALUES " + ", ".join(f"('{n}')" for n in _MANIFEST) + ") t(name)",
)
def q_manifest_check(spark, d):
    listing = files.list_files(spark, d, pattern="*.parquet")
    return files.manifest_presence(listing, files.expected_manifest(spark, _MANIFEST))


@register("manifest_missing", "SELECT CAST(NULL AS VARCHAR) AS name WHERE false")
def q_manifest_missing(spark, d):
    listing = files.list_files(spark, d, pattern="*.parquet")
    return files.manifest_missing(listing, files.expected_manifest(spark, _MANIFEST))


@register(
    "safe_name",
    r"""SELECT page_id, name,
           regexp_replace(regexp_replace(strip_accents(name), '[^\x00-\x7F]', '', 'g'),
                          '[^A-Za-z0-9_.-]', '_', 'g') AS safe_name
       FROM (SELECT page_id, regexp_extract(url, '([^/]+)/*$', 1) AS name FROM pages)
       WHERE name <> ''""",
)
def q_safe_name(spark, d):
    pages = T.table(spark, d, "pages").select("page_id", last_path_component("url").alias("name"))
    pages = pages.filter(F.col("name") != F.lit(""))
    return pages.select("page_id", "name", safe_name("name").alias("safe_name"))


@register(
    "safe_name_documents",
    r"""SELECT doc_id,
           regexp_replace(regexp_replace(strip_accents(text), '[^\x00-\x7F]', '', 'g'),
                          '[^A-Za-z0-9_.-]', '_', 'g') AS safe_text
       FROM documents""",
)
def q_safe_name_documents(spark, d):
    """The name rule over whole document texts (accented prose in four languages)."""
    docs = T.table(spark, d, "documents").select("doc_id", "text")
    return docs.select("doc_id", safe_name("text").alias("safe_text"))


_TEXT_SCHEMA = "doc_id bigint, text string, lang string, n_chars bigint"


@register("csv_roundtrip", "SELECT doc_id, text, lang, n_chars FROM documents")
def q_csv_roundtrip(spark, d):
    """Whole texts with quotes, commas and line breaks to CSV and back. Job at build time: the write."""
    src = T.table(spark, d, "documents").select("doc_id", "text", "lang", "n_chars")
    path = scratch_path(spark, "csv-roundtrip")
    files.write_csv(src, path)
    return files.read_csv(spark, path, _TEXT_SCHEMA)


_EXCERPT_SQL = "(SELECT c.*, t.text FROM customer c LEFT JOIN documents t ON t.doc_id = c.c_custkey)"


@register(
    "csv_landing",
    _chain_sql(
        T.ERP_RAW_SQL,
        T.LINK_RAW_SQL,
        T.WEB_RAW_SQL.replace("c_name AS post_excerpt", "text AS post_excerpt").replace("FROM customer", f"FROM {_EXCERPT_SQL}"),
    )
    + "SELECT fusion.*, 'lot ' || CAST(product_id % 7 AS VARCHAR) AS lot FROM fusion",
)
def q_csv_landing(spark, d):
    """The three roles dropped as CSV with other column orders, an extra column, whole numbers as ``12.0`` and texts with
    quotes and line breaks; landed by header name, cleaned, deduplicated and fused. Jobs at build time: the drops, their
    headers, the landed tables (each file is parsed once), and the choice of the link order."""
    from ledgerline.plans import batch

    root = scratch_path(spark, "csv-landing")
    texts = T.table(spark, d, "documents").select(F.col("doc_id").alias("sku"), "text")
    web = T.web_raw(spark, d).join(texts, "sku", "left").withColumn("post_excerpt", F.col("text")).drop("text")
    web = web.withColumn("sku", F.concat(F.col("sku").cast("string"), F.lit(".0")))
    web = web.withColumn("post_date", F.timestamp_seconds(F.round(F.col("post_date") * 100).cast("bigint")).cast("timestamp_ntz"))
    erp = T.erp_raw(spark, d).withColumn("lot", F.concat(F.lit("lot "), (F.col("product_id") % 7).cast("string")))
    for c in ("product_id", "onsale_web", "stock_quantity"):
        erp = erp.withColumn(c, F.concat(F.col(c).cast("string"), F.lit(".0")))
    erp = erp.filter("discount is not null").drop("discount")
    link = T.link_raw(spark, d).select("id_web", "product_id", F.lit("x").alias("note"))
    for name, df in (("erp", erp), ("web", web), ("liaison", link)):
        files.write_csv(df.select(*sorted(df.columns, reverse=True)), f"{root}/{name}.csv")
    stager = batch.Stager(spark, f"{root}/landed")
    landed = {name: stager.put(name, df) for name, df in batch.land_csv_sources(spark, root).items()}
    rules = C.Rules(product_post_type=T.PRODUCT_POST_TYPE, instock_status=T.INSTOCK_STATUS, erp_max_columns=(*T.ERP_MAX_COLUMNS, "lot"))
    cleaned = C.clean_stage(landed["erp"], landed["web"], landed["liaison"], rules)
    erp_d, web_d, link_d = C.dedup_stage(*cleaned, rules)
    fused = fuse(erp_d, link_d, web_d, erp_columns=[*FUSION_ERP_COLUMNS, "lot"])
    return fused.select(*FUSION_ERP_COLUMNS, *FUSION_WEB_COLUMNS, "lot")


def _dropped(spark, label, df, **options):
    """``df`` written as header CSV; then landed with inferred types. Jobs at build time: the drop and its landing."""
    path = scratch_path(spark, f"{label}-drop")
    df.write.options(**(files.CSV_WRITE_OPTIONS | options)).csv(path)
    landed, _ = infer.land_inferred(spark, path, scratch_path(spark, f"{label}-landed"))
    return landed


@register("csv_inferred", "SELECT * FROM lineitem")
def q_csv_inferred(spark, d):
    """The lines dropped as CSV; every column gets its type back from the values alone."""
    return _dropped(spark, "inferred", T.table(spark, d, "lineitem"))


@register("csv_inferred_texts", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def q_csv_inferred_texts(spark, d):
    """Whole texts with quotes, delimiters and line breaks between typed columns, dropped with semicolons."""
    return _dropped(spark, "inferred-texts", T.table(spark, d, "documents").select("doc_id", "text", "lang", "source", "n_chars"), sep=";")


# Defects of a drop, the same text on both sides: blanks, a column without values, one odd value in the last row.
_DROP = {
    "event_id": "event_id",
    "bought": "event_type = 'purchase'",
    "value": "CASE WHEN event_id % 11 <> 0 THEN value END",
    "amount": "CASE WHEN event_id % 5 = 0 THEN user_id ELSE value END",
    "visitor": "CASE WHEN event_id = (SELECT MAX(event_id) FROM events) THEN 'nobody' ELSE CAST(user_id AS {text}) END",
    "ts": "CASE WHEN event_id % 13 <> 0 THEN ts END",
    "empty": "CAST(NULL AS {text})",
}


@register("csv_inferred_defects", "SELECT " + ", ".join(f"{e.format(text='VARCHAR')} AS {n}" for n, e in _DROP.items()) + " FROM events")
def q_csv_inferred_defects(spark, d):
    """Events dropped with defects: a column is what all of its values are, so one odd value makes it text."""
    events = T.table(spark, d, "events")
    last = events.agg(F.max("event_id").alias("m")).scalar()
    made = {n: e.format(text="STRING") for n, e in _DROP.items()}
    odd = F.when(F.col("event_id") == last, "nobody").otherwise(F.col("user_id").cast("string"))
    return _dropped(spark, "inferred-defects", events.select(*[odd.alias(n) if n == "visitor" else F.expr(e).alias(n) for n, e in made.items()]))


@register("table_replaced", DIRTY_SQL + "SELECT * FROM web_dedup")
def q_table_replaced(spark, d):
    """One table replaced twice by queries over itself: raw posts, cleaned posts, newest posts. Jobs at build time: the writes."""
    root = scratch_path(spark, "replaced")
    ch = _dirty(spark, d)
    versions.replace(ch.web_raw, root)
    raw = versions.read(spark, root)
    versions.replace(clean.clean_required(raw, ch.rules.web_required), root)
    versions.replace(C.dedup_web(versions.read(spark, root), ch.rules), root)
    return versions.read(spark, root)


def _exact_total_sql(name: str, source: str, x: str) -> str:
    """``<name>(total, n)``: the fixed-point sum of ``x``, in groups of 30 binary orders of magnitude."""
    return f"""
{name}_word AS (
  SELECT bin, s, round_even(s, 0) AS high
  FROM (SELECT bin, x * pow(2, 31 - 30 * bin) AS s
    FROM (SELECT x, CASE WHEN x <> 0 THEN greatest(-30, CAST(floor(log2(abs(x)) / 30) AS INT)) ELSE 0 END AS bin FROM (SELECT {x} AS x FROM {source})))),
{name}_bin AS (
  SELECT bin, count(*) AS n, (CAST(sum(CAST(high AS HUGEINT)) AS DOUBLE)
    + CAST(sum(CAST(round_even((s - high) * pow(2, 62), 0) AS HUGEINT)) AS DOUBLE) * pow(2, -62)) * pow(2, 30 * bin - 31) AS total
  FROM {name}_word GROUP BY bin),
{name} AS (SELECT list_reduce(list(total ORDER BY bin), lambda a, b: a + b) AS total, sum(n) AS n FROM {name}_bin)"""


@register(
    "zscore_exact",
    "WITH first_sum AS (SELECT value FROM events WHERE value IS NOT NULL),"
    + _exact_total_sql("s1", "first_sum", "value")
    + ", mean AS (SELECT total / n AS m FROM s1), apart AS (SELECT value - m AS d FROM first_sum, mean),"
    + _exact_total_sql("s2", "apart", "d * d")
    + f""", sd AS (SELECT sqrt(total / (n - 1)) AS sd FROM s2)
SELECT event_id, value, (value - m) / sd AS z_score,
  CASE WHEN (value - m) / sd > {metrics.Z_THRESHOLD} THEN '{metrics.OUTLIER_LABEL}' ELSE '{metrics.ORDINARY_LABEL}' END AS type
FROM events, mean, sd WHERE value IS NOT NULL""",
)
def q_zscore_exact(spark, d):
    """z as it is, not rounded: mean and deviation come from exact sums, so any engine and partitioning gives the same bits."""
    return metrics.zscore_classify(T.table(spark, d, "events"), "value", keep=["event_id", "value"])


_SNAPSHOT_SQL = {
    "fusion": "fusion",
    "web_clean": "web_clean",
    "link_dedup": "link_dedup",
}


@register(
    "snapshot_verified",
    DIRTY_SQL + _union_sql([f"SELECT '{n}' AS table_name, COUNT(*) AS n_rows, true AS intact FROM {t}" for n, t in _SNAPSHOT_SQL.items()]),
)
def q_snapshot_verified(spark, d):
    """Three tables frozen with their digests and checked from the files. Jobs at build time: the copies and their digests."""
    root = scratch_path(spark, "frozen")
    ch = _dirty(spark, d)
    snapshots.freeze({"fusion": ch.fused, "web_clean": ch.web_clean, "link_dedup": ch.link_dedup}, root)
    return snapshots.verify(spark, root).select("table_name", "n_rows", "intact")


@register("published_roundtrip", DIRTY_SQL + "SELECT * FROM revenue")
def q_published_roundtrip(spark, d):
    """The revenue table published as CSV under a root and fetched from there by name. Job at build time: the write."""
    root = scratch_path(spark, "published")
    ch = _dirty(spark, d)
    files.write_csv(ch.revenue, f"{root}/ca_par_produit")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ch.revenue.schema)
    return files.read_csv(spark, f"{root}/ca_par_produit", kinds)


@register("published_commit", DIRTY_SQL + "SELECT * FROM fusion")
def q_published_commit(spark, d):
    """The fused table published as one ordered CSV set under a name that held an older set, and fetched by its manifest
    after every part was checked. Jobs at build time: the writes and the check."""
    root = scratch_path(spark, "publication")
    fused = _dirty(spark, d).fused
    publication.publish(fused.filter("price > 1000"), root)
    publication.publish(fused, root, order_by=["product_id"], part_rows=100_000)
    return publication.read(spark, root)


@register("published_texts", "SELECT doc_id, lang, source, text FROM documents")
def q_published_texts(spark, d):
    """Whole texts (line breaks, quotes, empty texts apart from NULL) published as one set and fetched by its manifest."""
    root = scratch_path(spark, "publication-texts")
    publication.publish(T.table(spark, d, "documents").select("doc_id", "lang", "source", "text"), root, part_rows=20_000)
    return publication.read(spark, root)


@register("split_roundtrip", DIRTY_SQL + "SELECT event_id, user_id, CASE WHEN isnan(value) THEN NULL ELSE value END AS value, z_score, type FROM zscore")
def q_split_roundtrip(spark, d):
    """Both label sets written in one pass, then read label by label. Job at build time: the write."""
    path = scratch_path(spark, "split")
    files.write_split_by_label(_zscore(spark, d, T.DIRTY_EVENT["value"]).withColumn("value", nan_to_null("value")), path, "type")
    both = spark.read.schema("event_id bigint, user_id bigint, value double, z_score double, type string").parquet(path)
    return metrics.select_label(both, metrics.OUTLIER_LABEL).unionByName(metrics.select_label(both, metrics.ORDINARY_LABEL))


@register("snapshot_roundtrip", DIRTY_SQL + "SELECT * FROM fusion")
def q_snapshot_roundtrip(spark, d):
    """Write the dedup stages, fuse from the written files, snapshot all four
    datasets, and read the fused table back from the snapshot. Jobs at build time: the writes."""
    from ledgerline.plans.batch import Stager

    ch = _dirty(spark, d)
    st = Stager(spark, scratch_path(spark, "stages"))
    fused, _, _ = C.figures_stage(*st.put_dedups(ch.erp_dedup, ch.web_dedup, ch.link_dedup))
    st.put("fusion", fused)
    snap = files.copy_datasets(spark, st.paths, scratch_path(spark, "snapshot"))
    return spark.read.parquet(snap["fusion"])
