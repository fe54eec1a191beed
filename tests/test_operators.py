"""Operators on hand-made rows: every trap of SURVEY §8 / FIXTURES §4."""

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import clean, dedup, fuse, metrics


def test_clean_required_nulls_and_positive(spark):
    df = spark.createDataFrame(
        [(1, 1, 10.0, 5, "instock"), (2, None, 10.0, 5, "instock"), (3, 1, 0.0, 5, "instock"),
         (4, 1, -1.0, 5, "instock"), (5, 1, None, 5, "x"), (6, 1, float("nan"), 5, "x")],
        "product_id long, onsale_web int, price double, stock_quantity long, stock_status string",
    )
    got = clean.clean_required(df, df.columns, ["price"]).select("product_id").collect()
    # NaN > 0 is true in Spark SQL (as in the SQL engines): the NaN row is kept.
    assert sorted(r[0] for r in got) == [1, 6]


def test_empty_rows_and_columns(spark):
    df = spark.createDataFrame(
        [(1, None, "a"), (None, None, None), (2, None, None)], "a long, b string, c string"
    )
    assert clean.drop_empty_rows(df).count() == 2
    r = clean.count_empty_rows(df).first()
    assert (r["n_rows"], r["n_empty_rows"]) == (3, 1)
    out = clean.clean_frame(df)
    assert out.columns == ["a", "c"]
    assert out.count() == 2


def test_max_per_key_mixes_rows(spark):
    df = spark.createDataFrame(
        [(1, 10, "instock"), (1, 5, "outofstock"), (2, 3, "instock")], "product_id long, q long, s string"
    )
    got = {r["product_id"]: (r["q"], r["s"]) for r in dedup.max_per_key(df, "product_id", ["q", "s"]).collect()}
    assert got == {1: (10, "outofstock"), 2: (3, "instock")}


@pytest.mark.parametrize("ordering,expected", [("numeric", "99"), ("text", "100"), ("native", "100")])
def test_min_link_ordering(spark, ordering, expected):
    df = spark.createDataFrame([(1, "99"), (1, "100"), (2, "abc")], "product_id long, id_web string")
    got = {r[0]: r[1] for r in dedup.min_link(df, "product_id", "id_web", ordering).collect()}
    assert got == {1: expected, 2: "abc"}


def test_min_link_numeric_ties_and_nulls(spark):
    rows = [(1, "099"), (1, "99"), (1, None), (2, None), (3, "x"), (3, "bon-1"), (3, None), (4, "x"), (4, "7")]
    for part in (rows, rows[::-1]):
        df = spark.createDataFrame(part, "product_id long, id_web string").repartition(5)
        got = {r[0]: r[1] for r in dedup.min_link(df, "product_id", "id_web", "numeric").collect()}
        assert got == {1: "099", 2: None, 3: "bon-1", 4: "7"}


def test_link_ordering_comes_from_both_sides(spark):
    def order(targets, keys, kind="string"):
        link = spark.createDataFrame([(1, t) for t in targets], f"product_id long, id_web {kind}")
        return dedup.link_ordering(link, "id_web", spark.createDataFrame([(k,) for k in keys], f"sku {kind}"), "sku")

    assert order(["99", None], ["100", "7"]) == "numeric"
    assert order(["99"], ["100", "bon"]) == order(["x"], ["1"]) == "text"
    assert order([1], [2], "long") == "native"


def test_latest_per_key_ties_and_nulls(spark):
    df = spark.createDataFrame(
        [("a", 1, 10, "p"), ("a", 1, 11, "p"), ("a", None, 12, "p"), ("b", None, 1, "p"), ("b", 5, 2, "x"),
         ("c", 3, 1, "p")],
        "sku string, t long, id long, post_type string",
    )
    out = dedup.latest_per_key(df, "sku", "t", tie_breakers=["id"], where=F.col("post_type") == "p")
    got = {r["sku"]: r["id"] for r in out.collect()}
    # tie on t=1 -> larger id wins; NULL t loses; the filter runs before the window.
    assert got == {"a": 11, "b": 1, "c": 1}
    assert "__rn" not in out.columns


def test_fuse_inner_joins_and_projection(spark):
    erp = spark.createDataFrame(
        [(1, 1, 10.0, 2, "instock"), (2, 0, 5.0, 1, "instock"), (3, 1, 1.0, 1, "instock")],
        "product_id long, onsale_web int, price double, stock_quantity long, stock_status string",
    )
    link = spark.createDataFrame([(1, "15298"), (2, "zz")], "product_id long, id_web string")
    web = spark.createDataFrame(
        [("15298", "T", "E", "publish", "product", 4.5, 3.0)],
        "sku string, post_title string, post_excerpt string, post_status string, post_type string, "
        "average_rating double, total_sales double",
    )
    out = fuse.fuse(erp, link, web)
    assert out.columns == fuse.FUSION_ERP_COLUMNS + fuse.FUSION_WEB_COLUMNS
    rows = out.collect()
    assert len(rows) == 1 and rows[0]["product_id"] == 1 and rows[0]["post_title"] == "T"


def test_revenue_and_total(spark):
    fused = spark.createDataFrame(
        [(1, "a", 1.005, 1, "instock"), (2, "b", 2.0, 0, "instock"), (3, "c", 3.0, 2, "outofstock"),
         (4, "d", 10.0, 3, "instock")],
        "product_id long, post_title string, price double, stock_quantity long, stock_status string",
    )
    rev = metrics.revenue_per_product(fused)
    got = {r["product_id"]: r["chiffre_affaires"] for r in rev.collect()}
    assert got == {1: 1.0, 4: 30.0}
    assert metrics.revenue_total(rev).first()["ca_total"] == 31.0
    assert metrics.revenue_total(rev.filter("false")).first()["ca_total"] is None


def test_zscore_basic_and_sample_std(spark):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate([1, 2, 3, 4, 100])], "id long, price double")
    out = {r["id"]: r for r in metrics.zscore_classify(df, "price").collect()}
    import statistics

    vals = [1, 2, 3, 4, 100]
    m, sd = statistics.mean(vals), statistics.stdev(vals)
    assert out[4]["z_score"] == pytest.approx((100 - m) / sd)
    assert [out[i]["type"] for i in range(5)] == [metrics.ORDINARY_LABEL] * 4 + [metrics.ORDINARY_LABEL]
    # z of 100 is ~1.79 with the sample sd: still ordinary. A bigger set makes it an outlier.
    df2 = spark.createDataFrame([(i, float(v)) for i, v in enumerate([1] * 20 + [100])], "id long, price double")
    labels = metrics.label_counts(metrics.zscore_classify(df2, "price")).collect()
    assert {r["type"]: r["n"] for r in labels} == {metrics.ORDINARY_LABEL: 20, metrics.OUTLIER_LABEL: 1}


@pytest.mark.parametrize("values", [[5.0], [5.0, 5.0]])
def test_zscore_no_spread_gives_null_and_ordinary(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, price double")
    rows = metrics.zscore_classify(df, "price").collect()
    assert all(r["z_score"] is None for r in rows)
    assert all(r["type"] == metrics.ORDINARY_LABEL for r in rows)


def test_zscore_nan_is_skipped_and_ordinary(spark):
    df = spark.createDataFrame([(1, 1.0), (2, float("nan")), (3, 3.0), (4, None)], "id long, price double")
    rows = {r["id"]: r for r in metrics.zscore_classify(df, "price").collect()}
    assert set(rows) == {1, 2, 3}  # NULL price dropped
    assert rows[2]["z_score"] is None and rows[2]["type"] == metrics.ORDINARY_LABEL
    # statistics skip the NaN: mean 2, sd sqrt(2)
    assert rows[1]["z_score"] == pytest.approx(-1 / 2 ** 0.5)


def test_zscore_infinite_value_is_not_an_outlier(spark):
    df = spark.createDataFrame([(1, 1.0), (2, float("inf")), (3, 3.0)], "id long, price double")
    rows = metrics.zscore_classify(df, "price").collect()
    # mean is inf and sd NaN: every z is undefined (NULL), every row ordinary
    assert all(r["z_score"] is None for r in rows)
    assert all(r["type"] == metrics.ORDINARY_LABEL for r in rows)


def test_latest_per_key_all_columns_tie_break_is_deterministic(spark):
    df = spark.createDataFrame(
        [("a", 1, "x", 1.0), ("a", 1, "y", 0.5), ("a", 1, "y", 2.0), ("b", None, "z", 1.0)],
        "sku string, t long, title string, r double",
    )
    for parts in (1, 3, 4):
        out = dedup.latest_per_key(df.repartition(parts), "sku", "t", tie_breakers="all")
        got = {r["sku"]: (r["title"], r["r"]) for r in out.collect()}
        assert got == {"a": ("y", 2.0), "b": ("z", 1.0)}


def test_numeric_min_link_equals_the_plain_rule(spark):
    """Whole numbers, other spellings, words, NULL targets and the NULL key, against a loop over the rows."""
    from decimal import Decimal, InvalidOperation

    targets = ["99", "099", "100", " 7 ", "7", "-3", "+3", "3.0", "2.5", "x1", "x0", "", "9" * 19, "9" * 25, "-0", "0", None]
    rows = [(k % 23 if k % 23 else None, targets[(k * k + k // 7) % len(targets)]) for k in range(400)] + [(100, None), (101, "b"), (101, "a"), (102, "b"), (102, "0050"), (102, "50")]

    def rank(t):
        try:
            return (0, Decimal(t.strip()), t)
        except InvalidOperation:
            return (1, Decimal(0), t)

    want = {}
    for k, t in rows:
        if t is not None:
            want[k] = min(want.get(k, t), t, key=rank) if want.get(k) is not None else t
        else:
            want.setdefault(k, None)
    df = spark.createDataFrame(rows, "k long, t string").repartition(3)
    got = dedup.min_link(df, "k", "t", "numeric")
    assert {r.k: r.t for r in got.collect()} == want and got.columns == ["k", "t"]
    typed = dedup.min_link(df.selectExpr("k", "try_cast(t AS bigint) AS t"), "k", "t", "numeric")
    assert typed.schema["t"].dataType.simpleString() == "bigint"


def test_numeric_min_link_hashes_whole_numbers(spark):
    df = spark.createDataFrame([(1, "2")], "k long, t string")
    plan = dedup.min_link(df, "k", "t", "numeric")._jdf.queryExecution().sparkPlan().toString()
    left = plan.split("SortAggregate")[0]
    assert "HashAggregate" in left and "min(" in left
