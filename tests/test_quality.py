"""Quality rules: one pass per table, pass and fail cases, failure raising."""

import pytest

from ledgerline.operators import quality as Q


def _by_rule(df):
    return {(r["rule"], r["subject"]): r for r in df.collect()}


def test_rules_pass(spark):
    df = spark.createDataFrame([(1, 2.0), (2, 3.5)], "k long, amount double")
    res = Q.evaluate(
        df,
        "t",
        [Q.non_empty(), Q.not_null(["k", "amount"]), Q.unique("k"), Q.row_count(2), Q.amount_equals("amount", 5.5),
         Q.non_negative("amount"), Q.no_missing(["amount"]), Q.no_infinite(["amount"])],
    )
    rows = res.collect()
    assert len(rows) == 8 and all(r["passed"] for r in rows)
    Q.raise_on_failure(res)


def test_rules_fail(spark):
    df = spark.createDataFrame(
        [(1, -2.0), (None, float("nan")), (1, float("inf"))], "k long, amount double"
    )
    res = Q.evaluate(
        df,
        "t",
        [Q.not_null(["k"]), Q.unique("k"), Q.row_count(2), Q.non_negative("amount"), Q.no_missing(["amount"]),
         Q.no_infinite(["amount"])],
    )
    got = _by_rule(res)
    # duplicates: 3 rows - 1 distinct non-NULL key = 2 (NULL keys count as duplicates)
    assert got[("unique", "k")]["actual"] == 2.0
    assert got[("not_null", "k")]["actual"] == 1.0
    assert got[("row_count", "*")]["actual"] == 3.0
    assert got[("non_negative", "amount")]["actual"] == 1.0
    assert got[("no_missing", "amount")]["actual"] == 1.0
    assert got[("no_infinite", "amount")]["actual"] == 1.0
    assert not any(r["passed"] for r in got.values())
    with pytest.raises(Q.DataQualityError):
        Q.raise_on_failure(res)


def test_empty_table_and_empty_amount(spark):
    df = spark.createDataFrame([], "k long, amount double")
    got = _by_rule(Q.evaluate(df, "t", [Q.non_empty(), Q.amount_equals("amount", 1.0)]))
    assert got[("non_empty", "*")]["passed"] is False
    assert got[("amount", "amount")]["actual"] is None
    assert got[("amount", "amount")]["passed"] is False


def test_unexpected_row_count_is_neither_passed_nor_failed(spark):
    df = spark.createDataFrame([(1,)], "k long")
    r = Q.evaluate(df, "t", [Q.row_count(None)]).first()
    assert r["actual"] == 1.0 and r["expected"] == "" and r["passed"] is None


def test_compare_with_a_second_route(spark):
    df = spark.createDataFrame([(1, 2.5), (2, 3.0)], "k long, amount double")
    res = Q.union_results([Q.evaluate(df, "t", [Q.row_count(None), Q.amount_equals("amount", None), Q.non_empty()]), Q.evaluate(df, "u", [Q.row_count(None)])])
    wanted = spark.createDataFrame([("row_count", "t", 0, 2.0), ("amount", "t", 2, 5.51)], "rule string, table_name string, places int, value double")
    got = {(r["rule"], r["table_name"]): (r["expected"], r["passed"]) for r in Q.compare(res, wanted).collect()}
    assert got == {("row_count", "t"): ("= 2", True), ("amount", "t"): ("= 5.51", False), ("non_empty", "t"): ("> 0", True), ("row_count", "u"): ("", None)}


def test_columns_present(spark):
    df = spark.createDataFrame([(1, 2.0)], "product_id long, price double")
    got = {r["subject"]: r["passed"] for r in Q.columns_present(spark, df, "fused", ["product_id", "post_title"]).collect()}
    assert got == {"product_id": True, "post_title": False}


def test_one_aggregate_per_table(spark):
    df = spark.range(100).withColumnRenamed("id", "k")
    res = Q.evaluate(df, "t", [Q.non_empty(), Q.unique("k"), Q.not_null(["k"])])
    plan = res._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") + plan.count("Range") <= 2  # one source scan (Range) for all rules


def test_two_distinct_rules_do_not_expand(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 2)], "a long, b long")
    res = Q.evaluate(df, "t", [Q.unique("a"), Q.non_empty(), Q.unique("b")])
    got = [(r["subject"], r["actual"]) for r in res.collect()]
    assert sorted(got) == [("*", 3.0), ("a", 1.0), ("b", 1.0)]
    plan = res._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan


def test_assert_passed_in_plan(spark):
    ok = Q.evaluate(spark.createDataFrame([(1,)], "k long"), "t", [Q.non_empty()])
    assert Q.assert_passed(ok).count() == 1
    bad = Q.evaluate(spark.createDataFrame([(1,), (1,)], "k long"), "t", [Q.unique("k")])
    with pytest.raises(Exception, match="t.unique"):
        Q.assert_passed(bad).collect()
