"""Every registered query of the reconciliation chain against its SQL text in DuckDB (small scale)."""

import os

import pytest

import __spark_entry__ as E
from ledgerline.plans.catalog import ORACLE_SQL, QUERIES
from tests.conftest import SF_SMALL
from tools.oracle_check import compare, duck_frame

NAMES = sorted(QUERIES)


def test_every_query_has_sql():
    assert set(ORACLE_SQL) == set(QUERIES)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE_SQL) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, name):
    sp = QUERIES[name](spark, SF_SMALL).toPandas()
    dk = duck_frame(ORACLE_SQL[name], SF_SMALL)
    res = compare(sp, dk)
    assert res["rows_ok"] and res["cols_ok"], res
    assert not res.get("kinds_diff"), res
    assert res["values_ok"], res


@pytest.mark.parametrize("name", ["dq_row_count", "dq_amount", "stage_report"])
def test_folder_name_decides_nothing(spark, name, tmp_path):
    other = tmp_path / "renamed"
    os.symlink(SF_SMALL, other)
    here, there = (QUERIES[name](spark, str(d)).collect() for d in (SF_SMALL, other))
    assert here == there
    assert any(r["passed"] in (True, "true") for r in there)


def test_rules_meet_rows_they_act_on(spark):
    """Queries over the roles with defects drop rows, and rules over raw data fail."""
    summary = {r["source"]: r["nb_exclues"] for r in QUERIES["clean_summary"](spark, SF_SMALL).collect()}
    assert all(n > 0 for n in summary.values())
    for name, n in (("dq_not_null", 3), ("dq_non_negative", 1), ("dq_finite", 2)):
        rows = QUERIES[name](spark, SF_SMALL).collect()
        assert sum(not r["passed"] for r in rows) == n and sum(r["passed"] for r in rows) > 0
    assert {r["type"] for r in QUERIES["zscore_fusion"](spark, SF_SMALL).select("type").distinct().collect()} == {"millésimé", "ordinaire"}


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["product_id", "post_title", "price", "stock_quantity", "chiffre_affaires"]
    assert df.count() == 291
