"""Physical-plan shapes that matter at scale."""

import contextlib
import io
import re

import __spark_entry__ as E
from ledgerline.plans.chain import build_chain
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_clean_filters_reach_the_scan(spark):
    plan = _plan(build_chain(spark, SF_SMALL).erp_clean)
    pushed = plan.split("PushedFilters: [")[1].split("]")[0]
    for f in ["IsNotNull(l_orderkey)", "IsNotNull(l_extendedprice)", "IsNotNull(l_linestatus)",
              "GreaterThan(l_extendedprice,0.0)"]:
        assert f in pushed
    assert "Exchange" not in plan  # map-only


def test_projection_prunes_columns(spark):
    plan = _plan(E.queries()["dedup_link"](spark, SF_SMALL))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan


def test_latest_row_uses_partial_group_limit(spark):
    plan = _plan(E.queries()["latest_per_key"](spark, SF_SMALL))
    assert "WindowGroupLimit" in plan
    assert "Partial" in plan


def test_aggregates_are_partial_before_shuffle(spark):
    plan = _plan(E.queries()["dedup_max_per_key"](spark, SF_SMALL))
    assert "partial_max" in plan


def test_zscore_has_no_join_and_no_global_window(spark):
    df = E.queries()["zscore_classify"](spark, SF_SMALL)
    plan = _plan(df)
    assert "Join" not in plan
    assert "Window" not in plan
    main = plan.split("===== Subqueries =====")[0]
    assert "SinglePartition" not in main  # only the statistics subquery gathers (one row per task)


def test_fusion_reuses_the_dedup_partitioning(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(E.queries()["fusion"](spark, SF_SMALL))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # erp, link and web each shuffle once for their dedup; the first join reuses the
    # product_id partitioning of both aggregates, only the link target is re-shuffled.
    assert plan.count("Arguments: hashpartitioning") == 4
    assert "SortMergeJoin" in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_summary_scans_each_source_once(spark):
    df = E.queries()["clean_summary"](spark, SF_SMALL)
    plan = _plan(df)
    assert _scans(plan) == 4  # one per source; the link role with defects is two selections of orders


def _scans(plan) -> int:
    return len(re.findall(r"^\(\d+\) Scan parquet", plan, flags=re.M))


def test_rules_scan_each_source_once(spark):
    assert _scans(_plan(E.queries()["dq_non_empty"](spark, SF_SMALL))) == 3
    plan = _plan(E.queries()["dq_not_null"](spark, SF_SMALL))
    # three raw sources (the link role reads orders twice), and once more each for the fused table's rule
    assert _scans(plan) <= 8


def test_ascii_text_stays_out_of_python(spark):
    plan = _plan(E.queries()["safe_name_documents"](spark, SF_SMALL))
    assert "octet_length" in plan


def test_bucketed_stages_colocate_the_fusion(spark):
    from ledgerline.plans import chain as C
    from ledgerline.plans.batch import Stager
    from ledgerline.session import scratch_path

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ch = C.build_chain(spark, SF_SMALL)
        st = Stager(spark, scratch_path(spark, "bucketed"))
        fused, _, _ = C.figures_stage(*st.put_dedups(ch.erp_dedup, ch.web_dedup, ch.link_dedup))
        plan = _plan(fused)
        assert fused.count() == 334
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # the first join reads bucketed sides; the second shuffles both of its sides, so hot targets can be split
    assert plan.count("Arguments: hashpartitioning") == 2
    assert not [r for r in spark.sql("SHOW TABLES").collect() if r["tableName"].startswith("ledgerline_")]
    assert "SortMergeJoin" in plan


def test_csv_drops_are_parsed_once(spark):
    plan = _plan(E.queries()["csv_landing"](spark, SF_SMALL))
    assert "Scan parquet" in plan and "Scan csv" not in plan
