"""The staged batch run end to end on the small test tables and on CSV drops."""

import os

import pytest

from ledgerline.operators.quality import DataQualityError
from ledgerline.plans import batch
from ledgerline.plans.chain import TEST_TABLE_RULES, Rules
from ledgerline.session import scratch_path
from ledgerline.sources import tables as T
from tests.conftest import SF_SMALL


def test_batch_on_test_tables(spark):
    out = scratch_path(spark, "batch")
    ev = T.table(spark, SF_SMALL, "events")
    res = batch.run_batch(
        spark,
        batch.test_table_sources(spark, SF_SMALL),
        out,
        expected={"fused": 334, "revenue_rows": 291, "outliers": 50},
        rules=TEST_TABLE_RULES,
        zscore_source=(ev, "value", ["event_id", "user_id", "value"]),
        land_sources=False,
    )
    assert "erp_raw" not in res.stages and "erp_clean" not in res.stages
    assert spark.read.parquet(res.snapshot["erp_clean"]).count() == 5710
    checks = res.checks.collect()
    assert checks and all(r["passed"] is not False for r in checks)
    assert {r["table_name"]: r["passed"] for r in checks if r["rule"] in ("row_count", "amount")} == {
        "fusion": True, "ca_par_produit": True, "outliers": True, "ca_total": None}
    for name, path in res.published.items():
        assert spark.read.options(header=True).csv(path).count() > 0, name
    assert {"erp_clean", "web_clean", "liaison_clean"} <= set(res.published)
    rep = {r["step_no"]: r for r in res.report.collect()}
    assert len(rep) == 13
    assert rep[10]["resultat"] == 334.0 and rep[10]["passed"]
    assert rep[13]["resultat"] == 50.0
    assert spark.read.parquet(res.snapshot["fusion"]).count() == 334
    # the two label sets were written in one pass, partitioned by label
    assert {r["type"] for r in spark.read.parquet(res.stages["zscore"]).select("type").distinct().collect()} == {
        "millésimé", "ordinaire"}


def test_batch_stops_before_publishing_on_failed_rule(spark):
    out = scratch_path(spark, "batch-fail")
    with pytest.raises(DataQualityError):
        batch.run_batch(
            spark, batch.test_table_sources(spark, SF_SMALL), out, expected={"fused": 1}, rules=TEST_TABLE_RULES
        )
    local = out[len("file:"):] if out.startswith("file:") else out
    assert not os.path.exists(os.path.join(local, "published"))
    assert not os.path.exists(os.path.join(local, "stages", "ca_par_produit"))  # it stopped at the fusion


def test_failed_cleaning_rule_leaves_no_dedup_stage(spark):
    out = scratch_path(spark, "batch-clean-fail")
    sources = batch.test_table_sources(spark, SF_SMALL)
    sources["web"] = sources["web"].filter("sku is null")
    with pytest.raises(DataQualityError, match="web_clean"):
        batch.run_batch(spark, sources, out, rules=TEST_TABLE_RULES, land_sources=False)
    local = out[len("file:"):] if out.startswith("file:") else out
    assert os.path.exists(os.path.join(local, "checks", "stage=clean"))
    assert not os.path.exists(os.path.join(local, "stages", "erp_dedup"))


CSV = {
    "erp": "product_id,onsale_web,price,stock_quantity,stock_status\n"
    "1,1,10.0,2,instock\n1,0,12.5,1,outofstock\n2,1,1.005,1,instock\n3,1,0,4,instock\n,1,5,5,instock\n"
    "4,1,7.0,3,instock\n",
    "web": "sku,post_type,post_date,post_title,post_excerpt,post_status,average_rating,total_sales\n"
    '2.0,product,2020-01-02 10:00:00,"Vin ""B""","multi\nline",publish,4,1\n'
    "2,product,2019-01-01 00:00:00,old,,publish,1,1\n"
    "4,product,2020-05-05 00:00:00,D,,publish,3,2\n"
    "4,attachment,2021-01-01 00:00:00,pic,,inherit,,\n"
    "1,product,2020-02-02 00:00:00,A,,publish,5,9\n",
    "liaison": "product_id,id_web\n1,1\n2,2\n2,10\n4,4.0\n5,\n",
}


def _drop(spark, csv):
    root = scratch_path(spark, "csv-in")
    local = root[len("file:"):] if root.startswith("file:") else root
    for name, text in csv.items():
        os.makedirs(os.path.join(local, f"{name}.csv"), exist_ok=True)
        with open(os.path.join(local, f"{name}.csv", "part.csv"), "w") as fh:
            fh.write(text)
    return root


def test_empty_rows_and_columns_go_at_landing(spark):
    lines = CSV["erp"].splitlines()
    csv = dict(CSV, erp="\n".join([lines[0] + ",note", *(line + "," for line in lines[1:]), ",,,,,"]) + "\n")
    res = batch.run_batch(spark, batch.land_csv_sources(spark, _drop(spark, csv)), scratch_path(spark, "csv-out"), rules=Rules())
    assert "note" not in spark.read.parquet(res.snapshot["erp_clean"]).columns
    empty = dict(CSV, liaison="product_id,id_web\n,\n")
    with pytest.raises(DataQualityError, match="liaison_raw.non_empty"):
        batch.run_batch(spark, batch.land_csv_sources(spark, _drop(spark, empty)), scratch_path(spark, "csv-out"), rules=Rules())


def test_batch_on_csv_drops(spark):
    root = _drop(spark, CSV)
    sources = batch.land_csv_sources(spark, root)
    res = batch.run_batch(spark, sources, scratch_path(spark, "csv-out"), rules=Rules(link_ordering="text"))
    fused = {r["product_id"]: r for r in spark.read.parquet(res.stages["fusion"]).collect()}
    # product 1: MAX per column mixes rows -> status 'outofstock' (no revenue)
    assert fused[1]["stock_status"] == "outofstock" and fused[1]["price"] == 12.5
    # product 2: link MIN('10','2') as text is '10' -> no web post '10' -> dropped
    assert 2 not in fused
    # product 4: key '4.0' normalised to '4', newest 'product' post wins
    assert fused[4]["post_title"] == "D"
    rev = {r["product_id"]: r["chiffre_affaires"] for r in spark.read.parquet(res.stages["ca_par_produit"]).collect()}
    assert rev == {4: 21.0}
    summary = {r["source"]: r for r in spark.read.options(header=True).csv(res.published["resume_stats"]).collect()}
    assert summary["erp"]["nb_exclues"] == "2"
