"""CSV dialect, Parquet stages, snapshots, listings."""

import os

import pytest

from ledgerline.session import scratch_path
from ledgerline.sources import files
from ledgerline.sources.schemas import ERP_SCHEMA, LINK_SCHEMA, WEB_SCHEMA, LandingError, land, normalize_keys, uncastable

CSV_TEXT = (
    "sku,post_type,post_date,post_title,post_excerpt,post_status,average_rating,total_sales\n"
    '15298.0,product,2020-01-02 10:00:00,"Vin ""rouge""","line one\nline two",publish,4.5,3\n'
    "\n"
    ",,,,,,,\n"
    "NA,product,2020-01-03 10:00:00,t,e,publish,1,1\n"
)


def _write_text(spark, name, text):
    root = scratch_path(spark, name)
    local = root[len("file:"):] if root.startswith("file:") else root
    os.makedirs(local, exist_ok=True)
    with open(os.path.join(local, "part.csv"), "w", encoding="utf-8") as fh:
        fh.write(text)
    return root


def test_csv_dialect(spark):
    path = _write_text(spark, "csv-dialect", CSV_TEXT)
    df = normalize_keys(files.read_csv(spark, path, WEB_SCHEMA), "web")
    rows = df.collect()
    # blank line skipped; ',,,' kept as an all-NULL row; 'NA' is text, not NULL.
    assert len(rows) == 3
    first = rows[0]
    assert first["sku"] == "15298"
    assert first["post_title"] == 'Vin "rouge"'
    assert first["post_excerpt"] == "line one\nline two"
    assert all(v is None for v in rows[1])
    assert rows[2]["sku"] == "NA"


def test_csv_roundtrip_keeps_text(spark):
    df = spark.createDataFrame(
        [(1, 'say "hi"\nbye', "x,y")], "product_id long, a string, b string"
    )
    path = scratch_path(spark, "csv-rt")
    files.write_csv(df, path)
    back = files.read_csv(spark, path, "product_id long, a string, b string").collect()
    assert back == df.collect()


def test_parquet_snapshot_copy(spark):
    df = spark.range(10).withColumnRenamed("id", "product_id")
    src = scratch_path(spark, "stage")
    files.write_parquet(df, src + "/erp_dedup")
    snap = files.copy_datasets(spark, {"erp_dedup": src + "/erp_dedup"}, scratch_path(spark, "snap"))
    assert spark.read.parquet(snap["erp_dedup"]).count() == 10


def test_listing_reads_no_content(spark):
    listing = files.list_files(spark, "/root/testdata/sf0.001", pattern="*.parquet")
    plan = listing._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema:")[1].split("\n")[0]
    names = {r["name"] for r in listing.collect()}
    assert {"lineitem.parquet", "orders.parquet", "customer.parquet"} <= names
    missing = files.manifest_missing(listing, files.expected_manifest(spark, ["lineitem.parquet", "nope.csv"]))
    assert [r["name"] for r in missing.collect()] == ["nope.csv"]


def test_schemas_declared():
    assert [f.name for f in ERP_SCHEMA] == ["product_id", "onsale_web", "price", "stock_quantity", "stock_status"]
    assert [f.name for f in LINK_SCHEMA] == ["product_id", "id_web"]
    assert WEB_SCHEMA["sku"].dataType.simpleString() == "string"


def test_declared_test_table_schemas_match_files(spark):
    from ledgerline.sources import tables as T

    for sf in ["/root/testdata/sf0.001", "/root/testdata/sf0.01", "/root/testdata/sf0.1"]:
        for name in T.TEST_TABLE_SCHEMAS:
            inferred = spark.read.parquet(f"{sf}/{name}.parquet").schema
            declared = T.table(spark, sf, name).schema
            assert [(f.name, f.dataType) for f in inferred] == [(f.name, f.dataType) for f in declared], (sf, name)


def test_columns_are_matched_by_header_name(spark):
    path = _write_text(spark, "csv-names", "note,id_web,product_id\nkeep me,15298.0,7.0\n,x,8\n")
    rows = land(files.read_csv_text(spark, path), "liaison").collect()
    assert [r.asDict() for r in rows] == [{"product_id": 7, "id_web": "15298", "note": "keep me"}, {"product_id": 8, "id_web": "x", "note": None}]


def test_missing_required_column_is_an_error(spark):
    path = _write_text(spark, "csv-missing", "product_id,other\n1,2\n")
    with pytest.raises(LandingError, match="id_web"):
        land(files.read_csv_text(spark, path), "liaison")


def test_value_that_does_not_cast_fails_the_run(spark):
    text = "product_id,onsale_web,price,stock_quantity,stock_status\n1,1,9.5,3.0,instock\n2,1,cheap,,instock\n"
    raw = files.read_csv_text(spark, _write_text(spark, "csv-bad", text))
    with pytest.raises(Exception, match="erp.price is not double: cheap"):
        land(raw, "erp").collect()
    assert uncastable(raw, "erp").first().asDict() == {"product_id": 0, "onsale_web": 0, "price": 1, "stock_quantity": 0}
    assert [r["price"] for r in land(raw, "erp", strict=False).collect()] == [9.5, None]


def test_other_column_order_in_a_later_file_is_an_error(spark):
    path = _write_text(spark, "csv-order", "product_id,id_web\n1,2\n")
    local = path[len("file:"):] if path.startswith("file:") else path
    with open(os.path.join(local, "part2.csv"), "w") as fh:
        fh.write("id_web,product_id\n2,1\n")
    with pytest.raises(Exception):
        land(files.read_csv_text(spark, path), "liaison").collect()


def test_scratch_needs_a_shared_folder_on_a_cluster(monkeypatch):
    from types import SimpleNamespace

    from ledgerline import session

    context = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    cluster = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default=None: default))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_path(cluster, "x")


def test_clear_scratch(spark):
    from ledgerline.session import clear_scratch

    path = scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    clear_scratch(spark)
    local = path[len("file:"):] if path.startswith("file:") else path
    assert not os.path.exists(local)

