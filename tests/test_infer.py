"""Types of dropped CSV files, against hand-made values and against another engine's full scan."""

import glob

import duckdb
import pytest
from pyspark.sql import functions as F

from ledgerline.session import scratch_path
from ledgerline.sources import infer, schemas
from tests.conftest import SF_SMALL


def kinds(spark, columns, decimals=False, **options):
    names = list(columns)
    length = max(len(v) for v in columns.values())
    data = [tuple(columns[n][i] if i < len(columns[n]) else None for n in names) for i in range(length)]
    raw = spark.createDataFrame(data, ", ".join(f"`{n}` string" for n in names)).repartition(3)
    return infer.infer(raw, decimals=decimals, **options).types


def test_narrowest_type_that_holds_every_value(spark):
    got = kinds(spark, {
        "flag": ["true", "FALSE", None, " "], "whole": ["1", "-2", " +3 ", "007"], "large": ["9223372036854775807", "9223372036854775808"],
        "point": ["1", "2.50", ".5", "3."], "power": ["1e5", "2"], "special": ["NaN", "1.5", "-inf"], "day": ["2024-02-29", None],
        "moment": ["2024-02-29", "2024-01-01 10:00", "2024-01-01T10:00:00.123456"], "no day": ["2024-02-30"], "mixed": ["true", "1"],
        "late": ["1"] * 50 + ["x"], "blank": ["", " ", None], "code": ["1d", "2f"], "word": ["nan1", "info"], "dot": ["."],
    })
    assert got == {
        "flag": "boolean", "whole": "bigint", "large": "double", "point": "double", "power": "double", "special": "double", "day": "date",
        "moment": "timestamp_ntz", "no day": "string", "mixed": "string", "late": "string", "blank": "string", "code": "string", "word": "string", "dot": "string",
    }


def test_exact_decimals_on_request(spark):
    got = kinds(spark, {"a": ["1.50", "-200.125"], "b": ["9" * 25], "c": ["1" * 30 + "." + "1" * 12], "d": ["1.5", "1e3"], "e": ["12"]}, decimals=True)
    assert got == {"a": "decimal(6,3)", "b": "decimal(25,0)", "c": "double", "d": "double", "e": "bigint"}


def test_columns_kept_as_text_and_clashing_names(spark):
    assert kinds(spark, {"sku": ["007"], "types_0": ["1"], "text_1": ["x"], "a b": ["2"]}, keep_text=["sku"]) == {"sku": "string", "types_0": "bigint", "text_1": "string", "a b": "bigint"}


def drop(spark, df, **options):
    path = scratch_path(spark, "drop")
    df.write.options(header=True, escape='"', quote='"', **options).csv(path)
    return path


@pytest.mark.parametrize("table", ["lineitem", "events", "documents", "customer", "labels"])
def test_same_types_and_values_as_a_full_scan_elsewhere(spark, table):
    path = drop(spark, spark.read.parquet(f"{SF_SMALL}/{table}.parquet"), timestampNTZFormat="yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    landed, found = infer.land_inferred(spark, path, scratch_path(spark, "landed"))
    scan = duckdb.sql(f"SELECT * FROM read_csv_auto({glob.glob(path.removeprefix('file:') + '/*.csv')}, sample_size = -1, header = true, quote = '\"', escape = '\"')")
    same = {"BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "TIMESTAMP": "timestamp_ntz", "DATE": "date", "BOOLEAN": "boolean"}
    assert found.types == {c: same[str(t)] for c, t in zip(scan.columns, scan.types, strict=True)}
    assert landed.count() == len(scan)
    number = [c for c, t in found.types.items() if t in ("bigint", "double")]
    assert [round(x, 6) for x in landed.agg(*[F.sum(c).cast("double") for c in number]).first()] == [round(float(x), 6) for x in scan.aggregate(", ".join(f"sum({c})" for c in number)).limit(1).fetchall()[0]]


def test_delimiters_quotes_and_line_breaks(spark):
    data = [(1, 'a;b,"c"\nd|e', "x", 1.5), (2, None, None, None), (3, None, " pad ", -2.0)]
    df = spark.createDataFrame(data, "id long, text string, other string, x double")
    for sep in infer.DELIMITERS:
        path = drop(spark, df.coalesce(1), sep=sep, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        landed, found = infer.land_inferred(spark, path, scratch_path(spark, "landed"))
        assert found.delimiter == sep and list(found.types.values()) == ["bigint", "string", "string", "double"]
        assert sorted(tuple(r) for r in landed.collect()) == data


def test_no_rows_one_column_and_repeated_names(spark):
    empty = drop(spark, spark.createDataFrame([], "a long, b string").coalesce(1))
    landed, found = infer.land_inferred(spark, empty, scratch_path(spark, "landed"))
    assert landed.count() == 0 and found.types == {"a": "string", "b": "string"}
    one = drop(spark, spark.createDataFrame([(1,), (2,)], "a long").coalesce(1))
    assert infer.land_inferred(spark, one, scratch_path(spark, "landed"))[1].types == {"a": "bigint"}
    twice = scratch_path(spark, "drop")
    spark.createDataFrame([("a,A",), ("1,2",)], "v string").coalesce(1).write.text(twice)
    with pytest.raises(schemas.LandingError):
        infer.read_text(spark, twice)


def test_files_are_parsed_once(spark):
    """The types come with the write: the only plan that scans CSV rows is the one that lands them."""
    path = drop(spark, spark.createDataFrame([(i, "t") for i in range(100)], "a long, b string").repartition(4))
    raw = infer.read_text(spark, path)
    from pyspark.sql import Observation

    seen = Observation()
    raw = infer._with_texts(raw).observe(seen, *infer.folds(2))
    raw.write.format("noop").mode("overwrite").save()
    assert seen.get == {"types_0": infer.LONG | infer.DECIMAL | infer.DOUBLE, "types_1": 0}
