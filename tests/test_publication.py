"""One published CSV set: whole or absent, checked when read."""

import glob

import pytest
from pyspark.sql import functions as F

from ledgerline.sources import publication, versions


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "out")


ROWS = [(1, "plain", 1.5), (2, 'quote " and, comma', None), (3, "two\nlines", 2.25), (4, None, -0.5), (5, "", 3.0), (6, " blanks ", 4.0), (7, "é\r\nß", 5.0)]
KINDS = "id long, name string, price double"


def _rows(df):
    return sorted(map(tuple, df.collect()))


def _concatenated(path, spark):
    names = [r.part for r in spark.read.parquet(f"{path}/manifest").orderBy("part_no").collect()]
    files = glob.glob(f"{path}/header/part-*") + [f"{path}/parts/{n}" for n in names]
    return b"".join(open(f, "rb").read() for f in files).decode()


def test_round_trip_and_one_file(spark, root):
    df = spark.createDataFrame(ROWS, KINDS).repartition(4)
    path = publication.publish(df, root, order_by=["id"], part_rows=2)
    back = publication.read(spark, root)
    assert back.schema == df.schema and _rows(back) == sorted(ROWS)
    assert publication.manifest(spark, root).count() >= 4
    text = _concatenated(path, spark)
    assert text.startswith("id,name,price\n1,plain,1.5\n") and text.count("id,name,price") == 1
    order = [line.split(",")[0] for line in text.replace("two\nlines", "").replace("é\r\nß", "").splitlines()[1:]]
    assert order == ["1", "2", "3", "4", "5", "6", "7"]


def test_empty_table(spark, root):
    df = spark.createDataFrame([], KINDS)
    publication.publish(df, root)
    assert publication.read(spark, root).schema == df.schema and publication.read(spark, root).count() == 0


def test_a_failed_write_leaves_the_publication_before(spark, root):
    df = spark.createDataFrame(ROWS, KINDS)
    with pytest.raises(versions.NoSuchVersion):
        publication.read(spark, root)
    publication.publish(df, root)
    broken = spark.range(0, 1000, 1, 4).withColumn("id", F.when(F.col("id") == 900, F.raise_error(F.lit("lost"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="lost"):
        publication.publish(broken, root)
    assert _rows(publication.read(spark, root)) == sorted(ROWS)


def test_a_run_killed_before_its_commit_is_not_seen(spark, root, monkeypatch):
    df = spark.createDataFrame(ROWS, KINDS)
    publication.publish(df, root)
    monkeypatch.setattr(versions, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError, match="killed"):
        publication.publish(df.limit(1), root)
    monkeypatch.undo()
    assert _rows(publication.read(spark, root)) == sorted(ROWS)
    publication.publish(df.filter("id > 5"), root)
    assert [r[0] for r in _rows(publication.read(spark, root))] == [6, 7]


def test_damage_is_found(spark, root):
    df = spark.createDataFrame(ROWS, KINDS)
    path = publication.publish(df, root, order_by=["id"], part_rows=2)
    first = sorted(glob.glob(f"{path}/parts/part-*"))[0]
    whole = open(first, "rb").read()
    for damaged in (whole.replace(b"plain", b"plaix"), whole + whole, b""):
        open(first, "wb").write(damaged)
        for crc in glob.glob(f"{path}/parts/.*.crc"):
            open(crc, "ab").close()
        spark.catalog.clearCache()
        with pytest.raises(Exception, match="part-|Checksum"):
            publication.read(spark, root).collect()


def test_a_file_that_is_not_in_the_manifest_is_found(spark, root):
    path = publication.publish(spark.createDataFrame(ROWS, KINDS), root)
    open(f"{path}/parts/part-extra.csv", "w").write("8,late,1.0\n")
    with pytest.raises(publication.DamagedPublication, match="part-extra"):
        publication.read(spark, root)
    assert _rows(publication.read(spark, root, checked=False)) == sorted(ROWS)
