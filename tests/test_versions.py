"""Tables replaced as a whole, and frozen copies that are checked."""

import pytest
from pyspark.sql import functions as F

from ledgerline.session import scratch_path
from ledgerline.sources import snapshots, versions


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "n long")


def test_a_reader_stays_on_its_version_and_the_table_may_read_itself(spark):
    root = scratch_path(spark, "versions")
    versions.replace(numbers(spark, 1, 2, 3), root)
    before = versions.read(spark, root)
    versions.replace(before.withColumn("n", F.col("n") * 10), root)
    after = versions.read(spark, root)
    versions.replace(after.filter("n > 10"), root)
    assert rows(before) == [(1,), (2,), (3,)] and rows(after) == [(10,), (20,), (30,)]
    assert rows(versions.read(spark, root)) == [(20,), (30,)]
    assert rows(versions.read(spark, root, version=1)) == [(1,), (2,), (3,)]
    assert [n for n, _ in versions.history(spark, root)] == [1, 2, 3]


def test_a_run_that_dies_between_data_and_commit_leaves_the_old_table(spark, monkeypatch):
    root = scratch_path(spark, "versions-killed")
    versions.replace(numbers(spark, 1), root)
    with monkeypatch.context() as patch:
        patch.setattr(versions, "commit", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            versions.replace(numbers(spark, 2), root)
    assert rows(versions.read(spark, root)) == [(1,)]
    versions.replace(numbers(spark, 3), root)
    assert rows(versions.read(spark, root)) == [(3,)]
    assert len(versions.vacuum(spark, root, keep=1)) == 2  # the orphan and the first version
    assert rows(versions.read(spark, root)) == [(3,)]


def test_a_failing_job_leaves_the_old_table(spark):
    root = scratch_path(spark, "versions-failed")
    versions.replace(numbers(spark, 1), root)
    with pytest.raises(Exception, match="odd row"):
        versions.replace(numbers(spark, 1, 2).select(F.when(F.col("n") == 2, F.raise_error(F.lit("odd row")).cast("long")).otherwise(F.col("n")).alias("n")), root)
    assert rows(versions.read(spark, root)) == [(1,)]


def test_of_two_writers_the_second_to_finish_is_refused(spark):
    root = scratch_path(spark, "versions-conflict")
    versions.replace(numbers(spark, 1), root)
    seen = versions.history(spark, root)[-1][0]
    versions.replace(numbers(spark, 2), root, expect=seen)
    with pytest.raises(versions.CommitConflict):
        versions.replace(numbers(spark, 3), root, expect=seen)
    assert rows(versions.read(spark, root)) == [(2,)]


def test_an_unfinished_commit_file_is_skipped(spark):
    root = scratch_path(spark, "versions-torn")
    path = versions.replace(numbers(spark, 1), root)
    where, store = versions._folder(spark, f"{root}/{versions.COMMITS}/000000000002")
    store.create(where, False).close()  # its writer died before the name was written
    assert versions.current_path(spark, root) == path
    versions.replace(numbers(spark, 5), root)
    assert rows(versions.read(spark, root)) == [(5,)] and versions.history(spark, root)[-1][0] == 3


def test_a_table_without_a_version(spark):
    with pytest.raises(versions.NoSuchVersion):
        versions.read(spark, scratch_path(spark, "versions-none"))
    root = scratch_path(spark, "versions-empty")
    versions.replace(numbers(spark), root)
    assert versions.read(spark, root).count() == 0


def test_other_layouts(spark):
    root = scratch_path(spark, "versions-split")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "n long, label string")
    versions.replace(df, root, lambda writer, path: writer.partitionBy("label").parquet(path))
    assert rows(versions.read(spark, root).select("n", "label")) == [(1, "a"), (2, "b")]


TABLE = [(1, "a", 0.5), (2, None, None), (2, None, None), (3, "", float("nan"))]


def frame(spark, data=TABLE, n=3):
    return spark.createDataFrame(data, "id long, name string, x double").repartition(n)


def test_digest_ignores_order_and_partitioning_but_sees_every_change(spark):
    whole = rows(snapshots.digest(frame(spark)))
    assert whole == rows(snapshots.digest(frame(spark, TABLE[::-1], 1)))
    changed = [
        TABLE[:-1],  # dropped
        [*TABLE, TABLE[0]],  # doubled
        [(1, "b", 0.5), *TABLE[1:]],  # altered
        [*TABLE[:3], (3, None, float("nan"))],  # empty text to null
        [(1, "a", 0.5), (2, None, None), (2, None, None), (3, "", None)],
    ]
    assert all(rows(snapshots.digest(frame(spark, c))) != whole for c in changed)
    swapped = frame(spark).select("id", F.col("name").alias("x"), F.col("x").alias("name"))
    assert rows(snapshots.digest(swapped)) != whole
    assert rows(snapshots.digest(frame(spark, []))) == [(0, "0:0")]


def test_a_snapshot_that_was_touched_is_not_read(spark):
    root = scratch_path(spark, "frozen")
    paths = snapshots.freeze({"t": frame(spark), "empty": frame(spark, [])}, root)
    found = snapshots.read_verified(spark, root)
    assert set(found) == {"t", "empty"} and found["t"].count() == 4
    frame(spark, TABLE[:1]).write.mode("append").parquet(paths["t"])
    assert {r.table_name: r.intact for r in snapshots.verify(spark, root).collect()} == {"t": False, "empty": True}
    with pytest.raises(snapshots.SnapshotError, match="t$"):
        snapshots.read_verified(spark, root)
    snapshots.freeze({"t": frame(spark, TABLE[:2])}, root)  # a new snapshot takes its place whole
    assert snapshots.read_verified(spark, root)["t"].count() == 2
