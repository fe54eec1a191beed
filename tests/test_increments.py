"""Deduplicated tables that absorb drops one after another."""

import os
import random

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import dedup
from ledgerline.operators.increments import IncrementalDedup
from ledgerline.session import scratch_path
from ledgerline.sources import versions
from ledgerline.streaming import dedup_new_files

ROWS = "k long, t string, x double, n long"
RULES = {
    "max": lambda df: dedup.max_per_key(df, "k", ["t", "x", "n"]),
    "link": lambda df: dedup.min_link(df, "k", "t", "numeric"),
    "text": lambda df: dedup.min_link(df, "k", "t", "text"),
    "latest": lambda df: dedup.latest_per_key(df, "k", "x", "all", where=F.col("n") > 2),
}


def _rows(seed, n, keys):
    r = random.Random(seed)
    return [
        (
            r.choice([None, *range(keys)]),
            r.choice([None, "", "7", "07", "10", "9", "abc", "Z"]),
            r.choice([None, float("nan"), 1.0, 2.5, -0.0]),
            r.choice([None, 1, 3, 3, 9]),
        )
        for _ in range(n)
    ]


def _key(rows):
    return sorted(map(str, rows))


@pytest.mark.parametrize("name", sorted(RULES))
def test_drops_equal_one_shot(spark, name):
    rule = RULES[name]
    drops = [_rows(i, n, keys) for i, (n, keys) in enumerate([(200, 60), (3, 2), (0, 1), (40, 90), (5, 5), (300, 20)])]
    table = IncrementalDedup(spark, scratch_path(spark, "increments"), rule)
    seen = []
    for drop in drops:
        table.absorb(spark.createDataFrame(drop, ROWS))
        seen += drop
        assert _key(table.read().collect()) == _key(rule(spark.createDataFrame(seen, ROWS)).collect())
    table.absorb(spark.createDataFrame(drops[0], ROWS))  # a repeated drop changes nothing
    assert _key(table.read().collect()) == _key(rule(spark.createDataFrame(seen, ROWS)).collect())


def test_small_drops_touch_changed_keys_only(spark):
    table = IncrementalDedup(spark, scratch_path(spark, "increments"), lambda df: df.groupBy("k").agg(F.max("v").alias("v")))
    table.absorb(spark.range(100_000).selectExpr("id k", "id v"))
    base = table.runs()[0]
    for i in range(12):
        assert table.absorb(spark.range(10).selectExpr(f"id * 7 + {i} k", f"{i} v")) == 10
        assert table.runs()[0] == base  # the large run is neither read nor written
    sizes = [n for _, n in table.runs()]
    assert len(sizes) <= 8 and all(b * 2 < a for a, b in zip(sizes, sizes[1:], strict=False))
    assert table.read().count() == 100_000
    before = len(table.runs())
    assert table.vacuum() and len(table.runs()) == before and table.read().count() == 100_000


def test_filters_come_before_the_rule(spark):
    table = IncrementalDedup(spark, scratch_path(spark, "increments"), RULES["max"], lambda df: df.filter("n is not null"))
    table.absorb(spark.createDataFrame([(1, "a", 1.0, None), (1, "b", 0.5, 1)], ROWS))
    assert [tuple(r) for r in table.read().collect()] == [(1, "b", 0.5, 1)]


def test_a_run_that_dies_changes_nothing(spark, monkeypatch):
    table = IncrementalDedup(spark, scratch_path(spark, "increments"), RULES["max"])
    with pytest.raises(versions.NoSuchVersion):
        table.read()
    one, two = (spark.createDataFrame([(1, t, 1.0, 1)], ROWS) for t in "ab")
    table.absorb(one)

    def die(*_):
        raise RuntimeError("lost driver")

    with monkeypatch.context() as m:
        m.setattr(versions, "commit", die)
        with pytest.raises(RuntimeError, match="lost driver"):
            table.absorb(two)
    assert table.read().first().t == "a"
    table.absorb(two)
    assert table.read().first().t == "b"
    assert len(table.vacuum()) >= 2


def test_unfinished_and_conflicting_commits(spark, monkeypatch):
    table = IncrementalDedup(spark, scratch_path(spark, "increments"), RULES["max"])
    one, two = (spark.createDataFrame([(k, "a", 1.0, 1)], ROWS) for k in (1, 2))
    table.absorb(one)
    other = IncrementalDedup(spark, table.root, RULES["max"])
    write = table._write

    def slow(df):
        if not table.late:
            table.late = True
            other.absorb(one)
        return write(df)

    table.late = False
    monkeypatch.setattr(table, "_write", slow)
    with pytest.raises(versions.CommitConflict):
        table.absorb(two)
    monkeypatch.undo()
    path = f"{table.root.removeprefix('file:')}/{versions.COMMITS}/{9:012d}"
    with open(path, "w") as fh:
        fh.write("[[")
    with pytest.raises(versions.CommitConflict):
        table.absorb(two)
    assert table.read().count() == 1
    table.absorb(two, recover=True)
    assert table.read().count() == 2


def test_dropped_files_are_absorbed_once(spark):
    src = scratch_path(spark, "drops")
    local = src.removeprefix("file:")
    os.makedirs(local)
    table = IncrementalDedup(spark, scratch_path(spark, "increments"), lambda df: dedup.min_link(df, "product_id", "id_web", "numeric"))
    for name, text in (("a", "1,99\n2,5\n1,100\n"), ("b", "2,4\n3,x\n"), ("c", ",8\n3,11\n")):
        with open(f"{local}/{name}.csv", "w") as fh:
            fh.write("product_id,id_web\n" + text)
        dedup_new_files(spark, src, table, "liaison", keep=F.col("product_id").isNotNull())
        dedup_new_files(spark, src, table, "liaison", keep=F.col("product_id").isNotNull())
    assert {(r.product_id, r.id_web) for r in table.read().collect()} == {(1, "99"), (2, "4"), (3, "11")}
    assert versions.last_number(spark, table.root) == 3
