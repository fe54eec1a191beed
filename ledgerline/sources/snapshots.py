"""Frozen copies that are checked when they are read.

A snapshot holds its tables and one manifest row per table: rows, schema and a digest that doesn't depend on the order of
rows or on the partitioning (the exact sum of 64-bit row hashes, twice over with different seeds). A dropped, doubled or
altered row changes it; so do a renamed column and another type.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.sources import files, versions

MANIFEST = "_manifest"
MANIFEST_SCHEMA = "table_name string, n_rows bigint, digest string, columns string"


class SnapshotError(RuntimeError):
    """A table of a snapshot isn't what was frozen."""


def _row_hash(df: DataFrame, seed: str) -> Column:
    """Hash of a row with its nulls: a null and an absent value of the neighbour don't read alike."""
    parts: list[Column] = [F.lit(seed)]
    for name in sorted(df.columns):
        c = F.col(f"`{name}`")
        parts += [c.isNull(), c]
    return F.xxhash64(*parts)


def digest(df: DataFrame) -> DataFrame:
    """One row: ``n_rows``, ``digest``. One pass, partial aggregates only. Maps aren't hashable in Spark."""
    total = [F.coalesce(F.sum(_row_hash(df, s).cast("decimal(28,0)")), F.lit(0)).cast("string") for s in ("a", "b")]
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.concat_ws(":", *total).alias("digest"))


def _columns(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in sorted(df.schema, key=lambda f: f.name))


def manifest_of(frames: dict[str, DataFrame]) -> DataFrame:
    parts = [digest(df).select(F.lit(n).alias("table_name"), "n_rows", "digest", F.lit(_columns(df)).alias("columns")) for n, df in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def freeze(frames: dict[str, DataFrame], root: str) -> dict[str, str]:
    """Write each frame below ``root`` and, last, the manifest of what was written; both replace an earlier snapshot whole.

    The digests are taken from the written files, so they describe what a reader gets. The tables of a snapshot share one
    folder per freeze and become visible together, with the manifest's commit.
    """
    if not frames:
        raise ValueError("a snapshot needs at least one table")
    spark, root = next(iter(frames.values())).sparkSession, root.rstrip("/")
    folder = f"{root}/tables-{uuid.uuid4().hex}"
    paths = {n: f"{folder}/{n}" for n in frames}
    for n, df in frames.items():
        files.write_parquet(df, paths[n], mode="errorifexists")
    written = manifest_of({n: spark.read.parquet(p) for n, p in paths.items()})
    versions.replace(written.withColumn("folder", F.lit(folder)).coalesce(1), f"{root}/{MANIFEST}")
    return paths


def verify(spark: SparkSession, root: str) -> DataFrame:
    """``table_name``, ``n_rows``, ``digest``, ``intact`` of every table of the snapshot, from its files as they are now."""
    frozen = versions.read(spark, f"{root.rstrip('/')}/{MANIFEST}")
    listed = frozen.collect()  # a row per table
    now = manifest_of({r.table_name: spark.read.parquet(f"{r.folder}/{r.table_name}") for r in listed}).alias("now")
    both = frozen.alias("was").join(now, F.col("was.table_name") == F.col("now.table_name"))
    same = (F.col("was.n_rows") == F.col("now.n_rows")) & (F.col("was.digest") == F.col("now.digest")) & (F.col("was.columns") == F.col("now.columns"))
    return both.select("was.table_name", "now.n_rows", "now.digest", same.alias("intact"))


def read_verified(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The tables of a snapshot, or ``SnapshotError`` naming those that aren't intact. Reads every table once."""
    broken = sorted(r.table_name for r in verify(spark, root).filter("not intact").collect())
    if broken:
        raise SnapshotError(f"{root}: not as frozen: {', '.join(broken)}")
    listed = versions.read(spark, f"{root.rstrip('/')}/{MANIFEST}").collect()
    return {r.table_name: spark.read.parquet(f"{r.folder}/{r.table_name}") for r in listed}
