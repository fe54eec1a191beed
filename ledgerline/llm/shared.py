"""Stage tables, size estimates and connected components shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import scratch_path


def staged(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it back (cuts lineage; survives lost executors)."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def plan_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of ``df``: file sizes for a scan, no job. It only places work, never decides results."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def bucket_count(df: DataFrame, bytes_each: int, least: int = 24) -> int:
    """How many buckets hold about ``bytes_each`` of input each."""
    return max(least, min(1 << 20, -(-plan_bytes(df) // bytes_each)))


def connected_components(edges: DataFrame, label: str = "components") -> DataFrame:
    """Smallest node reachable from every node of an edge list, by alternating large-star and small-star rounds.

    ``edges`` has long columns ``u`` and ``v`` (either order; repeats and loops are harmless). Returns ``node``,
    ``component``; a node without an edge to another node is absent. Each round joins every node with the smallest of
    its neighbours (a partial aggregate), so a node with very many neighbours is never gathered: its rows stay
    separate and adaptive skew handling can split them. Every round is a stage table. Rounds end when the edge list
    no longer changes, which takes O(log^2 n) rounds.
    """
    spark = edges.sparkSession
    big, small = F.greatest("u", "v"), F.least("u", "v")
    now = staged(edges.filter("u <> v").select(big.alias("u"), small.alias("v")).distinct(), label)
    seen = _fingerprint(now)
    while seen[0]:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # large star: every larger neighbour of u points to the smallest node around u
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: u and its smaller neighbours all point to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        star = joined.select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("e"))
        now = staged(star.select("e.u", F.col("e.m").alias("v")).filter("u <> v").distinct(), label)
        after = _fingerprint(now)
        if after == seen:
            break
        seen = after
    components = now.groupBy("u").agg(F.min("v").alias("component"))
    roots = components.select(F.col("component").alias("u"), "component").distinct()
    return components.union(roots).select(F.col("u").alias("node"), "component")


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.expr("sum(cast(xxhash64(u, v) as decimal(38,0)))")).first())


def tables(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table by its path (any store that Spark reads)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
