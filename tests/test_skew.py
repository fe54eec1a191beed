"""A key holding a third of all rows is combined map-side, never shipped whole."""

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import dedup


def _skewed(spark, n=30000, parts=6):
    # key 0 holds a third of the rows; the rest are spread over 1000 keys
    return (
        spark.range(n, numPartitions=parts)
        .withColumn("k", F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 1000 + 1))
        .withColumn("t", F.col("id") * 7 % 10007)
        .withColumn("s", F.concat(F.lit("v"), (F.col("id") % 97).cast("string")))
    )


def _records_written(spark, df):
    """Sum of 'shuffle records written' over the exchanges of the executed plan."""
    df.write.format("noop").mode("overwrite").save()
    jplan = df._jdf.queryExecution().executedPlan()
    # AdaptiveSparkPlanExec -> final plan; walk it and read exchange metrics
    final = jplan.finalPhysicalPlan() if jplan.nodeName() == "AdaptiveSparkPlan" else jplan
    total = 0
    stack = [final]
    while stack:
        node = stack.pop()
        name = node.nodeName()
        if name in ("ShuffleQueryStage",):
            ex = node.shuffle()
            total += ex.metrics().apply("shuffleRecordsWritten").value()
        children = node.children()
        for i in range(children.size()):
            stack.append(children.apply(i))
    return total


def test_max_per_key_hot_key_partial(spark):
    df = _skewed(spark)
    out = dedup.max_per_key(df, "k", ["t", "s"])
    assert out.count() == 1001
    written = _records_written(spark, out)
    # at most one row per key per map partition reaches the shuffle
    assert 1001 <= written <= 6 * 1001


def test_latest_per_key_hot_key_partial(spark):
    df = _skewed(spark)
    out = dedup.latest_per_key(df, "k", "t", tie_breakers=["id"])
    rows = {r["k"]: r["t"] for r in out.collect()}
    assert len(rows) == 1001
    assert rows[0] == df.filter("k = 0").agg(F.max("t")).first()[0]
    written = _records_written(spark, out)
    assert 1001 <= written <= 6 * 1001


@pytest.mark.parametrize("staged", [False, True])
def test_fusion_hot_link_target_is_split_by_aqe(spark, staged):
    from ledgerline.operators import fuse
    from ledgerline.plans.batch import Stager
    from ledgerline.session import scratch_path

    n = 60000
    erp = (
        spark.range(n, numPartitions=8)
        .select(
            F.col("id").alias("product_id"),
            F.lit(1).alias("onsale_web"),
            (F.col("id") % 100 + 1).cast("double").alias("price"),
            F.lit(2).cast("long").alias("stock_quantity"),
            F.lit("instock").alias("stock_status"),
        )
    )
    # a third of the products link to the same post
    link = spark.range(n, numPartitions=8).select(
        F.col("id").alias("product_id"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 5000 + 1).alias("id_web"),
    )
    web = spark.range(5001, numPartitions=4).select(
        F.col("id").alias("sku"),
        F.concat(F.lit("t"), F.col("id").cast("string")).alias("post_title"),
        F.lit("e").alias("post_excerpt"),
        F.lit("publish").alias("post_status"),
        F.lit("product").alias("post_type"),
        F.lit(4.0).alias("average_rating"),
        F.lit(1.0).alias("total_sales"),
    )
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        if staged:
            erp, web, link = Stager(spark, scratch_path(spark, "skew"), buckets=8).put_dedups(erp, web, link)
        out = fuse.fuse(erp, link, web)
        assert out.count() == n
        jplan = out._jdf.queryExecution().executedPlan()
        final = jplan.finalPhysicalPlan().toString()  # runs the adaptive plan to completion
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert "skew=true" in final
