"""Temperature mixing of sources under a token budget.

A source with n of the N tokens gets the weight (n / N)^t, normalised. t = 1 keeps the natural shares, smaller t flattens
them. The exponent is found by bisection: the smallest t for which no source is repeated more than ``repetitions`` times,
or the largest t whose weights reach ``entropy``. Each source then has a quota of the budget. It is realised
as block permutations: an epoch of a source is a permutation of its documents, made of blocks; whole epochs are drawn
while the quota lasts, and of the last epoch the longest beginning that fits.

The sums over sources are aggregates (exact decimals, hence the same on any partitioning); the driver sees one row per
round of the bisection. No source is ever ordered in one task: tokens are summed per block, running totals go over the
``BLOCKS`` blocks of a source, and only documents of the block where the quota ends are ordered, each such block in its
own task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.llm.shared import staged

BLOCKS = 4096
GRID = 32  # parts that a round of the bisection cuts its interval into
ROUNDS = 6
WORD = r"[^\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]"


def token_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def source_tokens(docs: DataFrame, text: str = "text", source: str = "source") -> DataFrame:
    """``source`` and ``tokens`` of every source that has tokens; a null source is one source."""
    return docs.groupBy(F.col(source).alias("source")).agg(F.sum(token_count(F.col(text))).alias("tokens")).filter("tokens > 0")


def _exact(value: Column) -> Column:
    return F.sum(value.cast("decimal(38,20)"))


def temperature(sources: DataFrame, budget: int, repetitions: float | None = None, entropy: float | None = None) -> float:
    """Exponent that meets the target (in nats for ``entropy``); within 0 to 1.

    With ``repetitions``: the smallest exponent at which no source is drawn more often than that; 1 if even the natural
    shares exceed it. With ``entropy``: the largest exponent whose weights have at least that entropy; 0 if the equal
    shares don't reach it.
    """
    if (repetitions is None) == (entropy is None):
        raise ValueError("give either repetitions or entropy")
    total, least = sources.agg(F.sum("tokens"), F.min("tokens")).first()
    if not total:
        return 1.0

    def meets(t: float, z: float, e: float) -> bool:
        if repetitions is not None:  # the smallest source is repeated most: weight * budget / tokens
            return (least / total) ** t / z * budget / least <= repetitions
        return math.log(z) - e / z >= entropy

    low, high = 0.0, 1.0
    for _ in range(ROUNDS):
        grid = [low + (high - low) * i / GRID for i in range(GRID + 1)]
        share = F.col("tokens") / F.lit(float(total))
        columns = []
        for i, t in enumerate(grid):
            power = F.pow(share, F.lit(t))
            columns += [_exact(power).alias(f"z{i}"), _exact(power * t * F.log(share)).alias(f"e{i}")]
        row = sources.agg(*columns).first()
        good = [meets(t, float(row[f"z{i}"]), float(row[f"e{i}"])) for i, t in enumerate(grid)]
        if repetitions is not None:  # rises with falling t: the good ones are at the upper end
            if not good[-1]:
                return 1.0
            first = good.index(True)
            low, high = grid[max(first - 1, 0)], grid[first]
        else:  # entropy falls with rising t: the good ones are at the lower end
            if not good[0]:
                return 0.0
            last = max(i for i, g in enumerate(good) if g)
            low, high = grid[last], grid[min(last + 1, GRID)]
        if low == high:
            break
    return high if repetitions is not None else low


def quotas(sources: DataFrame, exponent: float, budget: int) -> DataFrame:
    """``source``, ``tokens``, ``weight``, ``quota`` (tokens to draw), ``epochs`` (whole ones) and ``rest`` (tokens of the last)."""
    total = sources.agg(F.sum("tokens")).first()[0] or 1
    power = F.pow(F.col("tokens") / F.lit(float(total)), F.lit(float(exponent)))
    z = float(sources.agg(_exact(power)).first()[0] or 1)
    out = sources.withColumn("weight", power / F.lit(z)).withColumn("quota", F.floor(F.col("weight") * F.lit(float(budget)) + F.lit(1e-6)).cast("long"))
    return out.withColumn("epochs", F.expr("quota div tokens")).withColumn("rest", F.expr("quota % tokens"))


def mix(docs: DataFrame, budget: int | None = None, repetitions: float | None = 2.0, entropy: float | None = None, text: str = "text", source: str = "source", seed: int = 1) -> DataFrame:
    """The drawn documents: all columns of ``docs`` in the struct ``row``, and how each was drawn.

    Adds ``n_tokens``, ``epoch`` (from 1), ``block`` (its place in the epoch's permutation) and ``weight`` (of the
    source). ``budget`` is in tokens; by default all tokens of ``docs``. A row without tokens is never drawn. Rows that
    repeat a doc_id are drawn each for itself; a null doc_id or source is a value like any other.
    """
    # Splitting texts is most of the work: rows without tokens go by their first word, and n_tokens is counted where it is
    # used, after the joins, so that no condition on it makes Spark count a text twice.
    own_text = F.col(f"row.{text}").cast("string")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")).filter(own_text.rlike(NOT_SPACE))
    rows = rows.withColumn("source", F.col(f"row.{source}"))
    n_tokens = token_count(own_text)
    sources = staged(source_tokens(docs, text, source), "mix-sources")
    if budget is None:
        budget = int(sources.agg(F.sum("tokens")).first()[0] or 0)
    quota = staged(quotas(sources, temperature(sources, budget, repetitions, entropy), budget), "mix-quotas")

    # a source without a quota is not drawn (sequence(1, 0) would count down)
    drawn = rows.join(quota.filter("quota > 0").select(F.col("source").alias("of"), "weight", "epochs", "rest"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    epoch = F.expr("sequence(1, cast(epochs as int) + if(rest > 0, 1, 0))")
    drawn = drawn.withColumn("epoch", F.explode(epoch)).withColumn("last", F.expr("epoch > epochs"))

    def placed(some: DataFrame) -> DataFrame:
        some = some.withColumn("place", F.xxhash64(F.lit(seed), "epoch", "row.doc_id", F.col(f"row.{text}")))
        return some.withColumn("block", F.pmod("place", F.lit(BLOCKS)).cast("int"))

    # the last epoch of each source: whole blocks below the quota, and part of the block in which it ends
    ending = placed(drawn.filter("last"))
    last = ending.groupBy("source", "rest", "epoch", "block").agg(F.sum(n_tokens).alias("tokens"))
    over = Window.partitionBy("source").orderBy("block")
    upto = last.withColumn("upto", F.sum("tokens").over(over)).withColumn("left", F.expr("rest - (upto - tokens)"))
    limits = staged(upto.filter("left > 0").select(F.col("source").alias("of"), F.col("block").alias("at"), "left", F.expr("left >= tokens").alias("whole")), "mix-limits")

    def limited(some: DataFrame) -> DataFrame:
        return ending.join(some, F.col("source").eqNullSafe(F.col("of")) & (F.col("block") == F.col("at"))).drop("of", "at").withColumn("n_tokens", n_tokens)

    inside = Window.partitionBy("source", "block").orderBy("place", F.col("row.doc_id"))
    ends = limited(limits.filter("not whole")).withColumn("upto", F.sum("n_tokens").over(inside.rowsBetween(Window.unboundedPreceding, 0))).filter("upto <= left").drop("upto")
    columns = ["row", "n_tokens", "epoch", "block", "weight"]
    whole_epochs = placed(drawn.filter("not last")).withColumn("n_tokens", n_tokens)
    return whole_epochs.select(*columns).union(limited(limits.filter("whole")).select(*columns)).union(ends.select(*columns))
