"""Numeric helpers whose results must not depend on the engine or on partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_away(c: Column | str, places: int = 2) -> Column:
    """Round a double to ``places`` decimals the way SQL engines do on binary values.

    ``F.round(x, 2)`` rounds the *decimal text* of ``x`` (1.005 -> 1.01) whereas the
    reference scales, rounds half away from zero, and unscales the binary value
    (1.005 -> 1.0). Rounding the scaled value to 0 places and dividing back
    reproduces the latter exactly.
    """
    scale = float(10 ** places)
    return F.round(_col(c) * F.lit(scale), 0) / F.lit(scale)


def exact_sum(c: Column | str, places: int = 2, precision: int = 18) -> Column:
    """Order-independent SUM of values that already carry ``places`` decimals.

    A double SUM depends on the order partitions are merged in; summing in
    DECIMAL is exact, so every run and every engine returns the same total.
    NULL on empty input, like SQL SUM.
    """
    return F.sum(_col(c).cast(DecimalType(precision, places))).cast(DoubleType())


def nan_to_null(c: Column | str) -> Column:
    """NaN -> NULL, so it is skipped by aggregates and never compares as > x.

    (Spark and SQL order NaN above every number, so ``NaN > 2`` is true.)
    """
    c = _col(c)
    return F.when(F.isnan(c), F.lit(None).cast(DoubleType())).otherwise(c)


_WORD = 62  # bits of one fixed-point word
_BIN = 30  # binary orders of magnitude that share a scale


_WORDS = f"""
  (cast(sum(cast(cast(high AS bigint) AS decimal(28,0))) AS double)
   + cast(sum(cast(cast(rint((scaled - high) * power(2D, {_WORD})) AS bigint) AS decimal(28,0))) AS double) * power(2D, -{_WORD}))
  * power(2D, {_BIN} * bin - {_BIN} - 1)"""


def _ordered_total(df: DataFrame, c: Column, finish: str) -> Column:
    """``finish`` (SQL over ``total`` and ``n``) of a double column as a scalar subquery, the same for every order of the
    rows. One pass.

    Values of ``_BIN`` binary orders of magnitude share a scale (about 70 groups at most). Within a group each value is split
    exactly into a whole number and a whole number of 2^-62ths, and both are summed in DECIMAL; the groups' totals are
    added from the smallest scale up. NULL if a value is infinite.
    """
    infinite = "double('Infinity')"
    binned = df.select(c.alias("x")).selectExpr(
        "x", f"CASE WHEN abs(x) > 0 AND abs(x) < {infinite} THEN greatest(-30, cast(floor(log2(abs(x)) / {_BIN}) AS int)) ELSE 0 END AS bin"
    )
    scaled = binned.selectExpr("x", "bin", f"CASE WHEN abs(x) < {infinite} THEN x * power(2D, {_BIN + 1} - {_BIN} * bin) ELSE 0D END AS scaled")
    split = scaled.filter("x IS NOT NULL").selectExpr("x", "bin", "scaled", "rint(scaled) AS high")
    bins = split.groupBy("bin").agg(F.expr(f"named_struct('bin', bin, 'total', {_WORDS}, 'n', count(1), 'top', max(abs(x)))").alias("b"))
    whole = bins.selectExpr("array_sort(collect_list(b)) AS bins").selectExpr(
        "aggregate(bins, 0L, (a, b) -> a + b.n) AS n",
        f"CASE WHEN array_max(transform(bins, b -> b.top)) < {infinite} THEN aggregate(bins, 0D, (a, b) -> a + b.total) END AS total",
    )
    return whole.selectExpr(f"{finish} AS result").scalar()


def exact_moments(df: DataFrame, value: str) -> tuple[Column, Column]:
    """Mean and sample standard deviation of a double column as scalar subqueries, equal bit by bit on every partitioning.

    Two column-pruned passes: sums in fixed point give the mean, and sums of the squared deviations from it the deviation.
    NULLs are skipped. An infinite value, or a square beyond the range of doubles, makes the result NULL; so does the
    deviation of a single value.
    """
    mean = _ordered_total(df, F.col(value), "total / nullif(n, 0)")
    apart = F.col(value) - mean
    return mean, _ordered_total(df, apart * apart, "sqrt(total / nullif(n - 1, 0))")
