"""Three deduplication rules: per-column MAX, MIN link, latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def max_per_key(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """One row per key holding the independent MAX of each column.

    The row may combine values of different input rows, and text compares
    alphabetically (``'outofstock'`` beats ``'instock'``); that is the rule.
    Plan: partial HashAggregate before the shuffle, so a key holding a third of
    all rows is combined map-side and never lands whole in one task.
    """
    return df.groupBy(key).agg(*[F.max(F.col(c)).alias(c) for c in columns])


def min_link(df: DataFrame, key: str, target: str, ordering: str = "native") -> DataFrame:
    """One row per key with the smallest link target.

    ``ordering``: ``native`` (the column's own type), ``numeric`` (compare as
    numbers: ``'99'`` < ``'100'``; a non-numeric target loses to every number, so
    a key keeps it only when it has nothing else) or ``text`` (lexicographic:
    ``'100'`` < ``'99'``). Targets of equal rank (``'99'``, ``'099'``) are decided
    as text. The output keeps the target value as it was in the input; it is
    NULL only for a key whose targets are all NULL.
    """
    if ordering == "native":
        return df.groupBy(key).agg(F.min(F.col(target)).alias(target))
    if ordering == "numeric":
        return _min_numeric(df, key, target)
    if ordering == "text":
        order_expr = F.col(target).cast("string")
    else:
        raise ValueError(f"unknown ordering: {ordering}")
    return df.groupBy(key).agg(F.min_by(F.col(target), order_expr).alias(target))


def _min_numeric(df: DataFrame, key: str, target: str) -> DataFrame:
    """MIN by number, as a hash aggregate.

    A whole number in its usual spelling is its 64-bit value and back, so those targets are aggregated as longs, whose
    buffer has a fixed width. All other targets (``'099'``, ``'1.5'``, words) are ranked as text and number in an
    aggregate of their own, which sorts; it reads the input a second time but only those rows reach it. A key with
    both kinds takes the smaller of its two results.
    """
    value, usual, whole, odd, odd_key = "__value", "__usual", "__whole", "__odd", "__odd_key"

    def rank(c: Column) -> Column:
        number = c.cast("string").try_cast("decimal(38,10)")
        return F.struct(number.isNull().alias("text"), number.alias("number"), c.cast("string").alias("target"))

    read = df.select(key, target, F.col(target).cast("string").try_cast("bigint").alias(value))
    read = read.withColumn(usual, F.coalesce(F.col(value).cast("string") == F.col(target).cast("string"), F.lit(False)))
    wholes = read.groupBy(key).agg(F.min(F.when(F.col(usual), F.col(value))).alias(whole))
    odds = read.filter(F.col(target).isNotNull() & ~F.col(usual)).groupBy(F.col(key).alias(odd_key)).agg(F.min_by(F.col(target), rank(F.col(target))).alias(odd))
    spelled = F.col(whole).cast("string").cast(df.schema[target].dataType)
    pick = F.when(F.col(odd).isNull(), spelled).when(F.col(whole).isNull(), F.col(odd)).when(rank(spelled) < rank(F.col(odd)), spelled).otherwise(F.col(odd))
    return wholes.join(odds, wholes[key].eqNullSafe(odds[odd_key]), "left").select(wholes[key], pick.alias(target))


def link_ordering(link: DataFrame, target: str, other: DataFrame, other_key: str) -> str:
    """The order that the two sides of a link call for: ``native`` when neither is text, ``numeric`` when every set key
    of both is a number, else ``text``. One aggregate per side; two counts come back to the driver."""
    sides = [(link, target), (other, other_key)]
    if all(dict(df.dtypes)[c] != "string" for df, c in sides):
        return "native"
    for df, c in sides:
        value = F.col(c).cast("string")
        odd = df.agg(F.count_if(value.isNotNull() & value.try_cast("decimal(38,10)").isNull()).alias("n")).first()
        if odd["n"]:
            return "text"
    return "numeric"


ALL_COLUMNS = "all"


def latest_per_key(
    df: DataFrame,
    key: str,
    order_col: str,
    tie_breakers: Sequence[str] | str = (),
    where: Column | None = None,
) -> DataFrame:
    """Newest row per key: ``ROW_NUMBER() OVER (PARTITION BY key ORDER BY order_col DESC) = 1``.

    Rows with a NULL order value lose (DESC NULLS LAST); ``tie_breakers`` (also
    descending) make the winner deterministic when order values repeat;
    ``"all"`` uses every other column in schema order, so the same input always
    yields the same rows, and a task retried after a lost executor cannot pick a
    different row. ``where`` is applied *before* the window, as the rule requires.

    Plan: the ``rn = 1`` filter becomes a WindowGroupLimit that keeps one row per
    key in each map partition before the shuffle, so a hot key sends at most one
    row per map task.
    """
    if where is not None:
        df = df.filter(where)
    if isinstance(tie_breakers, str):
        if tie_breakers != ALL_COLUMNS:
            raise ValueError(f"unknown tie_breakers: {tie_breakers}")
        tie_breakers = [c for c in df.columns if c not in (key, order_col)]
    order = [F.col(order_col).desc_nulls_last()] + [F.col(c).desc_nulls_last() for c in tie_breakers]
    w = Window.partitionBy(key).orderBy(*order)
    rn = "__rn"
    return df.withColumn(rn, F.row_number().over(w)).filter(F.col(rn) == 1).drop(rn)
