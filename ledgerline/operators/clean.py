"""Row and column cleaning.

Every row rule is also exposed as a predicate ``Column`` so that a summary can
count raw and kept rows in the *same* scan (``count(*)``, ``count_if(pred)``).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _all(preds: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, preds) if preds else F.lit(True)


def _any(preds: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, preds) if preds else F.lit(False)


def required_predicate(required: Sequence[str], positive: Sequence[str] = ()) -> Column:
    """True when every required column is non-NULL and every ``positive`` column is > 0.

    NaN is greater than every number in Spark SQL, so a NaN price passes ``> 0``
    exactly as it does in the SQL engines.
    """
    preds = [F.col(c).isNotNull() for c in required]
    preds += [F.col(c).isNotNull() & (F.col(c) > F.lit(0)) for c in positive if c not in required]
    preds += [F.col(c) > F.lit(0) for c in positive if c in required]
    return _all(preds)


def clean_required(df: DataFrame, required: Sequence[str], positive: Sequence[str] = ()) -> DataFrame:
    """Keep rows whose required columns are all set and positive columns > 0.

    Written as one filter; Catalyst pushes the IS NOT NULL / > 0 parts into the
    Parquet scan (``PushedFilters``) and no shuffle is involved.
    """
    return df.filter(required_predicate(required, positive))


def any_null_predicate(columns: Sequence[str]) -> Column:
    return _any([F.col(c).isNull() for c in columns])


def empty_row_predicate(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """True when every column of the row is NULL.

    Columns have mixed types, so this is an AND of ``IS NULL`` tests rather than a
    ``coalesce``.
    """
    cols = list(columns) if columns is not None else df.columns
    return _all([F.col(c).isNull() for c in cols])


def drop_empty_rows(df: DataFrame) -> DataFrame:
    """Drop rows where every column is NULL (map-only)."""
    return df.filter(~empty_row_predicate(df))


def count_empty_rows(df: DataFrame) -> DataFrame:
    """One row: ``n_rows``, ``n_empty_rows`` (one scan, partial aggregation)."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(empty_row_predicate(df)).alias("n_empty_rows"),
    )


def non_null_counts(df: DataFrame) -> DataFrame:
    """One row with, per column, its number of non-NULL values."""
    return df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns])


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Drop columns whose every value is NULL.

    The surviving schema depends on the data, so this runs one aggregate job
    (a single row of per-column counts, bounded by the schema width, comes back
    to the driver) and returns a projection of the input.
    """
    counts = non_null_counts(df).first()
    keep = [c for c in df.columns if counts[c] > 0]
    return df.select(*keep)


def clean_frame(df: DataFrame) -> DataFrame:
    """Drop wholly empty rows, then wholly empty columns."""
    return drop_empty_columns(drop_empty_rows(df))
