"""Explicit schemas of the three raw sources when they arrive as CSV.

Columns are matched by the names in the header; declared columns get their
declared types and every other column is carried on as text. Types are fixed
once at landing; no scan infers them. A value that is set but isn't of its
declared type stops the run: it never becomes a silent NULL. Join keys between
the sources (``sku``, ``id_web``) are text and go through ``normalize_key``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from ledgerline.functions.keys import normalize_key

ERP_SCHEMA = StructType(
    [
        StructField("product_id", LongType()),
        StructField("onsale_web", IntegerType()),
        StructField("price", DoubleType()),
        StructField("stock_quantity", LongType()),
        StructField("stock_status", StringType()),
    ]
)

WEB_SCHEMA = StructType(
    [
        StructField("sku", StringType()),
        StructField("post_type", StringType()),
        StructField("post_date", TimestampNTZType()),
        StructField("post_title", StringType()),
        StructField("post_excerpt", StringType()),
        StructField("post_status", StringType()),
        StructField("average_rating", DoubleType()),
        StructField("total_sales", DoubleType()),
    ]
)

LINK_SCHEMA = StructType(
    [
        StructField("product_id", LongType()),
        StructField("id_web", StringType()),
    ]
)

SCHEMAS = {"erp": ERP_SCHEMA, "web": WEB_SCHEMA, "liaison": LINK_SCHEMA}
KEY_COLUMNS = {"web": ["sku"], "liaison": ["id_web"]}


def normalize_keys(df: DataFrame, source: str) -> DataFrame:
    """Apply ``normalize_key`` to the text join keys of one source."""
    for c in KEY_COLUMNS.get(source, []):
        df = df.withColumn(c, normalize_key(F.col(c)))
    return df


# Columns without which a source cannot be cleaned.
REQUIRED_COLUMNS = {
    "erp": ["product_id", "onsale_web", "price", "stock_quantity", "stock_status"],
    "web": ["sku", "post_type", "post_date", "post_title"],
    "liaison": ["product_id", "id_web"],
}


class LandingError(RuntimeError):
    """A dropped file lacks a required column."""


def _typed(name: str, kind: str) -> tuple[Column, Column]:
    """A text column as its declared type, and whether a set value is not of that type."""
    text = F.trim(F.col(f"`{name}`"))
    text = F.when(text != F.lit(""), text)
    # whole numbers that passed through a float column look like 15298.0
    plain = F.regexp_replace(text, r"^(-?\d+)\.0+$", "$1") if kind in ("bigint", "int") else text
    value = plain.try_cast(kind)
    return value, text.isNotNull() & value.isNull()


def land(raw: DataFrame, source: str, strict: bool = True) -> DataFrame:
    """Declared columns of ``source`` with their types, by name, and every other column of ``raw`` as text.

    A declared column that the file lacks is NULL unless it is required (then ``LandingError``). ``strict``: a set value
    that isn't of its type fails the job that reads it, naming column and value; otherwise it is NULL and
    ``uncastable`` counts it.
    """
    schema = SCHEMAS[source]
    missing = [c for c in REQUIRED_COLUMNS[source] if c not in raw.columns]
    if missing:
        raise LandingError(f"{source}: the file has no column {', '.join(missing)}")
    columns = []
    for field in schema:
        kind = field.dataType.simpleString()
        if field.name not in raw.columns:
            columns.append(F.lit(None).cast(kind).alias(field.name))
        elif kind == "string":
            columns.append(F.col(f"`{field.name}`"))
        else:
            value, bad = _typed(field.name, kind)
            if strict:
                text = F.concat(F.lit(f"{source}.{field.name} is not {kind}: "), F.col(f"`{field.name}`"))
                value = F.when(bad, F.raise_error(text).cast(kind)).otherwise(value)
            columns.append(value.alias(field.name))
    columns += [F.col(f"`{c}`") for c in raw.columns if c not in schema.names]
    return normalize_keys(raw.select(*columns), source)


def uncastable(raw: DataFrame, source: str) -> DataFrame:
    """One row: per typed column of ``source``, how many set values are not of its type."""
    bad = [(f.name, _typed(f.name, f.dataType.simpleString())[1]) for f in SCHEMAS[source] if f.name in raw.columns and f.dataType.simpleString() != "string"]
    return raw.agg(*[F.count_if(b).alias(n) for n, b in bad])

