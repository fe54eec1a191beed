"""Column types of a header CSV, inferred from all of its values in the pass that lands it.

Every value has a set of types that accept it (a bit per type); a column's candidates are the bitwise AND over its values,
and its type is the narrowest candidate. That is one aggregate over all columns, without a sample: one odd value in the
last row of the last file counts like any other. The folds (bitwise AND and maxima) don't change when a value is seen
twice, so they can be observed on the write that lands the text as Parquet, also when a lost task runs again: the CSV
files are parsed once.
"""

from __future__ import annotations

import csv
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerline.sources import files
from ledgerline.sources.schemas import LandingError

# Candidate types, narrowest first, each with its bit. Text accepts everything.
BOOLEAN, LONG, DECIMAL, DOUBLE, DATE, TIMESTAMP = (1 << i for i in range(6))
EVERY = (1 << 6) - 1
DELIMITERS = (",", ";", "\t", "|")
PROBE_LINES = 20  # lines of one file that the dialect is taken from

# The forms of the types, checked before any cast is tried (a failed cast costs far more than a pattern).
_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)$"
_POWER = r"^[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)[eE][+-]?[0-9]+|[iI]nf(inity)?|[nN]a[nN])$"
_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_MOMENT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?$"


@dataclass
class Inferred:
    """Name and Spark type of every column in file order, and the dialect that they were read with."""

    types: dict[str, str]
    delimiter: str = ","
    set_columns: set[str] = field(default_factory=set)


def _fields(line: str, delimiter: str) -> int | None:
    """Fields of one line, or None if it ends inside quotes (a quoted line break)."""
    fields, quoted = 1, False
    for ch in line:
        if ch == '"':
            quoted = not quoted
        elif ch == delimiter and not quoted:
            fields += 1
    return None if quoted else fields


def probe_delimiter(spark: SparkSession, path: str) -> str:
    """The delimiter that cuts the first lines into equally many fields, and most of them. Reads ``PROBE_LINES`` lines."""
    lines = [r.value for r in spark.read.text(path).limit(PROBE_LINES).collect()]
    best, found = (0, 1), DELIMITERS[0]
    for delimiter in DELIMITERS:
        width, agreeing = None, 0
        for line in lines:
            n = _fields(line, delimiter)
            if n is None or (width is not None and n != width):
                break
            width, agreeing = n, agreeing + 1
        score = (agreeing, width or 1)
        if (width or 1) > 1 and score > best:
            best, found = score, delimiter
    return found


def _text(name: str) -> Column:
    """A set value without outer blanks; blank is NULL."""
    text = F.trim(F.col(f"`{name}`"))
    return F.when(text != "", text)


def accepted_by(text: Column) -> Column:
    """Bits of the types that accept a value; NULL for NULL."""
    point = F.instr(text, ".") > 0
    long = ~point & ((F.length(text) <= 18) | text.try_cast("bigint").isNotNull())
    exact = (F.length(text) <= 38) | (F.length(F.regexp_replace(text, r"^[+-]?0*|\.", "")) <= 38)
    number = F.when(long, LONG | DECIMAL | DOUBLE).when(exact, DECIMAL | DOUBLE).otherwise(DOUBLE)
    return (
        F.when(text.isNull(), F.lit(None).cast("int"))
        .when(text.rlike(_NUMBER), number)
        .when(F.length(text).between(10, 26) & text.rlike(_DATE), F.when(text.try_cast("date").isNotNull(), DATE | TIMESTAMP).otherwise(0))
        .when(F.length(text).between(16, 26) & text.rlike(_MOMENT), F.when(text.try_cast("timestamp_ntz").isNotNull(), TIMESTAMP).otherwise(0))
        .when(F.length(text).between(4, 5) & F.lower(text).isin("true", "false"), BOOLEAN)
        .when((F.length(text) <= 64) & text.rlike(_POWER), DOUBLE)
        .otherwise(0)
    )


def _with_texts(raw: DataFrame) -> DataFrame:
    """The columns of ``raw`` as struct ``row``, and its values without outer blanks (``text_<i>``), each trimmed once."""
    row = F.struct(*[F.col(f"`{c}`") for c in raw.columns]).alias("row")
    return raw.select(row, *[_text(c).alias(f"text_{i}") for i, c in enumerate(raw.columns)])


def folds(n: int, decimals: bool = False) -> list[Column]:
    """Per column of ``_with_texts`` the candidate types, for ``decimals`` also the digits before and after the point.

    Aggregates that don't mind a value seen twice. Each is an expression of its own, so Spark compiles them into methods
    of their own, however many columns there are.
    """
    out = []
    for i in range(n):
        text = F.col(f"text_{i}")
        out.append(F.bit_and(accepted_by(text)).alias(f"types_{i}"))
        if decimals:
            number = F.when(text.rlike(_NUMBER), text)
            point, length = F.instr(number, "."), F.length(number)
            sign = F.when(F.substring(number, 1, 1).isin("+", "-"), 1).otherwise(0)
            out.append(F.max(F.when(point > 0, point - 1).otherwise(length) - sign).alias(f"whole_{i}"))
            out.append(F.max(F.when(point > 0, length - point).otherwise(0)).alias(f"places_{i}"))
    return out


def choose(columns: list[str], seen: dict, keep_text: Iterable[str] = (), decimals: bool = False) -> Inferred:
    """The narrowest candidate of every column; a column without values is text.

    ``decimals``: numbers with a decimal point become exact decimals where 38 digits hold them all; otherwise they are
    doubles, and whole numbers too large for a long are doubles too.
    """
    types, with_values = {}, set()
    for i, name in enumerate(columns):
        candidates = seen[f"types_{i}"]
        if candidates is not None:
            with_values.add(name)
        whole, places = seen.get(f"whole_{i}") or 0, seen.get(f"places_{i}") or 0
        if candidates is None or not candidates or name in keep_text:
            kind = "string"
        elif candidates & BOOLEAN:
            kind = "boolean"
        elif candidates & LONG:
            kind = "bigint"
        elif candidates & DECIMAL and decimals and whole + places <= 38:
            kind = f"decimal({max(whole + places, 1)},{places})"
        elif candidates & DOUBLE:
            kind = "double"
        elif candidates & DATE:
            kind = "date"
        else:
            kind = "timestamp_ntz"
        types[name] = kind
    return Inferred(types, set_columns=with_values)


def infer(raw: DataFrame, keep_text: Iterable[str] = (), decimals: bool = False) -> Inferred:
    """Types of the columns of an all-text frame, in one aggregate."""
    return choose(raw.columns, _with_texts(raw).agg(*folds(len(raw.columns), decimals)).first().asDict(), keep_text, decimals)


def typed(raw: DataFrame, found: Inferred) -> DataFrame:
    """``raw`` with the inferred types. Text columns keep their values as they are, outer blanks included."""
    return raw.select(*[F.col(f"`{n}`") if kind == "string" else _text(n).cast(kind).alias(n) for n, kind in found.types.items()])


def read_text(spark: SparkSession, path: str, delimiter: str | None = None, multiline: bool = True) -> DataFrame:
    """Header CSV as text columns; the delimiter is probed if it isn't given. Files are matched to the first one's header."""
    options = files.CSV_OPTIONS | {"sep": delimiter or probe_delimiter(spark, path)}
    for line in spark.read.text(path).limit(1).collect():
        header = [n.strip().lower() for n in next(csv.reader([line.value], delimiter=options["sep"]), [])]
        if len(set(header)) < len(header):
            raise LandingError(f"{path}: the header repeats a name ({line.value})")
    names = spark.read.options(**options).option("inferSchema", "false").csv(path).columns
    reader = spark.read.options(**options).option("multiLine", str(multiline).lower()).option("enforceSchema", "false")
    return reader.option("mode", "FAILFAST").schema(files.text_schema(names)).csv(path)


def land_inferred(
    spark: SparkSession,
    path: str,
    target: str,
    delimiter: str | None = None,
    multiline: bool = True,
    keep_text: Iterable[str] = (),
    decimals: bool = False,
) -> tuple[DataFrame, Inferred]:
    """Land the CSV files at ``path`` as Parquet at ``target`` and return them with inferred types, and the types.

    The files are parsed once: the text columns are written while the candidate types are folded on the same rows, and
    the returned frame casts the written text (each value is of its column's type, so no cast fails). Columns in
    ``keep_text`` stay text (keys with leading zeros). ``multiline=False`` splits large files that have no quoted line
    breaks. An empty value, quoted or not, is NULL, and so is
    a blank one in a typed column; a column of blanks only is text. Without rows every column is text.
    """
    delimiter = delimiter or probe_delimiter(spark, path)
    raw = read_text(spark, path, delimiter, multiline)
    seen = Observation()
    watched = _with_texts(raw).observe(seen, *folds(len(raw.columns), decimals))
    watched.select(*[F.col(f"row.`{c}`") for c in raw.columns]).write.mode("overwrite").parquet(target)
    found = choose(raw.columns, seen.get, keep_text, decimals)
    found.delimiter = delimiter
    return typed(spark.read.schema(raw.schema).parquet(target), found), found
