"""Join-key normalisation for keys landed from text files."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalize_key(c: Column | str) -> Column:
    """Trim a key to text and undo float promotion (``'15298.0'`` -> ``'15298'``).

    Keys compared across sources are kept as strings: comparing an inferred number
    with text fails at run time as soon as one non-numeric key appears. Empty text
    becomes NULL so required-key filters drop it.
    """
    c = F.col(c) if isinstance(c, str) else c
    text = F.trim(c.cast("string"))
    text = F.regexp_replace(text, r"^(\d+)\.0$", "$1")
    return F.when(text == F.lit(""), F.lit(None).cast("string")).otherwise(text)
