"""Safe object names from arbitrary paths and titles."""

from __future__ import annotations

import re
import sys
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Characters allowed in a safe name, and the replacement for the rest.
SAFE_NAME_DISALLOWED = r"[^A-Za-z0-9_.-]"
SAFE_NAME_REPLACEMENT = "_"

# After ASCII folding only code points 0-127 remain, so the disallowed set is
# finite: derived from the pattern above, it feeds a one-pass character map
# (``translate``), about twice as fast as a regex replace on long texts.
_DISALLOWED_ASCII = "".join(chr(i) for i in range(128) if re.fullmatch(SAFE_NAME_DISALLOWED, chr(i)))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def last_path_component(c: Column | str) -> Column:
    """Last non-empty ``/``-separated component; trailing slashes are ignored.

    ``'dir/'`` -> ``'dir'``, ``'a/b.txt'`` -> ``'b.txt'``, ``'/'`` and ``''`` -> ``''``.
    """
    return F.regexp_extract(_col(c), r"([^/]+)/*$", 1)


# Ship this module's functions to the Python workers by value, so executors need
# only pandas/pyarrow, not this package on their path.
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(sys.modules[__name__])
except Exception:  # older cloudpickle: workers import the package instead
    pass


@F.pandas_udf(StringType())
def ascii_fold(s: pd.Series) -> pd.Series:
    """Compatibility decomposition (NFKD) with every non-ASCII code point dropped.

    Spark has no Unicode normalisation function, so this one step runs as an
    Arrow-batched pandas UDF; everything around it stays in the JVM.
    """

    def fold(v):
        if v is None:
            return None
        return unicodedata.normalize("NFKD", v).encode("ascii", "ignore").decode("ascii")

    return s.map(fold, na_action="ignore")


def safe_name(c: Column | str) -> Column:
    """ASCII-fold, then replace every character outside ``[A-Za-z0-9_.-]`` by ``_``."""
    c = _col(c)
    # Text of one-byte characters folds to itself: only the rest goes through Python (as NULL it costs nothing there).
    folded = F.coalesce(ascii_fold(F.when(F.octet_length(c) != F.length(c), c)), c)
    return F.translate(folded, _DISALLOWED_ASCII, SAFE_NAME_REPLACEMENT * len(_DISALLOWED_ASCII))
