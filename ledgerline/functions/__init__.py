"""Column expressions shared by the operators (all JVM-side except ``ascii_fold``)."""

from ledgerline.functions.keys import normalize_key
from ledgerline.functions.names import ascii_fold, last_path_component, safe_name
from ledgerline.functions.numeric import exact_sum, nan_to_null, round_half_away

__all__ = [
    "ascii_fold",
    "exact_sum",
    "last_path_component",
    "nan_to_null",
    "normalize_key",
    "round_half_away",
    "safe_name",
]
