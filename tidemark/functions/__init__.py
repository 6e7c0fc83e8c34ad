"""Column-level functions: key matching, string clean-up, bulk casts."""

from .casts import cast_to_date, cast_to_string
from .cleaning import normalize_column_name, normalize_column_names, normalize_strings
from .keys import column, differs, match_key_names, quote, with_match_key

__all__ = [
    "cast_to_date", "cast_to_string", "normalize_column_name", "normalize_column_names",
    "normalize_strings", "column", "differs", "match_key_names", "quote", "with_match_key",
]
