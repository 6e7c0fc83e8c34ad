"""Bulk casts: any column to string, date text to date.

Both are a single ``withColumns`` projection of built-in expressions.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

from .keys import as_list, resolve
from .sqltext import ident, string_lit

ON_ERROR = ("null", "raise")


def cast_to_string(df: DataFrame, columns: str | Iterable[str]) -> DataFrame:
    """Cast the given columns to string (arrays, maps and structs render the
    way Spark prints them; NULL stays NULL)."""
    names = [resolve(df, c) for c in as_list(columns)]
    exprs = {n: F.expr(f"CAST({ident(n)} AS STRING)") for n in names}
    return df.withColumns(exprs) if exprs else df


def cast_to_date(df: DataFrame, columns: str | Iterable[str], date_format: str,
                 on_error: str = "null") -> DataFrame:
    """Parse the given text columns to dates with a Spark datetime pattern
    such as ``MM-dd-yyyy``.

    Date and timestamp columns are cast, so a second call changes nothing.

    ``on_error="null"``: text that does not match gives NULL, whatever the
    session's ANSI setting. ``on_error="raise"``: the first non-NULL text that
    does not parse fails the job, again independent of the ANSI setting.
    """
    if on_error not in ON_ERROR:
        raise ValueError(f"on_error must be one of {ON_ERROR}")
    fmt = string_lit(date_format)
    exprs = {}
    for name in as_list(columns):
        real = resolve(df, name)
        if isinstance(df.schema[real].dataType, (DateType, TimestampType, TimestampNTZType)):
            exprs[real] = F.expr(f"CAST({ident(real)} AS DATE)")     # nothing to parse
            continue
        src = f"CAST({ident(real)} AS STRING)"
        parsed = f"try_to_date({src}, {fmt})"
        if on_error == "raise":
            msg = string_lit(f"cannot parse {real} with {date_format}: ")
            parsed = (f"CASE WHEN {src} IS NOT NULL AND {parsed} IS NULL "
                      f"THEN CAST(raise_error(concat({msg}, {src})) AS DATE) ELSE {parsed} END")
        exprs[real] = F.expr(parsed)
    return df.withColumns(exprs) if exprs else df
