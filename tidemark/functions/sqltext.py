"""SQL expression text for wide expressions.

A struct or predicate over many columns built with the Column API costs one
Py4J round trip per column reference, cast and alias (tens of milliseconds
for a ten-field struct); the same expression written as one SQL fragment and
handed to ``F.expr`` / ``selectExpr`` is parsed in the JVM in one call. The
plans are identical. Identifiers are always backtick-quoted and literals
escaped, so any column name or value is safe.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Sequence

from pyspark.sql.types import (ArrayType, DataType, DecimalType, MapType,
                               StructType)


def ident(*parts: str) -> str:
    """`a`.`b` with inner backticks doubled."""
    return ".".join("`" + p.replace("`", "``") + "`" for p in parts)


def string_lit(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def as_date(d: _dt.date | _dt.datetime | str) -> _dt.date:
    """A date from a date, a datetime (its date part) or ISO text."""
    if isinstance(d, _dt.datetime):
        return d.date()
    if isinstance(d, _dt.date):
        return d
    return _dt.date.fromisoformat(str(d).strip()[:10])


def date_lit(d: _dt.date | _dt.datetime | str) -> str:
    """DATE literal; the value is validated as an ISO date first."""
    return f"DATE'{as_date(d).isoformat()}'"


def timestamp_lit(ts: _dt.datetime | str) -> str:
    """A local-zone timestamp, parsed in the session time zone."""
    text = ts.isoformat(sep=" ") if isinstance(ts, _dt.datetime) else str(ts)
    _dt.datetime.fromisoformat(text)               # validate
    return f"CAST({string_lit(text)} AS TIMESTAMP)"


def type_sql(dt: DataType) -> str:
    """SQL text of a data type (nested field names quoted)."""
    if isinstance(dt, StructType):
        return "STRUCT<" + ", ".join(f"{ident(f.name)}: {type_sql(f.dataType)}"
                                     for f in dt.fields) + ">"
    if isinstance(dt, ArrayType):
        return f"ARRAY<{type_sql(dt.elementType)}>"
    if isinstance(dt, MapType):
        return f"MAP<{type_sql(dt.keyType)}, {type_sql(dt.valueType)}>"
    if isinstance(dt, DecimalType):
        return f"DECIMAL({dt.precision}, {dt.scale})"
    return dt.simpleString().upper()


def named_struct(fields: Iterable[tuple[str, str]]) -> str:
    """``named_struct('name', <expr>, ...)`` from (name, expression) pairs."""
    return "named_struct(" + ", ".join(f"{string_lit(n)}, {e}" for n, e in fields) + ")"


def null_safe_differs(pairs: Sequence[tuple[str, str]]) -> str:
    """True when any pair differs, NULL-safely (NULL vs 5 differs)."""
    if not pairs:
        return "false"
    return " OR ".join(f"NOT ({a} <=> {b})" for a, b in pairs)
