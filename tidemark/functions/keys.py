"""Key matching and row comparison as Spark column expressions.

Snapshots are matched on a *match key*: one column per natural-key part,
``trim(upper(part))`` for string parts (case- and outer-space-insensitive),
the raw value for any other type. Each part stays its own column, so
composite keys never collide the way a concatenation would, and the join /
window / shuffle all run on the same materialised columns (one hash
partitioning that later operators can reuse).

Value comparison is null-safe (``<=>``): a change to or from NULL is a change.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, MapType, StringType, StructType, ArrayType

MAX_KEYS = 32
# internal match-key columns, by exact name; a user column of such a name is an error
MATCH_KEYS = tuple(f"__tidemark_key_{i}" for i in range(MAX_KEYS))


def quote(name: str) -> str:
    """Backtick-quote a column name; inner backticks are doubled."""
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    """``F.col`` for any top-level name, including dots, spaces and backticks."""
    return F.col(quote(name))


def as_list(names: str | Iterable[str]) -> list[str]:
    if isinstance(names, str):
        return [n.strip() for n in names.split(",") if n.strip()]
    return list(names)


def resolve(df: DataFrame, name: str) -> str:
    """The schema name of ``name``: exact match first, then a unique
    case-insensitive one (Spark's default resolution)."""
    cols = df.columns
    if name in cols:
        return name
    hits = [c for c in cols if c.lower() == name.lower()]
    if len(hits) == 1:
        return hits[0]
    if not hits:
        raise ValueError(f"column {name!r} not found in {cols}")
    raise ValueError(f"column {name!r} is ambiguous in {cols}")


def field_type(df: DataFrame, name: str) -> DataType:
    return df.schema[resolve(df, name)].dataType


def match_key_names(n: int) -> list[str]:
    if n > MAX_KEYS:
        raise ValueError(f"at most {MAX_KEYS} key columns")
    return list(MATCH_KEYS[:n])


def reject_names(df: DataFrame, names: Iterable[str], why: str) -> None:
    """Raise if ``df`` has a column of one of ``names`` (any letter case)."""
    taken = {n.lower() for n in names}
    hits = [c for c in df.columns if c.lower() in taken]
    if hits:
        raise ValueError(f"columns {hits} {why}; rename them first")


def match_key_exprs(df: DataFrame, keys: Sequence[str],
                    normalize: bool = True) -> dict[str, Column]:
    out = {}
    for name, key in zip(match_key_names(len(keys)), keys):
        c = column(resolve(df, key))
        if normalize and isinstance(field_type(df, key), StringType):
            c = F.trim(F.upper(c))
        out[name] = c
    return out


def with_match_key(df: DataFrame, keys: Sequence[str],
                   normalize: bool = True) -> DataFrame:
    """Add the match-key columns (``MATCH_KEYS``)."""
    return df.withColumns(match_key_exprs(df, keys, normalize))


def any_null(names: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [column(n).isNull() for n in names])


def all_present(names: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [column(n).isNotNull() for n in names])


def differs(left: Sequence[Column], right: Sequence[Column]) -> Column:
    """True when any pair differs, NULL-safely (NULL vs 5 differs)."""
    if not left:
        return F.lit(False)
    return reduce(lambda a, b: a | b, [~l.eqNullSafe(r) for l, r in zip(left, right)])


def orderable(dt: DataType) -> bool:
    """Whether a type can appear in an ORDER BY (maps cannot)."""
    if isinstance(dt, MapType):
        return False
    if isinstance(dt, ArrayType):
        return orderable(dt.elementType)
    if isinstance(dt, StructType):
        return all(orderable(f.dataType) for f in dt.fields)
    return dt.typeName() != "variant"


def conform(df: DataFrame, like: DataFrame, fill: dict[str, Column] | None = None) -> DataFrame:
    """``df`` with exactly the columns (names, order, types) of ``like``:
    matched by name case-insensitively, missing ones NULL (or ``fill``)."""
    have = {c.lower(): c for c in df.columns}
    fill = fill or {}
    out = []
    for f in like.schema.fields:
        if f.name in fill:
            out.append(fill[f.name].cast(f.dataType).alias(f.name))
            continue
        real = have.get(f.name.lower())
        src = column(real) if real else F.lit(None)
        out.append(src.cast(f.dataType).alias(f.name))
    return df.select(*out)
