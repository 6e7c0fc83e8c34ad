"""Normal forms for string values and column names.

``normalize_strings`` is one projection of built-in functions (JVM side,
whole-stage codegen); ``normalize_column_names`` is one positional rename.
The name rule runs in Python on the driver over the *schema* only - never
over rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .keys import as_list, resolve
from .sqltext import ident


def normal_string_sql(expr: str) -> str:
    """Underscores to spaces, then initcap, then trim, then '' to NULL, as SQL
    text over ``expr``. initcap lower-cases the rest of each space-separated
    word; trim removes outer U+0020 only; inner runs of spaces stay."""
    return f"nullif(trim(initcap(regexp_replace({expr}, '_', ' '))), '')"


def normalize_strings(df: DataFrame, string_columns: str | Iterable[str]) -> DataFrame:
    """Normalise the values of the given columns in one projection (one SQL
    expression per column). A non-string column is cast to string first."""
    types = {f.name: f.dataType for f in df.schema.fields}
    exprs = {}
    for name in as_list(string_columns):
        real = resolve(df, name)
        src = ident(real) if isinstance(types[real], StringType) else f"CAST({ident(real)} AS STRING)"
        exprs[real] = F.expr(normal_string_sql(src))
    return df.withColumns(exprs) if exprs else df


def normalize_column_name(name: str) -> str:
    """snake_case form of one column name (pure Python, driver side): words
    begin where an ASCII capital follows a small letter, each run of anything
    but ASCII letters and digits becomes one underscore, and one at the end is
    dropped. Digits do not begin a word; a leading underscore stays."""
    words = re.sub("([a-z])([A-Z])", r"\1_\2", name.strip())
    return re.sub(r"[\W_]+", "_", words, flags=re.ASCII).removesuffix("_").lower()


def normalize_column_names(df: DataFrame) -> DataFrame:
    """Rename every top-level column by ``normalize_column_name``, keeping
    order. Raises if a name normalises to nothing or two names collide."""
    new = [normalize_column_name(c) for c in df.columns]
    empty = [old for old, n in zip(df.columns, new) if not n]
    if empty:
        raise ValueError(f"column names normalise to an empty name: {empty}")
    seen: dict[str, str] = {}
    for old, n in zip(df.columns, new):
        if n in seen:
            raise ValueError(
                f"columns {seen[n]!r} and {old!r} both normalise to {n!r}")
        seen[n] = old
    return df.toDF(*new)
