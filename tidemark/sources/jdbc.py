"""JDBC reads and writes for dimension tables held in a database.

Reads are split into ``num_partitions`` range queries on a numeric, date or
timestamp column so the table is read by many tasks in parallel, not one.
When bounds are not given they are fetched with one ``min/max`` query that
the database answers (one row reaches the driver). Filters and column
selections on the returned DataFrame are pushed into the database query.

Writes are batched inserts from every task. ``overwrite`` keeps the table's
DDL (``truncate``) - callers must write from a *staged* copy, never from a
plan that still reads the same table (the truncate would run first). Or a batch
goes to a staging table, and one transaction moves it (``run_once``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _options(url: str, properties: dict | None) -> dict:
    opts = {"url": url}
    opts.update({k: str(v) for k, v in (properties or {}).items()})
    return opts


def _resolve_column(spark: SparkSession, url: str, table: str, column: str,
                    properties: dict | None) -> str:
    """The table's own spelling of ``column`` (matched case-insensitively,
    as Spark matches ``partitionColumn``); only the schema is fetched."""
    names = (spark.read.format("jdbc").options(**_options(url, properties))
             .option("dbtable", table).load().columns)
    hits = [n for n in names if n == column] or [n for n in names if n.lower() == column.lower()]
    if not hits:
        raise ValueError(f"column {column!r} not in {table}: {names}")
    return hits[0]


def jdbc_bounds(spark: SparkSession, url: str, table: str, column: str,
                properties: dict | None = None) -> tuple:
    """(min, max) of ``column``, computed by the database; the name is
    quoted with Spark's dialect for ``url``."""
    real = _resolve_column(spark, url, table, column, properties)
    quoted = _quoted(spark, url, real)
    q = f"SELECT MIN({quoted}) AS lo, MAX({quoted}) AS hi FROM {table}"
    row = (spark.read.format("jdbc").options(**_options(url, properties))
           .option("query", q).load().first())
    return row[0], row[1]


def _quoted(spark: SparkSession, url: str, name: str) -> str:
    return spark.sparkContext._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url).quoteIdentifier(name)


def bucket_predicates(spark: SparkSession, url: str, table: str, column: str, n: int,
                      properties: dict | None = None) -> list[str]:
    """``n`` conditions that every row meets exactly one of: the remainder of
    the absolute value, NULLs in the first."""
    c = _quoted(spark, url, _resolve_column(spark, url, table, column, properties))
    out = [f"MOD(ABS({c}), {n}) = {i}" for i in range(n)]
    return [f"({out[0]} OR {c} IS NULL)", *out[1:]]


def jdbc_count(spark: SparkSession, url: str, table: str, properties: dict | None = None) -> int:
    """Rows of ``table``, counted by the database."""
    return int(spark.read.format("jdbc").options(**_options(url, properties))
               .option("query", f"SELECT COUNT(*) AS n FROM {table}").load().first()[0])


def read_jdbc(spark: SparkSession, url: str, table: str, *, properties: dict | None = None,
              partition_column: str | None = None, lower_bound=None, upper_bound=None,
              num_partitions: int | None = None, fetch_size: int = 10000,
              predicates: list[str] | None = None, bucket_column: str | None = None,
              histogram_column: str | None = None, single_task: bool = False) -> DataFrame:
    """A database table as a DataFrame, read in parallel: by equal-width ranges
    of ``partition_column``, or, when its values are skewed, by ranges of the
    whole-number ``histogram_column`` with about equally many rows each
    (``histogram_predicates``), or by ``num_partitions`` remainders of the whole-number ``bucket_column`` (complete for negative and
    NULL values, see ``bucket_predicates``), or by ``predicates`` of the caller,
    which must be disjoint and complete. Reading through one task must be asked
    for with ``single_task``."""
    if histogram_column:
        predicates = histogram_predicates(spark, url, table, histogram_column,
                                          num_partitions or spark.sparkContext.defaultParallelism, properties)
    if bucket_column:
        predicates = bucket_predicates(spark, url, table, bucket_column,
                                       num_partitions or spark.sparkContext.defaultParallelism,
                                       properties)
    if not (predicates or partition_column or single_task):
        raise ValueError(f"name a split of {table} (partition_column, histogram_column, bucket_column or predicates), "
                         "or pass single_task=True")
    if predicates:
        props = {k: str(v) for k, v in (properties or {}).items()}
        props["fetchsize"] = str(fetch_size)
        return spark.read.jdbc(url, table, predicates=list(predicates), properties=props)
    reader = (spark.read.format("jdbc").options(**_options(url, properties))
              .option("dbtable", table).option("fetchsize", str(fetch_size)))
    if partition_column:
        if lower_bound is None or upper_bound is None:
            lower_bound, upper_bound = jdbc_bounds(spark, url, table, partition_column, properties)
        if lower_bound is None:          # empty table: nothing to split
            return reader.load()
        n = num_partitions or spark.sparkContext.defaultParallelism
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", str(lower_bound))
                  .option("upperBound", str(upper_bound))
                  .option("numPartitions", str(n)))
    return reader.load()


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", *,
               properties: dict | None = None, batch_size: int = 10000,
               num_partitions: int | None = None, truncate: bool = True,
               column_types: str | None = None) -> None:
    """Insert ``df`` into ``table``; ``mode`` is ``append`` or ``overwrite``
    (truncate and insert, DDL kept; without ``truncate`` the table is made anew,
    with ``column_types`` where Spark's own don't fit). ``num_partitions`` caps
    concurrent connections."""
    if mode not in ("append", "overwrite"):
        raise ValueError("mode must be 'append' or 'overwrite'")
    w = (df.write.format("jdbc").options(**_options(url, properties))
         .option("dbtable", table).option("batchsize", str(batch_size)))
    if num_partitions:
        w = w.option("numPartitions", str(num_partitions))
    if column_types:
        w = w.option("createTableColumnTypes", column_types)
    if mode == "overwrite":
        w = w.option("truncate", "true" if truncate else "false")
    w.mode(mode).save()


def histogram_predicates(spark: SparkSession, url: str, table: str, column: str, n: int,
                         properties: dict | None = None, bins_per_split: int = 16) -> list[str]:
    """About ``n`` ranges of a whole-number column with about equally many rows,
    disjoint and complete, NULLs in the first. The database counts the rows of
    equal-width bins; a bin that holds more than half a split's share is counted
    again in finer bins, down to single values. A value with more rows than a
    split's share gets a range of its own. Only bins reach the driver."""
    c = _quoted(spark, url, _resolve_column(spark, url, table, column, properties))

    def counted(lo: int, hi: int) -> list[tuple[int, int, int]]:
        """(first, last, rows) of the non-empty bins of lo..hi."""
        width = max(1, -(-(hi - lo + 1) // (n * bins_per_split)))
        q = (f"SELECT b, COUNT(*) AS n FROM (SELECT FLOOR(({c} - ({lo})) / {width}) AS b FROM {table} "
             f"WHERE {c} BETWEEN {lo} AND {hi}) x GROUP BY b")
        rows = spark.read.format("jdbc").options(**_options(url, properties)).option("query", q).load().collect()
        return sorted((lo + int(r[0]) * width, min(hi, lo + (int(r[0]) + 1) * width - 1), int(r[1])) for r in rows)

    lo, hi = jdbc_bounds(spark, url, table, column, properties)
    if lo is None:
        return [f"{c} IS NULL"]
    bins = counted(int(lo), int(hi))
    share = max(1, -(-sum(b[2] for b in bins) // n))
    while heavy := [b for b in bins if b[2] > share / 2 and b[1] > b[0]]:
        fine = [f for b in heavy for f in counted(b[0], b[1])]         # at most 2 * n bins are heavy
        bins = sorted([b for b in bins if b not in heavy] + fine)
    starts, held = [], 0
    for first, _, rows in bins:
        if not starts or held + rows > share:
            starts.append(first)
            held = 0
        held += rows
    edges = [(None if i == 0 else s, starts[i + 1] if i + 1 < len(starts) else None)
             for i, s in enumerate(starts)]
    out = [" AND ".join([f"{c} >= {a}"] * (a is not None) + [f"{c} < {b}"] * (b is not None)) or f"{c} IS NOT NULL"
           for a, b in edges]
    return [f"({out[0]} OR {c} IS NULL)", *out[1:]]


def _connect(spark: SparkSession, url: str, properties: dict | None):
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    props = jvm.java.util.Properties()
    for k, v in (properties or {}).items():
        props.setProperty(k, str(v))
    name = (properties or {}).get("driver")
    if not name:
        return jvm.java.sql.DriverManager.getConnection(url, props)
    loader = jvm.java.lang.Thread.currentThread().getContextClassLoader()
    driver = (jvm.java.lang.Class.forName(name, True, loader)
              .getDeclaredConstructor(gateway.new_array(jvm.java.lang.Class, 0))
              .newInstance(gateway.new_array(jvm.java.lang.Object, 0)))
    return driver.connect(url, props)


def run_once(spark: SparkSession, url: str, run: str, statements: list[tuple[str, list]],
             properties: dict | None = None, marks: str = "TIDEMARK_LOADS") -> bool:
    """Execute ``statements`` (SQL, parameters) in one transaction of the
    database, together with a row in ``marks`` that names ``run``; False, and
    nothing done, if that row is there already. A failure rolls back all."""
    jvm = spark.sparkContext._jvm
    con = _connect(spark, url, properties)
    try:
        con.setAutoCommit(True)
        tables = con.getMetaData().getTables(None, None, marks, None)
        if not tables.next():
            con.createStatement().executeUpdate(f"CREATE TABLE {marks} (RUN VARCHAR(64) NOT NULL PRIMARY KEY)")
        con.setAutoCommit(False)

        def prepared(sql: str, params: list):
            ps = con.prepareStatement(sql)
            for i, v in enumerate(params, 1):
                if hasattr(v, "isoformat"):
                    ps.setDate(i, jvm.java.sql.Date.valueOf(v.isoformat()))
                else:
                    ps.setString(i, v)
            return ps
        if prepared(f"SELECT 1 FROM {marks} WHERE RUN = ?", [run]).executeQuery().next():
            con.rollback()
            return False
        for sql, params in statements:
            prepared(sql, params).executeUpdate()
        prepared(f"INSERT INTO {marks} VALUES (?)", [run]).executeUpdate()
        con.commit()
        return True
    except Exception:
        con.rollback()
        raise
    finally:
        con.close()


def move_statements(spark: SparkSession, kind: int, url: str, stage: str, target: str, keys: list[str],
                    columns: list[str], string_keys: set[str], change: str, flag: str, expiry: str,
                    as_of, latest: int, expired: int) -> list[tuple[str, list]]:
    """The statements that bring the new and changed rows of ``stage`` into
    ``target``; ``string_keys`` are matched as ``TRIM(UPPER())``."""
    q = lambda c: _quoted(spark, url, c)
    norm = lambda t, k: f"TRIM(UPPER({t}.{q(k)}))" if k in string_keys else f"{t}.{q(k)}"
    match = " AND ".join(f"{norm(stage, k)} = {norm(target, k)}" for k in keys)
    names = ", ".join(q(c) for c in columns)
    insert = f"INSERT INTO {target} ({names}) SELECT {names} FROM {stage}"
    if kind == 0:
        return [(f"{insert} WHERE NOT EXISTS (SELECT 1 FROM {target} WHERE {match})", [])]
    there = f"EXISTS (SELECT 1 FROM {stage} WHERE {match} AND {stage}.{q(change)} = 'U')"
    if kind == 1:
        return [(f"DELETE FROM {target} WHERE {there}", []), (insert, [])]
    return [(f"UPDATE {target} SET {q(flag)} = {expired}, {q(expiry)} = ? "
             f"WHERE {q(flag)} = {latest} AND {there}", [as_of]), (insert, [])]
