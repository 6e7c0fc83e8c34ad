"""Snapshot pairs derived from the driver's tables, for the registered
queries, the tests and the benchmark.

A snapshot pair is two full extracts of one table taken on two days: the
"current" one (what the target holds) and the "prep" one (the new extract).
Both are computed by Spark from the *whole* table; the residues of the key
only decide which rows were inserted, deleted or changed between the two
days - every row of the table is in at least one snapshot, so the work grows
with the table. The same rules are written as SQL in ``plans.oracle_sql`` for
the DuckDB twins.

Customer pair (key: the name, matched case- and space-insensitively):
``k % 10 = 3`` new, ``k % 10 = 7`` gone, ``k % 5 = 0`` new balance,
``k % 4 = 0`` name lower-cased and padded (same key after normalising).
Orders pair (key: the order key): same residues for new/gone,
``k % 5 = 0`` price + 1, ``k % 4 = 0`` priority lower-cased.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C

# --- fixed values: fixture dates ------------------------------------------
CURRENT_DAY = "2024-05-01"          # day the current snapshot was loaded
AS_OF = "2024-06-01"                # day of the new snapshot
LOAD_TS_CURRENT = "2024-05-01 00:00:00"
LOAD_TS_AS_OF = "2024-06-01 00:00:00"
LOAD_TS_RERUN = "2024-06-01 12:00:00"
HISTORY_BEGIN, HISTORY_END = "2020-01-01", "2020-12-31"
HISTORY_TS = "2020-01-01 00:00:00"
SCD2_OLD_EXPIRY = "2024-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def row_md5(*cols: str) -> Column:
    return F.md5(F.concat_ws("||", *[F.col(c).cast("string") for c in cols]))


MD5_SQL = "md5(concat_ws('||', cast(bal as string), seg))"


def stamped(df: DataFrame, flag: str, bgn: str, end: str, ts: str) -> DataFrame:
    return df.selectExpr("*", f"'{flag}' AS audit_flag", f"DATE'{bgn}' AS bgn_dt",
                         f"DATE'{end}' AS end_dt", f"CAST('{ts}' AS TIMESTAMP) AS audit_inserted_ts")


# The rules below are written as SQL text, the same text as the DuckDB twins
# in plans.oracle_sql (one parse each instead of many Column-API calls).

# ---------------------------------------------------------------- customer

def customer_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS k", "c_name AS nm", "c_acctbal AS bal", "c_mktsegment AS seg")


def customer_fingerprinted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole table as one snapshot, with its fingerprint."""
    return customer_base(spark, sf_dir).selectExpr("*", f"{MD5_SQL} AS {C.FINGERPRINT_COLUMN}")


def customer_cur0(spark, sf_dir) -> DataFrame:
    return customer_base(spark, sf_dir).where("k % 10 <> 3")


def customer_prep0(spark, sf_dir) -> DataFrame:
    return customer_base(spark, sf_dir).where("k % 10 <> 7").selectExpr(
        "k",
        "CASE WHEN k % 4 = 0 THEN concat('  ', lower(nm), ' ') ELSE nm END AS nm",
        "CASE WHEN k % 5 = 0 THEN bal + 100 ELSE bal END AS bal",
        "seg")


def customer_prep(spark, sf_dir) -> DataFrame:
    """The new snapshot, with its fingerprint over bal and seg."""
    return customer_prep0(spark, sf_dir).selectExpr("*", f"{MD5_SQL} AS {C.FINGERPRINT_COLUMN}")


def customer_prep_rerun(spark, sf_dir) -> DataFrame:
    """A second snapshot of the same day: ``k % 3 = 0`` balance + 1 more."""
    p = customer_prep0(spark, sf_dir).selectExpr(
        "k", "nm", "CASE WHEN k % 3 = 0 THEN bal + 1 ELSE bal END AS bal", "seg")
    return p.selectExpr("*", f"{MD5_SQL} AS {C.FINGERPRINT_COLUMN}")


def customer_current(spark, sf_dir) -> DataFrame:
    """The current partition as loaded on CURRENT_DAY."""
    cur = customer_cur0(spark, sf_dir).selectExpr("*", f"{MD5_SQL} AS {C.FINGERPRINT_COLUMN}")
    return stamped(cur, C.INSERTED, CURRENT_DAY, C.OPEN_END.isoformat(), LOAD_TS_CURRENT)


def customer_history(spark, sf_dir) -> DataFrame:
    """Prior history: ``k % 10 = 1`` rows with an older balance, closed 2020."""
    h = (customer_base(spark, sf_dir).where("k % 10 = 1")
         .selectExpr("k", "nm", "bal - 50 AS bal", "seg"))
    h = h.selectExpr("*", f"{MD5_SQL} AS {C.FINGERPRINT_COLUMN}")
    return stamped(h, C.INSERTED, HISTORY_BEGIN, HISTORY_END, HISTORY_TS)


def customer_scd1_source(spark, sf_dir) -> DataFrame:
    """prep with NULL segments where ``k % 7 = 0``."""
    return customer_prep0(spark, sf_dir).selectExpr(
        "k", "nm", "bal", "CASE WHEN k % 7 = 0 THEN NULL ELSE seg END AS seg")


def customer_scd1_target(spark, sf_dir) -> DataFrame:
    """current with NULL segments where ``k % 11 = 0``."""
    return customer_cur0(spark, sf_dir).selectExpr(
        "k", "nm", "bal", "CASE WHEN k % 11 = 0 THEN NULL ELSE seg END AS seg")


def customer_scd2_target(spark, sf_dir) -> DataFrame:
    """current rows as ``flag = 1`` plus older ``flag = 0`` versions for
    ``k % 10 = 1`` (expired 2024-01-01, balance - 50)."""
    cur = customer_cur0(spark, sf_dir).selectExpr(
        "*", f"{C.LATEST} AS {C.SCD2_FLAG}", f"CAST(NULL AS DATE) AS {C.SCD2_EXPIRY}")
    old = customer_base(spark, sf_dir).where("k % 10 = 1").selectExpr(
        "k", "nm", "bal - 50 AS bal", "seg", f"{C.EXPIRED} AS {C.SCD2_FLAG}",
        f"DATE'{SCD2_OLD_EXPIRY}' AS {C.SCD2_EXPIRY}")
    return cur.unionByName(old)


# ------------------------------------------------------------------ orders

ORDER_VALUES = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def orders_base(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr("o_orderkey AS k", *ORDER_VALUES)


def orders_cur0(spark, sf_dir) -> DataFrame:
    return orders_base(spark, sf_dir).where("k % 10 <> 3")


def orders_prep0(spark, sf_dir) -> DataFrame:
    return orders_base(spark, sf_dir).where("k % 10 <> 7").selectExpr(
        "k", "o_custkey", "o_orderstatus",
        "CASE WHEN k % 5 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice",
        "o_orderdate",
        "CASE WHEN k % 4 = 0 THEN lower(o_orderpriority) ELSE o_orderpriority END AS o_orderpriority")


def orders_current(spark, sf_dir) -> DataFrame:
    return stamped(orders_cur0(spark, sf_dir), C.INSERTED, CURRENT_DAY,
                   C.OPEN_END.isoformat(), LOAD_TS_CURRENT)


def orders_scd2_target(spark, sf_dir) -> DataFrame:
    return orders_cur0(spark, sf_dir).selectExpr(
        "*", f"{C.LATEST} AS {C.SCD2_FLAG}", f"CAST(NULL AS DATE) AS {C.SCD2_EXPIRY}")
