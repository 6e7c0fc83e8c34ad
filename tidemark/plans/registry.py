"""Registered queries: one per operator of the survey, each a function
``(spark, sf_dir) -> DataFrame`` over the driver's tables. Their DuckDB twins
are in ``plans.oracle_sql``.

Every query reads whole tables; the snapshot pairs are derived from them
(``sources.derived``). Timestamp outputs are rendered as text, as in the
twins.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from .. import config as C
from ..functions.casts import cast_to_date, cast_to_string
from ..functions.cleaning import normalize_column_names, normalize_strings
from ..operators import checks, scd
from ..operators import snapshot_diff as sd
from ..operators.dedupe import dedupe
from ..operators.digest_diff import digest_next_state
from ..session import ensure_checkpoint_root, scratch_folder
from ..sources import derived as X
from .cdc_job import run_cdc
from .cow_job import read_cow, run_scd1_cow
from .manifest_backup import backup_version, restore_version
from .scd_job import read_scd2_parquet, run_scd_parquet
from .versioned_job import run_cdc_versioned

Query = Callable[[SparkSession, str], DataFrame]

STAMPS = sd.Stamps(X.AS_OF, X.LOAD_TS_AS_OF)
CUST_KEY = ["nm"]


def ts_text(df: DataFrame) -> DataFrame:
    """Render local-zone timestamp columns as text (``yyyy-MM-dd HH:mm:ss``)."""
    conv = {f.name: F.col(f.name).cast("string") for f in df.schema.fields
            if isinstance(f.dataType, TimestampType)}
    return df.withColumns(conv) if conv else df


# ------------------------------------------------------------------ checks

def q_filtered_rows(spark, d):
    return checks.filtered_rows(X.table(spark, d, "orders"), "o_orderstatus = 'F'")


def q_row_count(spark, d):
    return checks.row_count(X.table(spark, d, "lineitem"))


def q_row_count_filtered(spark, d):
    return checks.row_count(X.table(spark, d, "orders"), F.col("o_orderstatus") == "F")


def q_duplicate_groups_single(spark, d):
    return checks.duplicate_groups(X.table(spark, d, "documents"), ["text"])


def q_duplicate_groups_composite(spark, d):
    return checks.duplicate_groups(X.table(spark, d, "events"), ["user_id", "event_type"])


def q_duplicate_groups_lineitem(spark, d):
    return checks.duplicate_groups(X.table(spark, d, "lineitem"), "l_partkey, l_suppkey")


def _view(spark, d, name: str) -> str:
    """The driver table as a session view, for the by-name checks."""
    view = f"tidemark_{name}"
    X.table(spark, d, name).createOrReplaceTempView(view)
    return view


def q_count_check_catalog(spark, d):
    """Rows of a catalog table by name with a SQL filter string."""
    return checks.count_check(spark, _view(spark, d, "orders"), "o_orderstatus = 'F'")


def q_count_value_catalog(spark, d):
    return checks.count_value(spark, _view(spark, d, "lineitem"), "l_returnflag = 'R'")


def q_duplicate_check_catalog(spark, d):
    """Duplicate key groups of a catalog table, keys as a comma-joined string."""
    return checks.duplicate_check(spark, _view(spark, d, "events"), "user_id, event_type",
                                  "value > 10")


def q_dedupe_snapshot(spark, d):
    docs = X.table(spark, d, "documents")
    return dedupe(docs.where(F.col("text").isNotNull()), ["text"], order_by=["doc_id"])


def q_dedupe_hot_keys(spark, d):
    """Hot keys on real data: each return flag holds about a third of all
    lineitem rows. The partial group limit leaves each map task with one
    row per flag before the shuffle."""
    li = X.table(spark, d, "lineitem")
    return dedupe(li, ["l_returnflag"], order_by=["l_orderkey", "l_linenumber"])


def q_duplicate_groups_hot(spark, d):
    """Few, very large groups (flag x status): partial counts before the shuffle."""
    return checks.duplicate_groups(X.table(spark, d, "lineitem"), ["l_returnflag", "l_linestatus"])


# ------------------------------------------------------ CDC, customer pair

def _cust(spark, d):
    prep = sd.prepare_snapshot(X.customer_prep(spark, d), CUST_KEY)
    return prep, X.customer_current(spark, d)


def q_cdc_flags(spark, d):
    prep, cur = _cust(spark, d)
    return sd.diff_flags(prep, cur, CUST_KEY)


def q_cdc_classify(spark, d):
    prep, cur = _cust(spark, d)
    return sd.classify(prep, cur, CUST_KEY)


def q_cdc_deleted(spark, d):
    return sd.deleted(X.customer_prep(spark, d), X.customer_current(spark, d), CUST_KEY)


def q_cdc_new_versions(spark, d):
    """C8 on its own: classify, then stamp the I and U rows as new versions."""
    prep, cur = _cust(spark, d)
    return ts_text(sd.new_versions(sd.classify(prep, cur, CUST_KEY), STAMPS))


def q_cdc_rejected(spark, d):
    """Snapshot rows whose key is NULL (names blanked where ``k % 13 = 0``)
    are set apart; returns them."""
    prep = X.customer_fingerprinted(spark, d).selectExpr(
        "k", "CASE WHEN k % 13 = 0 THEN NULL ELSE nm END AS nm", "bal", "seg", "row_md5")
    return sd.split_rejected(prep, CUST_KEY)[1]


def q_cdc_initial_load(spark, d):
    prep = sd.prepare_snapshot(X.customer_fingerprinted(spark, d), CUST_KEY)
    return ts_text(sd.initial_load(prep, STAMPS))


def q_cdc_closed_history(spark, d):
    prep, cur = _cust(spark, d)
    return ts_text(sd.close_history(prep, cur, CUST_KEY, STAMPS))


def q_cdc_current(spark, d):
    prep, cur = _cust(spark, d)
    return ts_text(sd.rebuild_current(prep, cur, CUST_KEY, STAMPS))


def q_cdc_next_state(spark, d):
    prep, cur = _cust(spark, d)
    return ts_text(sd.next_state(prep, cur, CUST_KEY, STAMPS))


def q_cdc_full_table(spark, d):
    target = X.customer_history(spark, d).unionByName(X.customer_current(spark, d))
    return ts_text(sd.full_table(target, X.customer_prep(spark, d), CUST_KEY, STAMPS))


def q_inverted_intervals(spark, d):
    """Rows closed before they began: two changed snapshots on one day (in
    memory), then the interval check over the resulting rows."""
    prep, cur = _cust(spark, d)
    first = sd.next_state(prep, cur, CUST_KEY, STAMPS)
    open_rows = first.where(F.col("end_dt") == F.lit(C.OPEN_END.isoformat()).cast("date"))
    rerun = sd.prepare_snapshot(X.customer_prep_rerun(spark, d), CUST_KEY)
    second = sd.next_state(rerun, open_rows, CUST_KEY, sd.Stamps(X.AS_OF, X.LOAD_TS_RERUN))
    return ts_text(checks.inverted_intervals(second))


def q_cdc_publish_roundtrip(spark, d):
    """The whole job on disk: initial load, a changed snapshot, and a second
    changed snapshot on the same day, registered in a catalog database
    (located under the shared scratch folder); returns the table read back
    through the catalog."""
    ensure_checkpoint_root(spark)
    root = scratch_folder(spark, "cdc-roundtrip")
    db = "tidemark_rt_" + root.rsplit("-", 1)[-1]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{root}/_catalog'")
    first = X.customer_cur0(spark, d).withColumn(C.FINGERPRINT_COLUMN, X.row_md5("bal", "seg"))
    run_cdc(spark, "customer", CUST_KEY, root, database=db, as_of=X.CURRENT_DAY,
            load_ts=X.LOAD_TS_CURRENT, prep=first)
    run_cdc(spark, "customer", CUST_KEY, root, database=db, as_of=X.AS_OF,
            load_ts=X.LOAD_TS_AS_OF, prep=X.customer_prep(spark, d))
    run_cdc(spark, "customer", CUST_KEY, root, database=db, as_of=X.AS_OF,
            load_ts=X.LOAD_TS_RERUN, prep=X.customer_prep_rerun(spark, d))
    return ts_text(spark.table(f"{db}.customer"))


def _versioned_loads(spark, d, buckets: int | None = None, undo: bool = False) -> DataFrame:
    """The same three loads by the versioned job; the view it shows. ``undo``: a wrong
    extract comes before the last one, and the backup made before it is restored."""
    ensure_checkpoint_root(spark)
    root = scratch_folder(spark, "cdc-versions")
    db = "tidemark_av_" + root.rsplit("-", 1)[-1]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{root}/_catalog'")
    load = lambda prep, as_of, ts: run_cdc_versioned(spark, "customer", CUST_KEY, root, db, as_of=as_of,
                                                     load_ts=ts, prep=prep, buckets=buckets)
    load(X.customer_cur0(spark, d).withColumn(C.FINGERPRINT_COLUMN, X.row_md5("bal", "seg")),
         X.CURRENT_DAY, X.LOAD_TS_CURRENT)
    load(X.customer_prep(spark, d), X.AS_OF, X.LOAD_TS_AS_OF)
    if undo:
        backup = backup_version(spark, "customer", root, db)
        load(X.customer_cur0(spark, d).withColumn(C.FINGERPRINT_COLUMN, F.lit("wrong")), X.AS_OF, X.LOAD_TS_RERUN)
        restore_version(spark, "customer", root, db, backup["version"])
    load(X.customer_prep_rerun(spark, d), X.AS_OF, X.LOAD_TS_RERUN)
    return ts_text(spark.table(f"{db}.customer"))


def q_cdc_atomic_publish(spark, d):
    """Each load is shown by one step of the view."""
    return _versioned_loads(spark, d)


def q_cdc_bucketed_current(spark, d):
    """Each load's join reads the open rows in place, bucketed on the match key."""
    return _versioned_loads(spark, d, buckets=8)


def q_cdc_manifest_restore(spark, d):
    """A wrong load undone from a backup that lists files instead of copying them."""
    return _versioned_loads(spark, d, undo=True)


# ------------------------------------------------------ SCD, customer pair

def _empty_like(spark, df: DataFrame) -> DataFrame:
    return spark.createDataFrame([], df.schema)


def q_scd0_initial(spark, d):
    src = X.customer_base(spark, d)
    return scd.scd0(src, _empty_like(spark, src), ["k"])


def q_scd0_delta(spark, d):
    return scd.scd0(X.customer_prep0(spark, d), X.customer_cur0(spark, d), ["k"])


def q_scd1_upsert(spark, d):
    return scd.scd1(X.customer_scd1_source(spark, d), X.customer_scd1_target(spark, d), ["k"],
                    compare=["bal", "seg"])


def q_scd2_initial(spark, d):
    src = X.customer_base(spark, d)
    empty = _empty_like(spark, X.customer_scd2_target(spark, d))
    return scd.scd2(src, empty, ["k"], STAMPS, compare=["bal", "seg"])


def q_scd2_delta(spark, d):
    return scd.scd2(X.customer_prep0(spark, d), X.customer_scd2_target(spark, d), ["k"], STAMPS,
                    compare=["bal", "seg"])


def _two_loads(spark, d, kind: int) -> str:
    """Both customer snapshots loaded one after the other into Parquet."""
    ensure_checkpoint_root(spark)
    path = scratch_folder(spark, f"scd{kind}-target")
    kw = {} if kind == 0 else {"compare": ["bal", "seg"]}
    run_scd_parquet(spark, kind, X.customer_cur0(spark, d), path, ["k"], as_of=X.CURRENT_DAY, **kw)
    run_scd_parquet(spark, kind, X.customer_prep0(spark, d), path, ["k"], as_of=X.AS_OF, **kw)
    return path


def q_scd0_publish(spark, d):
    return spark.read.parquet(_two_loads(spark, d, 0))


def q_scd1_publish(spark, d):
    return spark.read.parquet(_two_loads(spark, d, 1))


def q_scd1_copy_on_write(spark, d):
    """Both customer snapshots, the second rewriting only files with changed rows."""
    ensure_checkpoint_root(spark)
    path = scratch_folder(spark, "scd1-cow")
    for snapshot in (X.customer_cur0(spark, d), X.customer_prep0(spark, d)):
        run_scd1_cow(spark, snapshot, path, ["k"], compare=["bal", "seg"], rows_per_file=1000)
    return read_cow(spark, path).drop(scd.CHANGE)


def q_scd2_publish(spark, d):
    return read_scd2_parquet(spark, _two_loads(spark, d, 2))


# -------------------------------------------------------------- orders pair

def q_cdc_orders_next_state(spark, d):
    prep = sd.prepare_snapshot(X.orders_prep0(spark, d), ["k"])
    return ts_text(sd.next_state(prep, X.orders_current(spark, d), ["k"], STAMPS))


def q_cdc_digest_diff(spark, d):
    """The same state through digests. The pair's changes lie everywhere, so buckets
    of three keys, of which some are equal; real ones hold thousands."""
    ensure_checkpoint_root(spark)
    return ts_text(digest_next_state(X.orders_prep0(spark, d), X.orders_current(spark, d), ["k"], STAMPS,
                                     bucket="k div 3"))


def q_scd0_orders(spark, d):
    return scd.scd0(X.orders_prep0(spark, d), X.orders_cur0(spark, d), ["k"])


def q_scd1_orders(spark, d):
    return scd.scd1(X.orders_prep0(spark, d), X.orders_cur0(spark, d), ["k"])


def q_scd2_orders(spark, d):
    return scd.scd2(X.orders_prep0(spark, d), X.orders_scd2_target(spark, d), ["k"], STAMPS)


# ---------------------------------------------------------- cleaning, casts

def q_normalize_strings_nation(spark, d):
    return normalize_strings(X.table(spark, d, "nation"), ["n_name"])


def q_normalize_strings_part(spark, d):
    return normalize_strings(X.table(spark, d, "part"), ["p_name", "p_brand", "p_type"])


def q_normalize_strings_documents(spark, d):
    """Whole document texts (up to 20,000 words each) in four languages."""
    return normalize_strings(X.table(spark, d, "documents"), ["text", "lang", "source"])


def q_normalize_strings_orders(spark, d):
    o = X.table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return normalize_strings(o, "o_orderstatus, o_orderpriority")


def q_normalize_column_names(spark, d):
    c = X.table(spark, d, "customer")
    untidy = c.select(F.col("c_custkey").alias("CustKey"), F.col("c_name").alias(" customerName "),
                      F.col("c_nationkey").alias("nation-Key"),
                      F.col("c_acctbal").alias("acctBal (USD)"),
                      F.col("c_mktsegment").alias("MKT_Segment__"))
    return normalize_column_names(untidy)


def q_cast_to_string_orders(spark, d):
    o = X.table(spark, d, "orders")
    return cast_to_string(o, o.columns)


def q_cast_to_string_lineitem(spark, d):
    li = X.table(spark, d, "lineitem")
    return cast_to_string(li, li.columns)


def q_cast_to_date(spark, d):
    o = X.table(spark, d, "orders")
    k, year = F.col("o_orderkey"), F.year("o_orderdate").cast("string")
    text = (F.when(k % 29 == 0, F.lit(None).cast("string"))
            .when(k % 23 == 0, F.lit(""))
            .when(k % 19 == 0, F.lit("not a date"))
            .when(k % 17 == 0, F.concat(F.lit("02-30-"), year))
            .when(k % 13 == 0, F.concat(F.lit("13-45-"), year))
            .otherwise(F.date_format("o_orderdate", "MM-dd-yyyy")))
    t = o.select("o_orderkey", text.alias("o_datetext"), text.alias("o_date"))
    return cast_to_date(t, ["o_date"], "MM-dd-yyyy", on_error="null")


def q_cast_to_date_typed(spark, d):
    """A column that is a date already, cast twice; its text form beside it."""
    o = X.table(spark, d, "orders").select("o_orderkey", "o_orderdate",
                                           F.date_format("o_orderdate", "MM-dd-yyyy").alias("o_text"))
    both = ["o_orderdate", "o_text"]
    return cast_to_date(cast_to_date(o, both, "MM-dd-yyyy"), both, "MM-dd-yyyy")


def q_cdc_schema_change(spark, d):
    """Two loads in memory: the extract gains a column named like an internal
    one, then lacks the segment. Stored values stay on unchanged and closed rows."""
    prep = sd.prepare_snapshot(X.customer_prep(spark, d).selectExpr("*", "seg AS _mkt_segment"), CUST_KEY)
    first = sd.rebuild_current(prep, X.customer_current(spark, d), CUST_KEY, STAMPS)
    rerun = sd.prepare_snapshot(X.customer_prep_rerun(spark, d).drop("seg"), CUST_KEY)
    return ts_text(sd.next_state(rerun, first, CUST_KEY, sd.Stamps(X.AS_OF, X.LOAD_TS_RERUN),
                                 evolve=True))


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items())
    if name.startswith("q_") and callable(fn)
}
