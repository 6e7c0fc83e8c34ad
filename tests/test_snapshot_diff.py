"""Snapshot-diff CDC: flags, edges and invariants."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import snapshot_diff as sd
from tidemark.sources import derived as X
from paths import SF01

ST = sd.Stamps("2024-06-01", "2024-06-01 00:00:00")
CUR_SCHEMA = ("k string, v int, row_md5 string, audit_flag string, bgn_dt date, end_dt date, "
              "audit_inserted_ts timestamp")
OPEN = dt.date(9999, 12, 31)
OLD = dt.date(2024, 5, 1)
TS = dt.datetime(2024, 5, 1)


def cur(spark, rows):
    return spark.createDataFrame([(k, v, m, "I", OLD, OPEN, TS) for k, v, m in rows], CUR_SCHEMA)


def prep(spark, rows):
    return spark.createDataFrame(rows, "k string, v int, row_md5 string")


def flags(spark, p, c, **kw):
    snap = sd.prepare_snapshot(p, ["k"])
    return {r.k: r.flag for r in sd.diff_flags(snap, c, ["k"], **kw).collect()}


def test_case_and_space_variants_match(spark):
    c = cur(spark, [("a", 1, "m1")])
    p = prep(spark, [(" A ", 1, "m1")])
    assert flags(spark, p, c) == {" A ": "Z"}
    nxt = sd.next_state(sd.prepare_snapshot(p, ["k"]), c, ["k"], ST).collect()
    assert len(nxt) == 1 and nxt[0].k == "a" and nxt[0].bgn_dt == OLD   # own stamps kept


def test_dedupe_keeps_one_of_normalised_duplicates(spark):
    p = prep(spark, [("a", 1, "m1"), ("A ", 2, "m2")])
    snap = sd.prepare_snapshot(p, ["k"], order_by=["v"])
    rows = snap.collect()
    assert len(rows) == 1 and rows[0].v == 1


def test_null_safe_compare_without_fingerprint(spark):
    c = spark.createDataFrame(
        [("a", None, "I", OLD, OPEN, TS), ("b", 5, "I", OLD, OPEN, TS), ("c", None, "I", OLD, OPEN, TS)],
        "k string, v int, audit_flag string, bgn_dt date, end_dt date, audit_inserted_ts timestamp")
    p = spark.createDataFrame([("a", 5), ("b", None), ("c", None)], "k string, v int")
    assert flags(spark, p, c) == {"a": "U", "b": "U", "c": "Z"}


def test_null_fingerprint_is_compared_null_safely(spark):
    c = cur(spark, [("a", 1, None), ("b", 1, None)])
    p = prep(spark, [("a", 1, None), ("b", 1, "m")])
    assert flags(spark, p, c) == {"a": "Z", "b": "U"}


def test_null_keys_are_rejected(spark):
    p = spark.createDataFrame([(None, "x", 1), ("a", None, 2), ("a", "b", 3)], "k1 string, k2 string, v int")
    valid, rejected = sd.split_rejected(p, ["k1", "k2"])
    assert [r.v for r in valid.collect()] == [3]
    assert sorted(r.v for r in rejected.collect()) == [1, 2]


def test_composite_keys_do_not_collide(spark):
    # ('a', 'bc') and ('ab', 'c') concatenate alike; as separate parts they differ
    c = spark.createDataFrame([("a", "bc", 1, "I", OLD, OPEN, TS)],
                              "k1 string, k2 string, v int, audit_flag string, bgn_dt date, end_dt date, audit_inserted_ts timestamp")
    p = spark.createDataFrame([("ab", "c", 1)], "k1 string, k2 string, v int")
    snap = sd.prepare_snapshot(p, ["k1", "k2"])
    got = sorted((r.k1, r.flag) for r in sd.diff_flags(snap, c, ["k1", "k2"]).collect())
    assert got == [("a", "D"), ("ab", "I")]


def test_empty_current_makes_every_row_an_insert(spark):
    c = cur(spark, [])
    p = prep(spark, [("a", 1, "m"), ("b", 2, "n")])
    assert set(flags(spark, p, c).values()) == {"I"}


def test_customer_pair_counts_and_invariants(spark):
    p = sd.prepare_snapshot(X.customer_prep(spark, SF01), ["nm"])
    c = X.customer_current(spark, SF01)
    counts = {r.flag: r["count"] for r in sd.diff_flags(p, c, ["nm"]).groupBy("flag").count().collect()}
    assert counts == {"D": 150, "I": 150, "U": 300, "Z": 900}
    nxt = sd.next_state(p, c, ["nm"], ST, tag=True)
    by = {r[sd.CHANGE]: r["count"] for r in nxt.groupBy(sd.CHANGE).count().collect()}
    assert by[sd.CLOSED_BY_UPDATE] == by["U"]
    assert by["I"] + by["U"] + by["Z"] == p.count()           # one open row per prep key
    assert by["D"] + by["U"] + by["Z"] == c.count()           # every old current row accounted
    cur_rows = nxt.where(F.col("end_dt") == F.lit(OPEN))
    assert cur_rows.groupBy(F.trim(F.upper("nm"))).count().where("count > 1").count() == 0
    closed = nxt.where(F.col("end_dt") != F.lit(OPEN)).select("end_dt").distinct().collect()
    assert [r.end_dt for r in closed] == [dt.date(2024, 5, 31)]


def test_same_snapshot_twice_is_all_unchanged(spark):
    p = sd.prepare_snapshot(X.customer_prep(spark, SF01), ["nm"])
    c = X.customer_current(spark, SF01)
    first = sd.rebuild_current(p, c, ["nm"], ST)
    again = {r.flag for r in sd.diff_flags(p, first, ["nm"]).collect()}
    assert again == {"Z"}


def test_single_purpose_operators_agree_with_fused_plan(spark):
    p = sd.prepare_snapshot(X.customer_prep(spark, SF01), ["nm"])
    c = X.customer_current(spark, SF01)
    fused = sd.next_state(p, c, ["nm"], ST, tag=True)
    closed_fused = fused.where(F.col(sd.CHANGE).isin("C", "D")).drop(sd.CHANGE)
    closed_single = sd.close_history(p, c, ["nm"], ST)
    assert sorted(map(tuple, closed_fused.collect())) == sorted(map(tuple, closed_single.select(*closed_fused.columns).collect()))
    cls = sd.classify(p, c, ["nm"])
    nv = sd.new_versions(cls, ST)
    new_fused = fused.where(F.col(sd.CHANGE).isin("I", "U")).drop(sd.CHANGE)
    assert sorted(map(tuple, nv.collect())) == sorted(map(tuple, new_fused.select(*nv.columns).collect()))


def test_next_state_plan_shuffles_each_side_once(spark):
    p = sd.prepare_snapshot(X.customer_prep(spark, SF01), ["nm"])
    c = X.customer_current(spark, SF01)
    plan = sd.next_state(p, c, ["nm"], ST)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
    assert "WindowGroupLimit" in plan                       # map-side top-1 before the shuffle
    assert "BroadcastExchange" not in plan


def test_null_key_current_rows_close_without_joining(spark):
    c = spark.createDataFrame(
        [(None, 1, "I", OLD, OPEN, TS), (None, 2, "I", OLD, OPEN, TS), ("a", 1, "I", OLD, OPEN, TS)],
        "k string, v int, audit_flag string, bgn_dt date, end_dt date, audit_inserted_ts timestamp")
    p = spark.createDataFrame([("a", 1)], "k string, v int")
    snap = sd.prepare_snapshot(p, ["k"])
    got = sorted(((r.k, r.v, r.end_dt) for r in sd.next_state(snap, c, ["k"], ST).collect()),
                 key=repr)
    assert got == sorted([(None, 1, dt.date(2024, 5, 31)), (None, 2, dt.date(2024, 5, 31)),
                          ("a", 1, OPEN)], key=repr)


def test_schema_drift_and_missing_audit_columns(spark):
    # current lacks audit_inserted_ts and the new 'w' column; history lacks 'w' too
    c = spark.createDataFrame([("a", 1, "I", OLD, OPEN), ("h", 9, "I", OLD, dt.date(2020, 1, 1))],
                              "k string, v int, audit_flag string, bgn_dt date, end_dt date")
    p = spark.createDataFrame([("a", 1, 5)], "k string, v int, w int")
    out = sd.full_table(c, p, ["k"], ST)
    got = sorted(((r.k, r.v, r.w, r.end_dt) for r in out.collect()), key=repr)
    assert got == sorted([("a", 1, 5, OPEN), ("a", 1, None, dt.date(2024, 5, 31)),
                          ("h", 9, None, dt.date(2020, 1, 1))], key=repr)


def test_stamps_accept_date_datetime_and_text(spark):
    for as_of in ("2024-06-01", dt.date(2024, 6, 1), dt.datetime(2024, 6, 1, 13, 30)):
        st = sd.Stamps(as_of, dt.datetime(2024, 6, 1, 13, 30))
        row = spark.range(1).selectExpr(f"{st.as_of_sql()} AS a", f"{st.closed_sql()} AS c",
                                        f"{st.load_ts_sql()} AS t").first()
        assert (row.a, row.c) == (dt.date(2024, 6, 1), dt.date(2024, 5, 31))
        assert spark.range(1).select(st.as_of_col()).first()[0] == dt.date(2024, 6, 1)


def test_single_purpose_joins_keep_null_key_current_rows(spark):
    c = spark.createDataFrame(
        [(None, 1, "I", OLD, OPEN, TS), ("a", 1, "I", OLD, OPEN, TS), ("b", 2, "I", OLD, OPEN, TS)],
        "k string, v int, audit_flag string, bgn_dt date, end_dt date, audit_inserted_ts timestamp")
    p = sd.prepare_snapshot(spark.createDataFrame([("a", 1)], "k string, v int"), ["k"])
    assert sorted((r.k, r.flag) for r in sd.deleted(p, c, ["k"]).collect() if r.k) == [("b", "D")]
    assert sd.deleted(p, c, ["k"]).where("k is null").count() == 1
    closed = sd.close_history(p, c, ["k"], ST)
    assert closed.count() == 2 and closed.where("k is null").count() == 1
