"""Failures at every step of a publish, lost partitions, schema changes."""

import pytest

from tidemark.operators import scd
from tidemark.operators import snapshot_diff as sd
from tidemark.plans import cdc_job
from tidemark.plans.cdc_job import DuplicateCurrentKeys, LostPartition, republish, run_cdc
from tidemark.plans.publish import StagingMismatch, TablePaths
from tidemark.functions.casts import cast_to_date

DAY1 = {"as_of": "2024-05-01", "load_ts": "2024-05-01 00:00:00"}
DAY2 = {"as_of": "2024-06-01", "load_ts": "2024-06-01 00:00:00"}


def snap(spark, rows, more=""):
    return spark.createDataFrame(rows, "k string, v int, row_md5 string" + more)


def first_load(spark, root):
    run_cdc(spark, "t", ["k"], root, prep=snap(spark, [("a", 1, "1"), ("b", 2, "2")]), **DAY1)


def second(spark):
    return snap(spark, [("a", 9, "9"), ("c", 3, "3")])


def rows(spark, root):
    df = spark.read.parquet(TablePaths(root, "t").target)
    return sorted(tuple(str(x) for x in r) for r in df.select("k", "v", "bgn_dt", "end_dt").collect())


CLEAN = sorted([("a", "9", "2024-06-01", "9999-12-31"), ("c", "3", "2024-06-01", "9999-12-31"),
                ("a", "1", "2024-05-01", "2024-05-31"), ("b", "2", "2024-05-01", "2024-05-31")])


@pytest.mark.parametrize("fail_at", [0, 1, 2])
def test_a_plain_rerun_ends_like_a_clean_run(spark, tmp_root, monkeypatch, fail_at):
    """The publish fails before, between and after its two writes."""
    first_load(spark, tmp_root)
    real, calls = cdc_job.publish_partitions, []

    def broken(*a, **k):
        if len(calls) == fail_at:
            raise OSError("lost")
        calls.append(1)
        real(*a, **k)

    with monkeypatch.context() as m:
        m.setattr(cdc_job, "publish_partitions", broken)
        if fail_at == 2:       # both writes succeed, the record of it does not
            state = cdc_job.run_log.write_state
            m.setattr(cdc_job.run_log, "write_state", lambda s, f, r, st, facts:
                      (_ for _ in ()).throw(OSError("lost")) if st == "done" else state(s, f, r, st, facts))
        with pytest.raises(OSError):
            run_cdc(spark, "t", ["k"], tmp_root, prep=second(spark), **DAY2)
    out = run_cdc(spark, "t", ["k"], tmp_root, prep=second(spark), **DAY2)
    assert out["completed"] and (out["Z"], out["U"], out["I"]) == (2, 0, 0)
    assert rows(spark, tmp_root) == CLEAN


def test_republish_needs_a_verified_run(spark, tmp_root, monkeypatch):
    first_load(spark, tmp_root)
    before = rows(spark, tmp_root)
    with monkeypatch.context() as m:
        m.setattr(cdc_job, "verify_staged", lambda *a: (_ for _ in ()).throw(StagingMismatch("x")))
        with pytest.raises(StagingMismatch):
            run_cdc(spark, "t", ["k"], tmp_root, prep=second(spark), **DAY2)
    with pytest.raises(RuntimeError):
        republish(spark, "t", tmp_root)
    assert rows(spark, tmp_root) == before
    run_cdc(spark, "t", ["k"], tmp_root, prep=second(spark), **DAY2)
    assert rows(spark, tmp_root) == CLEAN


def test_lost_open_partition_is_no_initial_load(spark, tmp_root, monkeypatch):
    first_load(spark, tmp_root)
    monkeypatch.setattr(cdc_job, "read_partition", lambda *a: None)
    with pytest.raises(LostPartition):
        run_cdc(spark, "t", ["k"], tmp_root, prep=second(spark), **DAY2)


def test_two_current_rows_of_one_match_key_stop_the_run(spark, tmp_root):
    run_cdc(spark, "t", ["k"], tmp_root, normalize=False,
            prep=snap(spark, [("a", 1, "1"), ("A ", 2, "2")]), **DAY1)
    with pytest.raises(DuplicateCurrentKeys):
        run_cdc(spark, "t", ["k"], tmp_root, prep=second(spark), **DAY2)


def test_columns_come_and_go(spark, tmp_root):
    db = "tidemark_evolve"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{tmp_root}/db'")
    run_cdc(spark, "t", ["k"], tmp_root, database=db, prep=snap(spark, [("a", 1, "1"), ("b", 2, "2")]),
            **DAY1)
    wide = snap(spark, [("a", 1, "1", "x"), ("b", 5, "5", "y")], ", _mkt_segment string")
    run_cdc(spark, "t", ["k"], tmp_root, database=db, prep=wide, **DAY2)
    assert "_mkt_segment" in spark.table(f"{db}.t").columns
    narrow = snap(spark, [("b", 5, "5"), ("c", 1, "1")])
    with pytest.raises(sd.MissingColumns):
        run_cdc(spark, "t", ["k"], tmp_root, database=db, prep=narrow, as_of="2024-07-01")
    run_cdc(spark, "t", ["k"], tmp_root, database=db, prep=narrow, as_of="2024-07-01", evolve=True)
    got = {(r.k, str(r.end_dt)): r._mkt_segment for r in spark.table(f"{db}.t").collect()}
    assert got[("b", "9999-12-31")] == "y" and got[("c", "9999-12-31")] is None
    spark.sql(f"DROP DATABASE {db} CASCADE")


@pytest.mark.parametrize("name", ["bgn_dt", "end_dt", "audit_flag", "__tidemark_key_0"])
def test_reserved_names_are_an_error(spark, tmp_root, name):
    bad = snap(spark, [("a", 1, "1", "x")], f", {name} string")
    with pytest.raises(ValueError):
        run_cdc(spark, "t", ["k"], tmp_root, prep=bad, **DAY1)


def test_flag_column_is_kept_by_the_load(spark, tmp_root):
    run_cdc(spark, "t", ["k"], tmp_root, prep=snap(spark, [("a", 1, "1", "x")], ", flag string"), **DAY1)
    df = snap(spark, [("a", 2, "2", "z")], ", flag string")
    run_cdc(spark, "t", ["k"], tmp_root, prep=df, **DAY2)
    assert {r.flag for r in spark.read.parquet(TablePaths(tmp_root, "t").target).collect()} == {"x", "z"}
    with pytest.raises(ValueError):
        sd.classify(sd.prepare_snapshot(df, "k"), df, "k")


def test_scd_column_mismatch(spark):
    src = spark.createDataFrame([(1, "n", 5), (2, "m", 6)], "k int, a string, more int")
    tgt = spark.createDataFrame([(1, "o", "keep"), (3, "p", "q")], "k int, a string, old string")
    for op in (lambda **kw: scd.scd0(src, tgt, "k", **kw), lambda **kw: scd.scd1(src, tgt, "k", **kw),
               lambda **kw: scd.scd2(src, tgt, "k", "2024-06-01", **kw)):
        with pytest.raises(scd.ColumnMismatch):
            op()
    got = {r.k: (r.a, r.old, r.more) for r in scd.scd1(src, tgt, "k", evolve=True).collect()}
    assert got == {1: ("n", "keep", 5), 2: ("m", None, 6), 3: ("p", "q", None)}
    two = scd.scd2(src, tgt, "k", "2024-06-01", evolve=True).collect()
    assert sorted((r.k, r.a, str(r.old), r.flag) for r in two) == [
        (1, "n", "keep", 1), (1, "o", "keep", 0), (2, "m", "None", 1), (3, "p", "q", 1)]


def test_no_lambda_and_two_exchanges(spark):
    prep = sd.prepare_snapshot(second(spark), "k", order_by=["v"])
    cur = spark.createDataFrame([("a", 1, "1")], "k string, v int, row_md5 string").selectExpr(
        "*", "'I' as audit_flag", "date'2024-05-01' as bgn_dt", "date'9999-12-31' as end_dt",
        "timestamp'2024-05-01' as audit_inserted_ts")
    stamps = sd.Stamps("2024-06-01", "2024-06-01 00:00:00")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "lambda" not in plan(sd.next_state(prep, cur, "k", stamps))
    assert plan(sd.close_history(prep, cur, "k", stamps)).count("Exchange hashpartitioning") == 2


def test_cast_to_date_twice(spark):
    df = spark.createDataFrame([("01-02-2024",)], "d string").selectExpr(
        "d", "date'2024-01-02' as e", "timestamp'2024-01-02 05:00:00' as f")
    once = cast_to_date(df, ["d", "e", "f"], "MM-dd-yyyy", on_error="raise")
    row = cast_to_date(once, ["d", "e", "f"], "MM-dd-yyyy", on_error="raise").first()
    assert {str(x) for x in row} == {"2024-01-02"}
