"""Property tests: random small snapshots against a brute-force model of the
contracts (CDC next state, SCD 1, SCD 2)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.operators import scd
from tidemark.operators import snapshot_diff as sd

AS_OF = dt.date(2024, 6, 1)
OLD = dt.date(2024, 5, 1)
OPEN = dt.date(9999, 12, 31)
TS_OLD = dt.datetime(2024, 5, 1)
ST = sd.Stamps("2024-06-01", "2024-06-01 00:00:00")
SETTINGS = settings(max_examples=20, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

spellings = st.sampled_from(["a", "A", " a", "a ", "b", "B ", "c", "d", "D"])
values = st.one_of(st.none(), st.integers(0, 3))


def norm(k):
    return None if k is None else k.strip(" ").upper()


def nkey(x):
    """Sort key with NULLs first (Spark's ASC NULLS FIRST)."""
    return (x is not None, x if x is not None else 0)


def model_dedupe(rows):
    best = {}
    for k, v in rows:
        if k is None:
            continue
        cand = (nkey(v), k)           # non-key columns first, then the raw key
        if norm(k) not in best or cand < best[norm(k)][0]:
            best[norm(k)] = (cand, (k, v))
    return {n: r for n, (_, r) in best.items()}


def model_cdc(prep, cur):
    p = model_dedupe(prep)
    c = {norm(k): (k, v) for k, v in cur}
    out = []
    for n in set(p) | set(c):
        if n not in c:
            out.append((p[n][0], p[n][1], "I", AS_OF, OPEN))
        elif n not in p:
            out.append((c[n][0], c[n][1], "I", OLD, AS_OF - dt.timedelta(days=1)))
        elif p[n][1] != c[n][1]:
            out.append((p[n][0], p[n][1], "I", AS_OF, OPEN))
            out.append((c[n][0], c[n][1], "I", OLD, AS_OF - dt.timedelta(days=1)))
        else:
            out.append((c[n][0], c[n][1], "I", OLD, OPEN))
    return sorted(out, key=repr)


@SETTINGS
@given(prep=st.lists(st.tuples(st.one_of(st.none(), spellings), values), max_size=8),
       cur_keys=st.sets(st.sampled_from(["a", "b", "c", "d", "e"]), max_size=5),
       cur_vals=st.lists(values, min_size=5, max_size=5))
def test_cdc_next_state_matches_model(spark, prep, cur_keys, cur_vals):
    cur = [(k, v) for k, v in zip(sorted(cur_keys), cur_vals)]
    p_df = spark.createDataFrame(prep, "k string, v int")
    c_df = spark.createDataFrame([(k, v, "I", OLD, OPEN, TS_OLD) for k, v in cur],
                                 "k string, v int, audit_flag string, bgn_dt date, end_dt date, "
                                 "audit_inserted_ts timestamp")
    snap = sd.prepare_snapshot(p_df, ["k"])
    got = sd.next_state(snap, c_df, ["k"], ST).select("k", "v", "audit_flag", "bgn_dt", "end_dt")
    assert sorted(map(tuple, got.collect()), key=repr) == model_cdc(prep, cur)


int_keys = st.one_of(st.none(), st.integers(1, 6))


def model_scd_source(src):
    best = {}
    for k, v, w in src:
        if k is None:
            continue
        cand = (nkey(v), nkey(w))
        if k not in best or cand < best[k][0]:
            best[k] = (cand, (k, v, w))
    return {k: r for k, (_, r) in best.items()}


@SETTINGS
@given(src=st.lists(st.tuples(int_keys, values, values), max_size=8),
       tgt_keys=st.sets(st.integers(1, 6), max_size=5),
       tgt_vals=st.lists(st.tuples(values, values), min_size=5, max_size=5))
def test_scd1_matches_model(spark, src, tgt_keys, tgt_vals):
    tgt = [(k, v, w) for k, (v, w) in zip(sorted(tgt_keys), tgt_vals)]
    s = model_scd_source(src)
    t = {r[0]: r for r in tgt}
    want = []
    for k in set(s) | set(t):
        if k not in t or (k in s and s[k][1] != t[k][1]):      # compare column: v only
            want.append(s[k])
        else:
            want.append(t[k])
    got = scd.scd1(spark.createDataFrame(src, "k int, v int, w int"),
                   spark.createDataFrame(tgt, "k int, v int, w int"), ["k"], compare=["v"])
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


@SETTINGS
@given(src=st.lists(st.tuples(int_keys, values, values), max_size=8),
       tgt_keys=st.sets(st.integers(1, 6), max_size=5),
       tgt_vals=st.lists(st.tuples(values, values), min_size=5, max_size=5),
       old_keys=st.sets(st.integers(1, 6), max_size=3))
def test_scd2_matches_model(spark, src, tgt_keys, tgt_vals, old_keys):
    exp_old = dt.date(2023, 1, 1)
    tgt = [(k, v, w, 1, None) for k, (v, w) in zip(sorted(tgt_keys), tgt_vals)]
    tgt += [(k, 9, 9, 0, exp_old) for k in sorted(old_keys)]
    s = model_scd_source(src)
    t = {r[0]: r for r in tgt if r[3] == 1}
    want = [r for r in tgt if r[3] == 0]
    for k in set(s) | set(t):
        if k not in t:
            want.append((*s[k], 1, None))
        elif k in s and (s[k][1], s[k][2]) != (t[k][1], t[k][2]):
            want.append((*s[k], 1, None))
            want.append((*t[k][:3], 0, AS_OF))
        else:
            want.append(t[k])
    got = scd.scd2(spark.createDataFrame(src, "k int, v int, w int"),
                   spark.createDataFrame(tgt, "k int, v int, w int, flag int, expiry_date date"),
                   ["k"], ST)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


@SETTINGS
@given(src=st.lists(st.tuples(int_keys, values, values), max_size=8),
       tgt=st.lists(st.tuples(st.integers(1, 6), values, values), max_size=6))
def test_scd0_matches_model(spark, src, tgt):
    s = model_scd_source(src)
    have = {r[0] for r in tgt}
    want = list(tgt) + [s[k] for k in s if k not in have]
    got = scd.scd0(spark.createDataFrame(src, "k int, v int, w int"),
                   spark.createDataFrame(tgt, "k int, v int, w int"), ["k"])
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


@SETTINGS
@given(rows=st.lists(st.tuples(st.one_of(st.none(), st.sampled_from("xyz")), st.integers(0, 2)),
                     max_size=20))
def test_duplicate_groups_match_counter(spark, rows):
    from collections import Counter
    from tidemark.operators.checks import duplicate_groups
    want = {k: n for k, n in Counter(rows).items() if n > 1}
    got = duplicate_groups(spark.createDataFrame(rows, "a string, b int"), ["a", "b"]).collect()
    assert {(r.a, r.b): r.cnt for r in got} == want


@settings(max_examples=300, deadline=None)
@given(name=st.text(alphabet=st.sampled_from("aBz09_ -.()Xy"), min_size=1, max_size=12))
def test_normalize_column_name_properties(name):
    import re
    from tidemark.functions.cleaning import normalize_column_name
    out = normalize_column_name(name)
    assert re.fullmatch(r"[a-z0-9_]*", out)
    assert "__" not in out and not out.endswith("_")
    assert normalize_column_name(out) == out            # idempotent
