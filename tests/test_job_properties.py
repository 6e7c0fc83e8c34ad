"""The on-disk CDC job against the brute-force model: an initial load and an
incremental load of random snapshots, read back from the published table."""

import datetime as dt
import tempfile

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.plans.cdc_job import run_cdc
from tidemark.plans.publish import TablePaths
from tidemark.sources.files import read_target
from test_properties import OLD, model_cdc, model_dedupe, spellings, values


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(first=st.lists(st.tuples(st.one_of(st.none(), spellings), values), min_size=1, max_size=6),
       second=st.lists(st.tuples(st.one_of(st.none(), spellings), values), min_size=1, max_size=6))
def test_two_loads_match_model(spark, first, second):
    root = tempfile.mkdtemp(prefix="tidemark-prop-")
    schema = "k string, v int"
    r1 = run_cdc(spark, "t", ["k"], root, as_of="2024-05-01", load_ts="2024-05-01 00:00:00",
                 prep=spark.createDataFrame(first, schema), fingerprint=None)
    cur = sorted(model_dedupe(first).values(), key=repr)
    if not cur:
        assert r1["status"] == "empty_prep"
        return
    r2 = run_cdc(spark, "t", ["k"], root, as_of="2024-06-01", load_ts="2024-06-01 00:00:00",
                 prep=spark.createDataFrame(second, schema), fingerprint=None)
    got = sorted(((r.k, r.v, r.audit_flag, r.bgn_dt, r.end_dt) for r in
                  read_target(spark, TablePaths(root, "t").target).collect()), key=repr)
    if r2["status"] == "empty_prep":
        want = [(k, v, "I", OLD, dt.date(9999, 12, 31)) for k, v in cur]
    else:
        want = model_cdc(second, cur)
    assert got == sorted(want, key=repr)
