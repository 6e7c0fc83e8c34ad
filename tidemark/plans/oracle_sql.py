"""DuckDB twins of the registered queries, as SQL text.

Each twin restates the operator's contract in plain SQL over the driver's
tables so the two engines can be compared row for row. Timestamps are
rendered as text on both sides (the engines differ in time-zone handling).
Templates are filled from column lists; every statement is ordinary SQL.
"""

from __future__ import annotations

from collections.abc import Sequence

# --- fixed values: fixture dates (same as sources.derived) ----------------
CURRENT_DAY, AS_OF, CLOSED = "2024-05-01", "2024-06-01", "2024-05-31"
TS_CURRENT, TS_AS_OF, TS_RERUN = "2024-05-01 00:00:00", "2024-06-01 00:00:00", "2024-06-01 12:00:00"
OPEN_END = "9999-12-31"

MD5 = "md5(concat_ws('||', cast(bal as varchar), seg))"

CUSTOMER = f"""
b as (select c_custkey as k, c_name as nm, c_acctbal as bal, c_mktsegment as seg from customer),
cur0 as (select * from b where k % 10 <> 3),
prep0 as (select k,
                 case when k % 4 = 0 then concat('  ', lower(nm), ' ') else nm end as nm,
                 case when k % 5 = 0 then bal + 100 else bal end as bal,
                 seg
          from b where k % 10 <> 7),
cur as (select k, nm, bal, seg, {MD5} as row_md5, 'I' as audit_flag,
               date '{CURRENT_DAY}' as bgn_dt, date '{OPEN_END}' as end_dt,
               cast(timestamp '{TS_CURRENT}' as varchar) as audit_inserted_ts
        from cur0),
prep as (select k, nm, bal, seg, {MD5} as row_md5 from prep0),
whole as (select k, nm, bal, seg, {MD5} as row_md5 from b)"""

ORDER_VALUES = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]

ORDERS = f"""
ob as (select o_orderkey as k, {', '.join(ORDER_VALUES)} from orders),
ocur0 as (select * from ob where k % 10 <> 3),
oprep0 as (select k, o_custkey, o_orderstatus,
                  case when k % 5 = 0 then o_totalprice + 1 else o_totalprice end as o_totalprice,
                  o_orderdate,
                  case when k % 4 = 0 then lower(o_orderpriority) else o_orderpriority end as o_orderpriority
           from ob where k % 10 <> 7),
ocur as (select *, 'I' as audit_flag, date '{CURRENT_DAY}' as bgn_dt, date '{OPEN_END}' as end_dt,
                cast(timestamp '{TS_CURRENT}' as varchar) as audit_inserted_ts
         from ocur0)"""


def _list(cols: Sequence[str], prefix: str = "") -> str:
    return ", ".join(f"{prefix}{c}" for c in cols)


def dedupe(name: str, src: str, key: str, order: Sequence[str]) -> str:
    """One row per ``key`` expression, first by ``order`` ascending, NULLs first."""
    by = ", ".join(f"{c} asc nulls first" for c in order)
    return (f"{name} as (select * from {src} where {key} is not null "
            f"qualify row_number() over (partition by {key} order by {by}) = 1)")


def distinct(cols: Sequence[str], a: str = "p_", b: str = "c_") -> str:
    if not cols:
        return "false"
    return " or ".join(f"{a}{c} is distinct from {b}{c}" for c in cols)


def cdc_join(name: str, prep: str, cur: str, key: str, data: Sequence[str],
             cmp: Sequence[str]) -> str:
    """Full outer join of a deduplicated snapshot and the current rows with a
    flag per key (I, U, Z, D)."""
    pcols = ", ".join(f"{c} as p_{c}" for c in data)
    ccols = ", ".join(f"{c} as c_{c}" for c in data)
    return f"""
{name}_p as (select {pcols}, {key} as p_mk, true as p_in from {prep}),
{name}_c as (select {ccols}, audit_flag as c_audit_flag, bgn_dt as c_bgn_dt,
                    cast(audit_inserted_ts as varchar) as c_audit_inserted_ts,
                    {key} as c_mk, true as c_in from {cur}),
{name} as (select *, case when c_in is null then 'I' when p_in is null then 'D'
                          when {distinct(cmp)} then 'U' else 'Z' end as flag
           from {name}_p full outer join {name}_c on p_mk = c_mk)"""


def cdc_rows(j: str, data: Sequence[str], as_of: str, closed: str, ts: str,
             which: Sequence[str] = ("new", "kept", "closed")) -> str:
    parts = []
    if "new" in which:
        parts.append(f"select {', '.join(f'p_{c} as {c}' for c in data)}, 'I' as audit_flag, "
                     f"date '{as_of}' as bgn_dt, date '{OPEN_END}' as end_dt, "
                     f"'{ts}' as audit_inserted_ts from {j} where flag in ('I', 'U')")
    if "kept" in which:
        parts.append(f"select {_list(data, 'c_')}, c_audit_flag, c_bgn_dt, date '{OPEN_END}', "
                     f"c_audit_inserted_ts from {j} where flag = 'Z'")
    if "closed" in which:
        parts.append(f"select {_list(data, 'c_')}, c_audit_flag, c_bgn_dt, date '{closed}', "
                     f"c_audit_inserted_ts from {j} where flag in ('U', 'D')")
    return "\nunion all\n".join(parts)


def scd_join(name: str, src: str, tgt: str, key: str, data: Sequence[str],
             cmp: Sequence[str], extra_t: Sequence[str] = ()) -> str:
    """Full outer join of a deduplicated source and a target with a state
    per key: N new, U changed, K kept."""
    scols = ", ".join(f"{c} as s_{c}" for c in data)
    tcols = ", ".join(f"{c} as t_{c}" for c in list(data) + list(extra_t))
    return f"""
{name}_s as (select {scols}, true as s_in from {src}),
{name}_t as (select {tcols}, true as t_in from {tgt}),
{name} as (select *, case when t_in is null then 'N'
                          when s_in is not null and ({distinct(cmp, 's_', 't_')}) then 'U'
                          else 'K' end as state
           from {name}_s full outer join {name}_t on s_{key} = t_{key})"""


CUST_DATA = ["k", "nm", "bal", "seg", "row_md5"]
CUST_PLAIN = ["k", "nm", "bal", "seg"]
CUST_DEDUPE = dedupe("prep_d", "prep", "trim(upper(nm))", ["k", "bal", "seg", "row_md5", "nm"])
CUST_SRC = dedupe("src", "prep0", "k", ["nm", "bal", "seg", "k"])
ORD_DATA = ["k"] + ORDER_VALUES
ORD_SRC = dedupe("osrc", "oprep0", "k", ORDER_VALUES + ["k"])


def _cdc_next_customer(which=("new", "kept", "closed")) -> str:
    return (f"with {CUSTOMER},\n{CUST_DEDUPE},"
            f"{cdc_join('j', 'prep_d', 'cur', 'trim(upper(nm))', CUST_DATA, ['row_md5'])}\n"
            f"{cdc_rows('j', CUST_DATA, AS_OF, CLOSED, TS_AS_OF, which)}")


def _scd1(src_cte: str, src: str, tgt: str, key: str, data: Sequence[str],
          cmp: Sequence[str]) -> str:
    pick = ", ".join(f"case when state in ('N', 'U') then s_{c} else t_{c} end as {c}" for c in data)
    return f"{src_cte},{scd_join('j', src, tgt, key, data, cmp)}\nselect {pick} from j"


def _scd2(src_cte: str, src: str, tgt: str, key: str, data: Sequence[str],
          cmp: Sequence[str]) -> str:
    return f"""{src_cte},
open_t as (select * from {tgt} where flag = 1),
hist_t as (select * from {tgt} where not (flag = 1) or flag is null),
{scd_join('j', src, 'open_t', key, data, cmp, ['expiry_date']).lstrip()}
select {_list(data)}, flag, expiry_date from hist_t
union all
select {_list(data, 's_')}, 1, cast(null as date) from j where state in ('N', 'U')
union all
select {_list(data, 't_')}, 1, t_expiry_date from j where state = 'K'
union all
select {_list(data, 't_')}, 0, date '{AS_OF}' from j where state = 'U'"""


def _normalize(x: str) -> str:
    """The string rule in DuckDB terms: '_' to ' ', initcap (each
    space-separated word: first letter in title case, rest lower), trim, ''
    to NULL. Title case of a word-initial 'ß' is 'Ss' in Spark (full Unicode
    mapping), where DuckDB's upper() gives 'ẞ'; the twin says so."""
    first = "case when w[1] = 'ß' then 'Ss' else upper(w[1]) end"
    init = (f"list_aggregate(list_transform(string_split(lower(replace({x}, '_', ' ')), ' '), "
            f"lambda w: {first} || w[2:]), 'string_agg', ' ')")
    return f"nullif(trim({init}), '')"


SQL: dict[str, str] = {
    # checks
    "filtered_rows": "select * from orders where o_orderstatus = 'F'",
    "row_count": "select count(*) as cnt from lineitem",
    "row_count_filtered": "select count(*) as cnt from orders where o_orderstatus = 'F'",
    "count_check_catalog": "select * from orders where o_orderstatus = 'F'",
    "count_value_catalog": "select count(*) as cnt from lineitem where l_returnflag = 'R'",
    "duplicate_check_catalog":
        "select user_id, event_type, count(*) as cnt from events where value > 10 "
        "group by user_id, event_type having count(*) > 1",
    "duplicate_groups_single":
        "select text, count(*) as cnt from documents group by text having count(*) > 1",
    "duplicate_groups_composite":
        "select user_id, event_type, count(*) as cnt from events "
        "group by user_id, event_type having count(*) > 1",
    "duplicate_groups_lineitem":
        "select l_partkey, l_suppkey, count(*) as cnt from lineitem "
        "group by l_partkey, l_suppkey having count(*) > 1",
    "dedupe_snapshot":
        "select doc_id, text, lang, source, n_chars from documents where text is not null "
        "qualify row_number() over (partition by trim(upper(text)) order by doc_id) = 1",
    "dedupe_hot_keys":
        "select * from lineitem where l_returnflag is not null qualify row_number() over "
        "(partition by trim(upper(l_returnflag)) order by l_orderkey nulls first, "
        "l_linenumber nulls first) = 1",
    "duplicate_groups_hot":
        "select l_returnflag, l_linestatus, count(*) as cnt from lineitem "
        "group by l_returnflag, l_linestatus having count(*) > 1",
    # CDC on the customer pair
    "cdc_flags": f"""with {CUSTOMER},
{CUST_DEDUPE},{cdc_join('j', 'prep_d', 'cur', 'trim(upper(nm))', CUST_DATA, ['row_md5'])}
select {', '.join(f"case when flag = 'D' then c_{c} else p_{c} end as {c}" for c in CUST_DATA)}, flag from j""",
    "cdc_classify": f"""with {CUSTOMER},
{CUST_DEDUPE},{cdc_join('j', 'prep_d', 'cur', 'trim(upper(nm))', CUST_DATA, ['row_md5'])}
select {', '.join(f'p_{c} as {c}' for c in CUST_DATA)}, flag from j where p_in""",
    "cdc_deleted": f"""with {CUSTOMER}
select {_list(CUST_DATA)}, 'D' as flag from cur c
where not exists (select 1 from prep p where trim(upper(p.nm)) = trim(upper(c.nm)))""",
    "cdc_new_versions": _cdc_next_customer(("new",)),
    "cdc_rejected": f"""with {CUSTOMER},
blanked as (select k, case when k % 13 = 0 then null else nm end as nm, bal, seg, row_md5 from whole)
select * from blanked where nm is null""",
    "cdc_initial_load": f"""with {CUSTOMER},
{dedupe('whole_d', 'whole', 'trim(upper(nm))', ['k', 'bal', 'seg', 'row_md5', 'nm'])}
select {_list(CUST_DATA)}, 'I' as audit_flag, date '{AS_OF}' as bgn_dt, date '{OPEN_END}' as end_dt,
       '{TS_AS_OF}' as audit_inserted_ts from whole_d""",
    "cdc_closed_history": f"""with {CUSTOMER},
{CUST_DEDUPE}
select {_list(CUST_DATA)}, audit_flag, bgn_dt, date '{CLOSED}' as end_dt, audit_inserted_ts from cur c
where not exists (select 1 from prep_d p where trim(upper(p.nm)) = trim(upper(c.nm))
                  and p.row_md5 is not distinct from c.row_md5)""",
    "cdc_current": _cdc_next_customer(("new", "kept")),
    "cdc_next_state": _cdc_next_customer(),
    "cdc_full_table": f"""with {CUSTOMER},
{CUST_DEDUPE},
hist as (select k, nm, bal - 50 as bal, seg, md5(concat_ws('||', cast(bal - 50 as varchar), seg)) as row_md5,
                'I' as audit_flag, date '2020-01-01' as bgn_dt, date '2020-12-31' as end_dt,
                '2020-01-01 00:00:00' as audit_inserted_ts from b where k % 10 = 1),
{cdc_join('j', 'prep_d', 'cur', 'trim(upper(nm))', CUST_DATA, ['row_md5']).lstrip()}
select * from hist
union all
{cdc_rows('j', CUST_DATA, AS_OF, CLOSED, TS_AS_OF)}""",
    "cdc_publish_roundtrip": f"""with {CUSTOMER},
{CUST_DEDUPE},{cdc_join('j', 'prep_d', 'cur', 'trim(upper(nm))', CUST_DATA, ['row_md5'])},
state_b as ({cdc_rows('j', CUST_DATA, AS_OF, CLOSED, TS_AS_OF)}),
open_b as (select * from state_b where end_dt = date '{OPEN_END}'),
closed_b as (select * from state_b where end_dt <> date '{OPEN_END}'),
prep2 as (select k, nm, case when k % 3 = 0 then bal + 1 else bal end as bal, seg from prep0),
prep2m as (select k, nm, bal, seg, {MD5} as row_md5 from prep2),
{dedupe('prep2_d', 'prep2m', 'trim(upper(nm))', ['k', 'bal', 'seg', 'row_md5', 'nm'])},
{cdc_join('j2', 'prep2_d', 'open_b', 'trim(upper(nm))', CUST_DATA, ['row_md5']).lstrip()}
select * from closed_b
union all
{cdc_rows('j2', CUST_DATA, AS_OF, CLOSED, TS_RERUN)}""",
    "inverted_intervals": f"""with {CUSTOMER},
{CUST_DEDUPE},{cdc_join('j', 'prep_d', 'cur', 'trim(upper(nm))', CUST_DATA, ['row_md5'])},
state_b as ({cdc_rows('j', CUST_DATA, AS_OF, CLOSED, TS_AS_OF)}),
open_b as (select * from state_b where end_dt = date '{OPEN_END}'),
prep2 as (select k, nm, case when k % 3 = 0 then bal + 1 else bal end as bal, seg from prep0),
prep2m as (select k, nm, bal, seg, {MD5} as row_md5 from prep2),
{dedupe('prep2_d', 'prep2m', 'trim(upper(nm))', ['k', 'bal', 'seg', 'row_md5', 'nm'])},
{cdc_join('j2', 'prep2_d', 'open_b', 'trim(upper(nm))', CUST_DATA, ['row_md5']).lstrip()},
state_c as ({cdc_rows('j2', CUST_DATA, AS_OF, CLOSED, TS_RERUN)})
select * from state_c where end_dt < bgn_dt""",
    "cdc_schema_change": f"""with {CUSTOMER},
{CUST_DEDUPE},{cdc_join('j', 'prep_d', 'cur', 'trim(upper(nm))', CUST_DATA, ['row_md5'])},
s1 as (select p_k as k, p_nm as nm, p_bal as bal, p_seg as seg, p_row_md5 as row_md5,
              p_seg as _mkt_segment, 'I' as audit_flag, date '{AS_OF}' as bgn_dt,
              '{TS_AS_OF}' as audit_inserted_ts, trim(upper(p_nm)) as mk
       from j where flag in ('I', 'U')
       union all
       select c_k, c_nm, c_bal, c_seg, c_row_md5, null, c_audit_flag, c_bgn_dt,
              c_audit_inserted_ts, trim(upper(c_nm)) from j where flag = 'Z'),
prep2 as (select k, nm, case when k % 3 = 0 then bal + 1 else bal end as bal, seg from prep0),
s2 as (select k, nm, bal, {MD5} as row_md5, trim(upper(nm)) as mk from prep2)
select n.k, n.nm, n.bal, n.row_md5, null as seg, null as _mkt_segment, 'I' as audit_flag,
       date '{AS_OF}' as bgn_dt, date '{OPEN_END}' as end_dt, '{TS_RERUN}' as audit_inserted_ts
from s2 n left join s1 o on n.mk = o.mk where o.mk is null or n.row_md5 is distinct from o.row_md5
union all
select o.k, o.nm, o.bal, o.row_md5, o.seg, o._mkt_segment, o.audit_flag, o.bgn_dt,
       case when n.mk is not null and n.row_md5 is not distinct from o.row_md5
            then date '{OPEN_END}' else date '{CLOSED}' end, o.audit_inserted_ts
from s1 o left join s2 n on n.mk = o.mk""",
    # SCD on the customer pair (key k, compare bal and seg)
    "scd0_initial": f"with {CUSTOMER}\nselect {_list(CUST_PLAIN)} from b",
    "scd0_delta": f"""with {CUSTOMER},
{CUST_SRC}
select {_list(CUST_PLAIN)} from cur0
union all
select {_list(CUST_PLAIN, 's.')} from src s where not exists (select 1 from cur0 t where t.k = s.k)""",
    "scd1_upsert": f"""with {CUSTOMER},
s1 as (select k, nm, bal, case when k % 7 = 0 then null else seg end as seg from prep0),
t1 as (select k, nm, bal, case when k % 11 = 0 then null else seg end as seg from cur0),
{_scd1(dedupe('src1', 's1', 'k', ['nm', 'bal', 'seg', 'k']), 'src1', 't1', 'k', CUST_PLAIN, ['bal', 'seg'])}""",
    "scd0_publish": f"""with {CUSTOMER},
{CUST_SRC}
select {_list(CUST_PLAIN)} from cur0
union all
select {_list(CUST_PLAIN, 's.')} from src s where not exists (select 1 from cur0 t where t.k = s.k)""",
    "scd1_publish": f"""with {CUSTOMER},
{_scd1(CUST_SRC, 'src', 'cur0', 'k', CUST_PLAIN, ['bal', 'seg'])}""",
    "scd2_publish": f"""with {CUSTOMER},
t2 as (select k, nm, bal, seg, 1 as flag, cast(null as date) as expiry_date from cur0),
{_scd2(CUST_SRC, 'src', 't2', 'k', CUST_PLAIN, ['bal', 'seg'])}""",
    "scd2_initial": f"""with {CUSTOMER}
select {_list(CUST_PLAIN)}, 1 as flag, cast(null as date) as expiry_date from b""",
    "scd2_delta": f"""with {CUSTOMER},
t2 as (select k, nm, bal, seg, 1 as flag, cast(null as date) as expiry_date from cur0
       union all
       select k, nm, bal - 50, seg, 0, date '2024-01-01' from b where k % 10 = 1),
{_scd2(CUST_SRC, 'src', 't2', 'k', CUST_PLAIN, ['bal', 'seg'])}""",
    # the orders pair (key o_orderkey, every value column compared)
    "cdc_orders_next_state": f"""with {ORDERS},
{dedupe('op_d', 'oprep0', 'k', ORDER_VALUES + ['k'])},{cdc_join('j', 'op_d', 'ocur', 'k', ORD_DATA, ORDER_VALUES)}
{cdc_rows('j', ORD_DATA, AS_OF, CLOSED, TS_AS_OF)}""",
    "scd0_orders": f"""with {ORDERS},
{ORD_SRC}
select {_list(ORD_DATA)} from ocur0
union all
select {_list(ORD_DATA, 's.')} from osrc s where not exists (select 1 from ocur0 t where t.k = s.k)""",
    "scd1_orders": f"""with {ORDERS},
{_scd1(ORD_SRC, 'osrc', 'ocur0', 'k', ORD_DATA, ORDER_VALUES)}""",
    "scd2_orders": f"""with {ORDERS},
ot2 as (select *, 1 as flag, cast(null as date) as expiry_date from ocur0),
{_scd2(ORD_SRC, 'osrc', 'ot2', 'k', ORD_DATA, ORDER_VALUES)}""",
    # cleaning and casts
    "normalize_strings_nation":
        f"select n_nationkey, {_normalize('n_name')} as n_name, n_regionkey from nation",
    "normalize_strings_part":
        f"select p_partkey, {_normalize('p_name')} as p_name, {_normalize('p_brand')} as p_brand, "
        f"{_normalize('p_type')} as p_type, p_size, p_retailprice from part",
    "normalize_strings_documents":
        f"select doc_id, {_normalize('text')} as text, {_normalize('lang')} as lang, "
        f"{_normalize('source')} as source, n_chars from documents",
    "normalize_strings_orders":
        f"select o_orderkey, {_normalize('o_orderstatus')} as o_orderstatus, "
        f"{_normalize('o_orderpriority')} as o_orderpriority from orders",
    "normalize_column_names":
        "select c_custkey as cust_key, c_name as customer_name, c_nationkey as nation_key, "
        "c_acctbal as acct_bal_usd, c_mktsegment as mkt_segment from customer",
    "cast_to_string_orders":
        "select " + ", ".join(f"cast({c} as varchar) as {c}" for c in
                              ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                               "o_orderdate", "o_orderpriority"]) + " from orders",
    "cast_to_string_lineitem":
        "select " + ", ".join(f"cast({c} as varchar) as {c}" for c in
                              ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                               "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
                               "l_linestatus", "l_shipdate"]) + " from lineitem",
    "cast_to_date_typed": "select o_orderkey, cast(o_orderdate as date) as o_orderdate, "
                          "cast(o_orderdate as date) as o_text from orders",
    "cast_to_date": """with t as (
  select o_orderkey,
         case when o_orderkey % 29 = 0 then null
              when o_orderkey % 23 = 0 then ''
              when o_orderkey % 19 = 0 then 'not a date'
              when o_orderkey % 17 = 0 then '02-30-' || cast(year(o_orderdate) as varchar)
              when o_orderkey % 13 = 0 then '13-45-' || cast(year(o_orderdate) as varchar)
              else strftime(o_orderdate, '%m-%d-%Y') end as o_datetext
  from orders)
select o_orderkey, o_datetext, cast(try_strptime(o_datetext, '%m-%d-%Y') as date) as o_date from t""",
}

# published another way, the same table
SQL["cdc_atomic_publish"] = SQL["cdc_publish_roundtrip"]
SQL["cdc_bucketed_current"] = SQL["cdc_publish_roundtrip"]
SQL["cdc_manifest_restore"] = SQL["cdc_publish_roundtrip"]
SQL["scd1_copy_on_write"] = SQL["scd1_publish"]
SQL["cdc_digest_diff"] = SQL["cdc_orders_next_state"]
