"""DuckDB twins of the queries that SQL can express over whole tables."""

ASCII_LOWER = ("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
               "'abcdefghijklmnopqrstuvwxyz')")

EXACT = f"""
with d as (select doc_id, sha256({ASCII_LOWER}) as text_sha256, {ASCII_LOWER} as norm from documents)
select doc_id, max(doc_id) over (partition by norm) as keep_id,
       count(*) over (partition by norm) as group_size,
       doc_id = max(doc_id) over (partition by norm) as kept, text_sha256
from d
"""

URL = r"""
with u as (
  select page_id, case when contains(url, '://') then substr(url, strpos(url, '://') + 3) else '' end as r
  from pages),
p as (
  select page_id,
         translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(r, '^[^/?#]*([^?#]*)', 1) as path
  from u),
rules(v, h, q) as (values ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
  ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
fit as (
  select page_id, arg_max({'rule': h || q, 'v': v}, length(h) * 100000 + length(q)) as best
  from p join rules on (host = h or ends_with(host, '.' || h)) and starts_with(path, q)
  group by page_id)
select p.page_id, host, path, best.rule as rule, coalesce(best.v, 'allow') as verdict
from p left join fit using (page_id)
"""

LINES = r"""
with l as (select doc_id, string_split(coalesce(text, ''), chr(10)) as ls from documents),
w as (select doc_id, ls, unnest(generate_series(0, len(ls) - 3)) as pos from l where len(ls) >= 3),
win as (
  select doc_id, pos, ls[pos + 1] as a, ls[pos + 2] as b, ls[pos + 3] as c from w
  where regexp_matches(ls[pos + 1] || ls[pos + 2] || ls[pos + 3], '[^\x20\x09-\x0D]')),
later as (
  select doc_id, pos from win
  qualify row_number() over (partition by a, b, c order by doc_id, pos) > 1),
cov as (select distinct doc_id, pos + d as line from later, (values (0), (1), (2)) v(d)),
runs as (
  select doc_id, min(line) as s, max(line) as e
  from (select doc_id, line, line - row_number() over (partition by doc_id order by line) as g from cov)
  group by doc_id, g),
cut as (
  select doc_id, string_agg(s || '-' || e, ',' order by s) as removed, sum(e - s + 1) as n_removed
  from runs group by doc_id),
lines as (select doc_id, unnest(ls) as x, unnest(generate_series(0, len(ls) - 1)) as line from l),
kept as (
  select doc_id, string_agg(x, chr(10) order by line) as text
  from lines anti join cov using (doc_id, line) group by doc_id)
select l.doc_id, coalesce(k.text, '') as text, len(ls) as n_lines,
       coalesce(cast(n_removed as bigint), 0) as n_removed, coalesce(removed, '') as removed
from l left join kept k on k.doc_id = l.doc_id left join cut on cut.doc_id = l.doc_id
"""

NEAR = rf"""
with recursive w as (
  select doc_id, regexp_extract_all({ASCII_LOWER}, '[^\x20\x09-\x0D]+') as ws from documents),
s as (
  select distinct doc_id, array_to_string(ws[i:i + 4], ' ') as sh
  from (select doc_id, ws, unnest(generate_series(1, greatest(len(ws) - 4, least(len(ws), 1)))) as i
        from w)),
n as (select w.doc_id, count(sh) as n from w left join s using (doc_id) group by w.doc_id),
c as (
  select a.doc_id as a, b.doc_id as b, count(*) as k
  from s a join s b on a.sh = b.sh and a.doc_id <> b.doc_id group by 1, 2),
links as (
  select a, b from c join n x on a = x.doc_id join n y on b = y.doc_id
  where 100 * k >= 75 * (x.n + y.n - k)),
reach(a, b) as (
  select doc_id, doc_id from n union select r.a, l.b from reach r join links l on r.b = l.a),
m as (select a as doc_id, min(b) as component_id from reach group by a)
select doc_id, n as n_shingles, component_id, doc_id = component_id as kept from m join n using (doc_id)
"""


def _crc32(text: str) -> str:
    """Unsigned CRC-32 of a text's UTF-8 bytes, bit by bit."""
    data = (f"flatten(list_transform(range(0, strlen({text})), lambda i: "
            f"[cast('0x' || substr(hex({text}), 2 * i + 1, 2) as bigint), 0, 0, 0, 0, 0, 0, 0]))")
    return (f"xor(list_reduce([4294967295::bigint] || {data}, lambda c, v: "
            "xor(xor(c, v) >> 1, 3988292384 * (xor(c, v) & 1))), 4294967295)")


def _merkle(levels: int = 6) -> str:
    """Trees of up to 16 ** levels leaves a source, and as many sources."""
    def field(c: str) -> str:
        return f"coalesce(strlen(cast({c} as varchar)) || ':' || {c}, '-')"

    def tree(name: str, grp: str) -> list[str]:
        out = []
        for k in range(levels):
            out.append(f"""{name}{k + 1} as (
  select {grp}, pos // 16 as pos, (n + 15) // 16 as n,
         case when n > 1 then sha256(string_agg(h, '' order by pos)) else any_value(h) end as h
  from {name}{k} group by {grp}, pos // 16, n)""")
            frame = f"over (partition by {grp}, pos // 16 order by pos rows between"
            out.append(f"""{name}_side{k} as (
  select {grp}, pos, n > 1 as used,
         coalesce(string_agg(h, '') {frame} unbounded preceding and 1 preceding), '') as l,
         coalesce(string_agg(h, '') {frame} 1 following and unbounded following), '') as r
  from {name}{k})""")
        return out

    def climb(name: str, grp: str, rows: str, pos: str, keep: str) -> list[str]:
        out = []
        for k in range(levels):
            out.append(f"""{rows}{k + 1} as (
  select {keep}, {pos}, case when used then sha256(l || folded || r) else folded end as folded,
         case when used then sibs || l || r else sibs end as sibs
  from {rows}{k} x join {name}_side{k} s
    on x.{grp} is not distinct from s.{grp} and x.{pos} // {16 ** k} = s.pos)""")
        return out

    text = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    head = [field(c) for c in ("doc_id", "source", "lang", "n_chars")]
    keep = "doc_id, x.source, leaf"
    parts = [
        f"""leaves as (
  select doc_id, source, sha256({" || ".join([*head, field("text")])}) as leaf,
         case when {_crc32("cast(doc_id as varchar)")} % 5 = 0
              then sha256({" || ".join([*head, field(text)])}) end as changed
  from documents)""",
        """placed as (
  select *, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as spot,
         count(*) over (partition by source) as n from leaves)""",
        "t0 as (select source, spot as pos, n, leaf as h from placed)",
        *tree("t", "source"),
        f"""s0 as (
  select 0 as g, row_number() over (order by source nulls first) - 1 as pos, count(*) over () as n,
         h, source from t{levels})""",
        *tree("s", "g"),
        f"root as (select h as root from s{levels})",
        "up0 as (select doc_id, source, leaf, spot, coalesce(changed, leaf) as folded, '' as sibs from placed)",
        *climb("t", "source", "up", "spot", keep),
        f"""over0 as (
  select doc_id, leaf, s0.h as subroot, 0 as g, s0.pos as spot, folded, sibs
  from up{levels} u join s0 on u.source is not distinct from s0.source)""",
        *climb("s", "g", "over", "spot", "doc_id, leaf, subroot, x.g"),
    ]
    return ("with " + ",\n".join(parts) + f"""
select doc_id, leaf, subroot, root, sha256(sibs) as proof_sha256, folded as folded_root,
       folded = root as verified
from over{levels} cross join root
""")


def _importance() -> str:
    def features(table: str) -> str:
        return f"""
  select id, array_to_string(ws[i:i + k - 1], ' ') as f
  from (select id, ws, k, unnest(generate_series(1, len(ws) - k + 1)) as i
        from {table}, (values (1), (2), (3)) v(k))"""

    words = rf"regexp_extract_all({ASCII_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws"
    return f"""
with d as (select row_number() over () as id, doc_id, {words} from documents),
b as (select row_number() over () as id, {words} from benchmark),
df as materialized ({features("d")}),
bf as materialized ({features("b")}),
sums as materialized (
  select f, {_crc32("f")} % 10000 as bucket from (select f from df union select f from bf)),
s as (select bucket, count(*) as s from df join sums using (f) group by bucket),
t as (select bucket, count(*) as t from bf join sums using (f) group by bucket),
gain as (
  select bucket, cast(floor(1000 * ln(((coalesce(t, 0) + 1)::double * ((select count(*) from df) + 10000)::double)
         / ((coalesce(s, 0) + 1)::double * ((select count(*) from bf) + 10000)::double))) as bigint) as gain
  from s full join t using (bucket)),
w as (
  select id, count(*) as n_features, cast(sum(gain) as bigint) as weight
  from df join sums using (f) join gain using (bucket) group by id),
x as (
  select d.id, doc_id, len(ws) as n_words, coalesce(n_features, 0) as n_features,
         coalesce(weight, 0) as weight, coalesce(weight, 0) + cast(floor(-1000 * ln(-ln(
           (cast('0x' || substr(sha256('42:' || doc_id), 1, 8) as bigint) + 0.5::double) / 4294967296))) as bigint) as score
  from d left join w on d.id = w.id),
r as (
  select id, row_number() over (order by score desc, doc_id) as place, count(*) over () as m
  from x where n_words >= 20)
select doc_id, n_features, weight, score, case when place <= 5 * m // 100 then place end as rank
from x left join r on x.id = r.id
"""


SQL = {
    "op1_exact_dedup": EXACT,
    "op3_url_filter": URL,
    "op4_line_dedup": LINES,
    "op5_minhash_near_dedup": NEAR,
    "op12_merkle_manifest": _merkle(),
    "op13_importance_resampling": _importance(),
}
