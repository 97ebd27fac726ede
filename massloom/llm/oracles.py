"""SQL for the registered queries that SQL can express, written apart from the operators."""

from __future__ import annotations

_ASSIGN = (
    "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    "[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)"
)
_KINDS = [("assign", _ASSIGN, 2, 8), ("access", "AKIA[A-Z0-9]+", 0, 16), ("hex", "[0-9a-f]+", 0, 32), ("loose", "[A-Za-z0-9+/_-]+", 0, 24)]


def _matches(order: int, kind: str, pattern: str, group: int, least: int) -> str:
    return f"""select uid, source, lang, {order} as o, '{kind}' as kind, unnest(range(1, len(ms) + 1)) as i, ms, gaps, {group} as g, {least} as least, '{pattern}' as p
  from (select uid, source, lang, regexp_extract_all(t, '{pattern}') as ms, string_split_regex(t, '{pattern}') as gaps from d)"""


SECRETS = f"""with d as (select row_number() over () as uid, doc_id, coalesce(text, '') as t, source, lang from documents),
raw as ({' union all '.join(_matches(k, *x) for k, x in enumerate(_KINDS, 1))}),
placed as (select uid, source, source || '/' || lang as repo, o, kind, least,
  case when g = 2 then regexp_extract(ms[i], '{_ASSIGN}', 2) else ms[i] end as value,
  cast(list_sum(list_transform(gaps[1:i], lambda x: length(x))) + list_sum(list_transform(ms[1:i], lambda x: length(x))) as bigint) as fin, length(ms[i]) as size from raw),
f as (select *, fin - size as beg from placed where length(value) >= least and (kind <> 'loose' or (regexp_matches(value, '[0-9]') and regexp_matches(value, '[A-Za-z]')))),
own as (select value, count(distinct coalesce(source, chr(1))) as owners, count(distinct coalesce(source, chr(1)) || chr(2) || coalesce(repo, chr(1))) as repos,
  list_sum(list_transform(list_distinct(string_split(value, '')), lambda c: -(length(value) - length(replace(value, c, ''))) / length(value)
    * log2((length(value) - length(replace(value, c, ''))) / length(value)))) as bits from f group by value),
v as (select f.*, case when owners >= 3 or repos >= 5 then 'copied' when bits >= 3.0 and regexp_matches(value, '[0-9]') then 'live' else 'weak' end as verdict,
  max(case when kind <> 'loose' then fin end) over (partition by uid order by beg, o rows unbounded preceding) as covered from f join own using (value)),
s as (select * from v where kind <> 'loose' or (verdict = 'live' and coalesce(covered, 0) <= beg)),
a as (select uid, string_agg(kind || ':' || beg || ':' || fin, ',' order by beg, o) as spans,
  string_agg(case when kind <> 'loose' then kind || ':' || beg || ':' || fin end, ',' order by beg, o) as base,
  count(*) filter (where kind = 'assign') as n_assign, count(*) filter (where kind = 'access') as n_access, count(*) filter (where kind = 'hex') as n_hex,
  count(*) filter (where verdict = 'live') as n_live, count(*) filter (where verdict = 'copied') as n_copied from s group by uid)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex, sha256(coalesce(base, '')) as base_sha256,
  coalesce(spans, '') as spans, coalesce(n_live, 0) as n_live, coalesce(n_copied, 0) as n_copied from d left join a using (uid)"""

NEAREST = """with v as (select distinct vec_id, list_transform(embedding, lambda x: cast(x as double)) as e from embeddings where vec_id is not null and len(embedding) > 0
  and list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x))) and list_bool_or(list_transform(embedding, lambda x: x <> 0))),
s as (select q.vec_id as query_id, v.vec_id, max(list_dot_product(q.e, v.e) / (sqrt(list_dot_product(q.e, q.e)) * sqrt(list_dot_product(v.e, v.e)))) as score
  from v q join v on v.vec_id <> q.vec_id and len(v.e) = len(q.e) where q.vec_id % 50 = 0 group by 1, 2),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
select query_id, cast(rank as int) as rank, vec_id, score from r where rank <= 5"""

_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_FIVE = "cast('0x' || substr(h, 5 * i + 1, 5) as bigint)"
WARC = f"""with p as (select page_id, coalesce(html, '') as body, sha1(coalesce(html, '')) as h from pages),
top as (select h, max(page_id) as top from p group by 1)
select page_id, strlen(body) as payload_bytes, array_to_string(list_transform(range(0, 8), lambda i: {' || '.join(f"substr('{_BASE32}', (({_FIVE} >> {k}) & 31) + 1, 1)" for k in (15, 10, 5, 0))}), '') as payload_digest,
  case when page_id is not distinct from top then 'response' else 'revisit' end as record_type, case when page_id is distinct from top then top end as refers_to
from p join top using (h)"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
JOIN = f"""with recursive d as (select row_number() over () as uid, doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') as w from documents),
s as (select distinct uid, array_to_string(w[i:i + 3], ' ') as x from (select uid, w, unnest(range(1, greatest(len(w) - 2, 2))) as i from d where len(w) > 0)),
n as (select uid, count(*) as n from s group by 1),
pairs as (select a.uid as a, b.uid as b, count(*) as k from s a join s b on a.x = b.x and a.uid <> b.uid group by 1, 2),
links as (select a, b from pairs join n na on na.uid = a join n nb on nb.uid = b where 100 * k >= 85 * (na.n + nb.n - k)),
reach as (select uid as a, uid as b from d union select r.a, l.b from reach r join links l on l.a = r.b)
select d.doc_id, coalesce(n.n, 0) as n_shingles, c.component_id from d left join n using (uid)
  join (select r.a, min(e.doc_id) as component_id from reach r join d e on e.uid = r.b group by 1) c on c.a = d.uid"""

MIX = """with d as (select row_number() over () as uid, doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as size,
  md5(coalesce(cast(doc_id as varchar), '') || '/' || coalesce(source, '')) as k from documents),
s as (select source, sum(size) as n, row_number() over (order by source nulls last) - 1 as r from d group by 1),
w as (select source, n, ([3, 1, 2])[r % 3 + 1] as w, 1.5 * sum(n) over () as total, 2.0 * n / ([3, 1, 2])[r % 3 + 1] as ratio from s),
t as (select *, (total - coalesce(sum(2.0 * n) over (order by ratio, source nulls last rows between unbounded preceding and 1 preceding), 0))
  / sum(w) over (order by ratio, source nulls last rows between current row and unbounded following) as t from w),
g as (select source, cast(n as bigint) as source_size, cast(least(2.0 * n, coalesce((select min_by(t, ratio) from t where ratio >= t) * w, 2.0 * n)) as double) as target from t),
c as (select d.*, source_size, target, sum(size) over (partition by d.source order by k, uid rows unbounded preceding) as upto from d join g on g.source is not distinct from d.source)
select doc_id, cast(size as bigint) as size, source_size, target,
  cast(greatest(0, least(upto, floor(target)) - (upto - size)) + greatest(0, least(upto + source_size, floor(target)) - (upto + source_size - size)) as bigint) as taken from c"""

FIM = """with d as (select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') as u,
  sha256('1:' || coalesce(cast(doc_id as varchar), '')) as h from documents),
c as (select *, len(u) as n, cast('0x' || substr(h, 1, 8) as bigint) as h1, cast('0x' || substr(h, 9, 8) as bigint) as h2,
  cast('0x' || substr(h, 17, 8) as bigint) as h3, cast('0x' || substr(h, 25, 8) as bigint) as h4 from d),
e as (select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
  case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 90 then 'plain' when h4 % 100 < 20 then 'spm' else 'psm' end as form from c),
p as (select *, coalesce(array_to_string(u[1:a], ''), '') as pre, coalesce(array_to_string(u[a + 1:b], ''), '') as mid, coalesce(array_to_string(u[b + 1:], ''), '') as suf from e)
select doc_id, cast(n as bigint) as n, form, case when form <> 'plain' then length(pre) end as prefix_chars, case when form <> 'plain' then length(mid) end as middle_chars,
  sha256(case form when 'psm' then '<P>' || pre || '<S>' || suf || '<M>' || mid when 'spm' then '<S>' || suf || '<P>' || pre || '<M>' || mid else t end) as output_sha256,
  sha256(t) as restored_sha256 from p"""

_FINITE = "list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x)))"
PRODUCTS = f"""with v as (select distinct vec_id, list_transform(embedding, lambda x: floor(1024 * cast(x as double))) as e from embeddings where vec_id is not null and {_FINITE}),
s as (select q.vec_id as query_id, v.vec_id, max(cast(list_dot_product(q.e, v.e) as bigint)) as score from v q join v on v.vec_id <> q.vec_id and len(v.e) = len(q.e)
  where q.vec_id % 100 = 0 group by 1, 2),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
select query_id, cast(rank as int) as rank, vec_id, score from r where rank <= 10"""

_ROUND = """a{r} as materialized (select uid, e, arg_min(cluster, (d, cluster)) as cluster, min(d) as d from (
  select uid, e, cluster, list_dot_product(e, e) - 2 * list_dot_product(e, c) + list_dot_product(c, c) as d from v, c{r}) group by 1, 2)"""
_MOVE = """c{n} as materialized (select c{r}.cluster, coalesce(m.c, c{r}.c) as c from c{r} left join (
  select cluster, list(cast((s - ((s % n) + n) % n) // n as double) order by i) as c from (
    select cluster, i, sum(cast(e[i] as bigint)) as s, count(*) as n from (select cluster, e, unnest(range(1, 65)) as i from a{r}) group by 1, 2) group by 1) m using (cluster))"""
_STEPS = ",\n".join(_ROUND.format(r=r) + (",\n" + _MOVE.format(r=r, n=r + 1) if r < 5 else "") for r in range(6))
CLUSTERS = f"""with v as materialized (select row_number() over () as uid, vec_id, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as e from embeddings
  where len(embedding) = 64 and {_FINITE}),
c0 as materialized (select cast(row_number() over (order by sha256('2:' || coalesce(cast(vec_id as varchar), ''))) - 1 as int) as cluster, e as c from v qualify cluster < 40),
{_STEPS},
t as (select cluster, sum(d) as d from a5 group by 1)
select v.vec_id, a5.cluster, cast(a5.d as bigint) as distance, cast(t.d as bigint) as cluster_inertia, (select cast(sum(d) as bigint) from t) as inertia,
  sha256(array_to_string(list_transform(c5.c, lambda x: cast(cast(x as bigint) as varchar)), ',')) as centroid_sha256
from a5 join v using (uid) join t using (cluster) join c5 using (cluster)"""

SQL = {"op2_secret_scan": SECRETS, "op4_block_search": NEAREST, "op6_warc": WARC, "op7_ngram_join": JOIN, "op10_source_mix": MIX,
       "op11_fill_middle": FIM, "op12_slice_search": PRODUCTS, "op13_plane_clusters": CLUSTERS}
