"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from .ann import op5_ann
from .decontaminate import op2_decontamination
from .lm_score import op7_lm_scoring
from .minhash import op10_minhash
from .mixing import PRIME, ROUNDS, op8_mixing
from .pii import op4_pii
from .quality import op9_quality
from .sharding import op1_sharding
from .substring import op6_substring
from .warc import op3_warc

QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_decontamination": op2_decontamination,
    "op3_warc": op3_warc,
    "op4_pii": op4_pii,
    "op5_ann": op5_ann,
    "op6_substring": op6_substring,
    "op7_lm_scoring": op7_lm_scoring,
    "op8_mixing": op8_mixing,
    "op9_quality": op9_quality,
    "op10_minhash": op10_minhash,
}

_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"


def _permuted(x: str, n: str, name: str) -> str:
    """The place of x under the swap-or-not permutation of 0 to n - 1 with the round keys of ``name``."""
    part = lambda at, size: f"list_transform(range(1, {ROUNDS + 1}), lambda r: ('0x' || substr(md5({name} || ':' || r), {at}, {size}))::bigint)"
    other = f"((({part(1, 15)}[r] % {n} - v) % {n} + {n}) % {n})"
    pair = f"greatest(v, {other})"
    bit = f"bit_count((({pair} % {PRIME}) * ({part(16, 8)}[r] % {PRIME} + 1) + ({pair} // {PRIME} + 1) * ({part(24, 8)}[r] % {PRIME} + 1)) % {PRIME}) & 1"
    return f"list_reduce(list_prepend({x}, range(1, {ROUNDS + 1})), lambda v, r: case when {bit} = 1 then {other} else v end)"


ORACLE_SQL = {
    "op1_sharding": """
with step as (select list(c order by n) as crc_table from (
  select n, list_reduce(list_prepend(n, range(8)), lambda c, k: xor(c >> 1, (c & 1) * 3988292384)) as c from (select unnest(range(256)) as n))),
d as (
  select doc_id, source, coalesce(text, '') as t,
         ('0x' || substr(md5('17:' || coalesce(doc_id::varchar, 'null')), 1, 15))::bigint as h from documents),
r as (select *, row_number() over (partition by source order by h, doc_id) as r, count(*) over (partition by source) as size_of from d),
p as (select *, row_number() over (order by (2 * r - 1)::double / size_of, source nulls first, r) - 1 as pos, count(*) over () as n from r),
s as (select *, (pos * 24) // n as shard from p)
select doc_id, (octet_length(encode(t)) + 8)::bigint as size, xor(4294967295::bigint, list_reduce(list_prepend(4294967295::bigint, list_transform(regexp_extract_all(hex(encode(t)), '..'), lambda x: ('0x' || x)::bigint)),
         lambda c, b: xor(c >> 8, crc_table[(xor(c, b) & 255) + 1])))::bigint as text_crc32, 'rows' as law, shard::int as shard,
       (pos - (shard * n + 23) // 24)::bigint as slot, null::int as grown_shard, source from s, step
""",
    "op3_warc": """
with p as (select page_id, encode(coalesce(html, '')) as b from pages),
h as (select page_id, octet_length(b)::bigint as n, sha1(b) as x from p),
f as (select *, min(page_id) over (partition by x) as first from h)
select page_id, n as payload_bytes,
       list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         (((('0x' || substr(x, (i // 4) * 5 + 1, 5))::bigint >> (15 - 5 * (i % 4))::int) & 31) + 1)::int, 1)), 'string_agg', '') as payload_digest,
       case when first = page_id then 'response' else 'revisit' end as record_type,
       case when first <> page_id then first end as refers_to, null::varchar as problem from f
""",
    "op5_ann": """
with v as (
  select vec_id, embedding::double[] as e from embeddings
  where embedding is not null and len(embedding) > 0 and vec_id is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
s as (select q.vec_id as query_id, c.vec_id, list_inner_product(q.e, c.e) as score
      from v q join v c on q.vec_id % 20 = 0 and q.vec_id <> c.vec_id and len(q.e) = len(c.e)),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
select query_id, rank::int as rank, vec_id, score from r where rank <= 20
""",
    "op6_substring": f"""
with d as (select doc_id, coalesce({_WORDS.format("text")}, []) as w from documents),
win as (select doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) as h from d, lateral (select unnest(range(1, len(w) - 48)) as i)),
first as (select h, min(doc_id) as lo from win group by h),
gone as (select distinct doc_id, i + k as word from win join first using (h), (select unnest(range(50)) as k) where lo < doc_id),
per as (select doc_id, list(word) as gone_words from gone group by doc_id)
select doc_id, len(w)::bigint as n_words, coalesce(len(gone_words), 0)::bigint as n_removed,
       sha256(coalesce(array_to_string(list_filter(w, lambda x, i: not list_contains(coalesce(gone_words, []), i)), ' '), '')) as kept_sha256
from d left join per using (doc_id)
""",
    "op8_mixing": f"""
with d as (
  select doc_id, source, coalesce(len({_WORDS.format("text")}), 0)::bigint as size,
         ('0x' || substr(md5('29:' || coalesce(doc_id::varchar, 'null') || ':' || coalesce(text, '')), 1, 15))::bigint as h from documents),
g as (select source, sum(size)::bigint as size, row_number() over (order by source nulls last) - 1 as sid from d group by source),
w as (select *, sid % 3 + 1 as weight, size * 3::double / (sid % 3 + 1) as ratio, sum(size) over () as total, sum(sid % 3 + 1) over () as w_all from g),
l as (select *, (total - 3::double * coalesce(sum(size) over before, 0)) / (w_all - coalesce(sum(weight) over before, 0)) as level
      from w window before as (order by ratio, sid rows between unbounded preceding and 1 preceding)),
f as (select arg_min(level, ratio) as level from l where ratio >= level),
t as (select source, sid, size, least(size * 3::double, weight * f.level) as target, (size + 63) // 64 as blocks from l, f),
q as (select *, case when size > 0 then least(round(target * blocks / size), floor(3::double * blocks))::bigint else 0 end as quota from t),
s as (select *, (sum(quota) over (order by sid) - quota)::bigint as lo, sum(quota) over ()::bigint as m from q),
p as (select sid, blocks, pass, lo + pass * blocks as lo, least(lo + quota, lo + (pass + 1) * blocks) as hi
      from s, lateral (select unnest(range((quota + blocks - 1) // greatest(blocks, 1))) as pass)),
u as (select {_permuted("i", "m", "'29:slots'")} as u from (select m, unnest(range(m)) as i from (select distinct m from s))),
c as (select sid, {_permuted("(u - lo)", "blocks", "('29:' || sid || ':' || pass)")} as block from u join p on u.u >= p.lo and u.u < p.hi),
n as (select sid, block, count(*) as copies from c group by all),
o as (select doc_id, sid, d.size, (sum(d.size) over (partition by sid order by h, doc_id) - d.size)::bigint as off
      from d join s on d.source is not distinct from s.source),
k as (select *, unnest(range(off // 64, (off + size - 1) // 64 + 1)) as block from o where size > 0),
taken as (select k.doc_id, k.sid, sum(copies * (least(off + size, (block + 1) * 64) - greatest(off, block * 64))) as taken from k join n using (sid, block) group by all)
select o.doc_id, o.size, s.size as source_size, s.target, coalesce(taken, 0)::bigint as taken, s.source
from o join s using (sid) left join taken on taken.doc_id = o.doc_id and taken.sid = o.sid
""",
    "op10_minhash": f"""
with recursive d as (
  select doc_id, {_WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} as w from documents),
s as (select distinct doc_id, md5(array_to_string(w[i:i + 2], ' ')) as h from d, lateral (select unnest(range(1, greatest(len(w) - 1, 2))) as i) where len(w) > 0),
n as (select doc_id, count(*) as n from s group by doc_id),
pair as (select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.h = b.h and a.doc_id < b.doc_id group by all),
link as (select a, b from pair join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 85 * (x.n + y.n - c)),
both_ways as (select a, b from link union all select b, a from link),
reach as (select a as doc_id, b as other from both_ways union select r.doc_id, e.b from reach r join both_ways e on e.a = r.other),
comp as (select doc_id, min(other) as lo from reach group by doc_id)
select doc_id, coalesce(n, 0)::bigint as n_shingles, least(doc_id, coalesce(lo, doc_id)) as component_id,
       doc_id = least(doc_id, coalesce(lo, doc_id)) as kept
from d left join n using (doc_id) left join comp using (doc_id)
""",
}
