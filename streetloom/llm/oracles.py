"""DuckDB statements for the registered queries that SQL can express."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

# Words are numbered; a window is the list of its words. Items shorter than the window are one window.
ORACLES["op10_decontaminate"] = r"""
with doc as (
  select row_number() over () as r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents),
item as (
  select item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark),
win as (
  select distinct item_id, list_slice(w, i, i + l - 1) as g, l
  from (select item_id, w, least(len(w), 10) as l, unnest(range(1, len(w) - least(len(w), 10) + 2)) as i
        from item where len(w) > 0)),
size as (select distinct l from win),
hit as (
  select d.r, d.i, win.l, win.item_id
  from (select r, l, list_slice(w, i, i + l - 1) as g, i
        from (select r, w, l, unnest(range(1, len(w) - l + 2)) as i from doc, size where len(w) >= l)) d
  join win on win.g = d.g and win.l = d.l),
covered as (select r, count(*) as n from (select distinct r, unnest(range(i, i + l)) as p from hit) group by r),
named as (select r, count(*) as n, string_agg(item_id::varchar, ',' order by item_id::varchar) as s
          from (select distinct r, item_id from hit where item_id is not null) group by r)
select doc_id, len(w)::bigint as n_words, coalesce(covered.n, 0)::bigint as n_hit, coalesce(named.n, 0)::bigint as n_items,
  sha256(coalesce(named.s, '')) as items_sha256, coalesce(covered.n, 0) > 0 as contaminated
from doc left join covered using (r) left join named using (r)
"""

ORACLES["op9_warc"] = """
with p as (select page_id, coalesce(html, '') as html from pages),
d as (select page_id, octet_length(encode(html))::bigint as payload_bytes, sha256(html) as payload_digest from p),
f as (select payload_digest, min(page_id) as first from d where payload_bytes >= 100 group by 1)
select page_id, payload_bytes, payload_digest,
  case when first is not null and page_id is distinct from first then 'revisit' else 'response' end as record_type,
  case when page_id is distinct from first then first end as refers_to
from d left join f using (payload_digest)
"""

# DuckDB has no crc32: its table is made by eight rounds a byte value and folded over the bytes of each distinct word.
ORACLES["op11_resampling"] = r"""
with recursive rounds as (
  select range as b, range::bigint as v, 0 as k from range(256)
  union all
  select b, case when v & 1 = 1 then xor(3988292384, v >> 1) else v >> 1 end, k + 1 from rounds where k < 8),
crc as (select list(v order by b) as t from rounds where k = 8),
doc as (
  select row_number() over () as r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents),
item as (
  select regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark),
held as (select r, x, count(*)::bigint as c from (select r, unnest(w) as x from doc) group by 1, 2),
asked as (select x, count(*)::bigint as c from (select unnest(w) as x from item) group by 1),
word as (select distinct x from (select x from held union all select x from asked)),
bytes as (
  select x, list_transform(range(1, octet_length(encode(x)) + 1), lambda i: ('0x' || substr(hex(encode(x)), 2 * i - 1, 2))::bigint) as b from word),
bucket as (
  select x, xor(4294967295, list_reduce(list_prepend(4294967295::bigint, b), lambda c, y: xor(c >> 8, t[(xor(c, y) & 255) + 1]))) % 10000 as k
  from bytes, crc),
s as (select k, sum(c)::bigint as s from held join bucket using (x) group by 1),
t as (select k, sum(c)::bigint as t from asked join bucket using (x) group by 1),
size as (select (select coalesce(sum(s), 0) from s)::double as s_all, (select coalesce(sum(t), 0) from t)::double as t_all),
gain as (
  select k, floor(1000 * ln((coalesce(t, 0) + 1) * (s_all + 10000) / ((s + 1) * (t_all + 10000))))::bigint as g
  from s left join t using (k), size),
summed as (select r, sum(c * g) as g, sum(c) as n from held join bucket using (x) join gain using (k) group by 1),
weighed as (
  select r, doc_id, len(w) as n_words, coalesce(n, 0)::bigint as n_features,
    coalesce((g - ((g % n) + n) % n) // n, 0)::bigint as weight,
    ('0x' || substr(sha256('2024:' || coalesce(doc_id::varchar, '')), 1, 8))::bigint as h
  from doc left join summed using (r)),
scored as (select *, (weight + floor(-1000 * ln(-ln((h + 0.5::double) / 4294967296::double))))::bigint as score from weighed),
ranked as (
  select *, row_number() over (partition by n_words >= 20 order by score desc, doc_id) as place,
    count(*) filter (n_words >= 20) over () * 10 // 100 as drawn
  from scored)
select doc_id, n_features, weight, score, case when n_words >= 20 and place <= drawn then place end::bigint as rank
from ranked
"""

ORACLES["op12_topk"] = """
with v as (
  select row_number() over () as r, vec_id, [floor(256 * x::double) for x in embedding] as e
  from embeddings
  where embedding is not null and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
scored as (
  select q.r, q.vec_id as query_id, c.vec_id, list_dot_product(q.e, c.e)::bigint as score
  from v q join v c on q.r <> c.r
  where q.vec_id % 50 = 0)
select query_id, rank::int as rank, vec_id, score
from (select *, row_number() over (partition by r order by score desc, vec_id) as rank from scored)
where rank <= 5
"""

ORACLES["op13_nra"] = r"""
with doc as (
  select row_number() over () as r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as w
  from documents),
item as (
  select row_number() over () as i, item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as w
  from benchmark),
corpus as (select count(*)::bigint as n_docs, sum(len(w))::bigint as n_terms from doc where len(w) > 0),
tf as (select r, x, count(*)::bigint as tf from (select r, unnest(w) as x from doc) group by 1, 2),
asked as (select i, x, count(*)::bigint as n from (select i, unnest(w) as x from item) group by 1, 2),
weight as (
  select x, floor(1000 * ln((2 * n_docs + 2)::double / (2 * count(*) + 1)::double))::bigint as w
  from tf, corpus where x in (select x from asked) group by x, n_docs),
size as (select r, doc_id, 100 - 75 + (75 * len(w) * n_docs) // n_terms as m from doc, corpus),
scored as (
  select i, r, doc_id, sum(n * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::bigint as score
  from asked join weight using (x) join tf using (x) join size using (r) group by 1, 2, 3),
ranked as (select *, row_number() over (partition by i order by score desc, doc_id) as rank from scored where score > 0)
select item_id, rank::int as rank, doc_id, score from ranked join item using (i) where rank <= 10
"""
