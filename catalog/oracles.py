"""DuckDB SQL for the registered queries, written from the rules and not from the Spark plans.

Text between ``@name@`` is replaced by a shared fragment below.
"""

from __future__ import annotations

import re

from catalog import parameters as par
from catalog.roles import ROLES, role_sql

BLANK = r"[\t-\r\x1c-\x1f\x{85}\pZ]"
NO_BLANK = r"[^\t-\r\x1c-\x1f\x{85}\pZ]"


def _strip(text: str) -> str:
    return f"regexp_replace({text}, '^{BLANK}+|{BLANK}+$', '', 'g')"


def _label(text: str) -> str:
    return f"regexp_replace({_strip(f'lower({text})')}, '{BLANK}+', ' ', 'g')"


def _clean(text: str) -> str:
    linkless = f"regexp_replace(lower(coalesce({text}, '')), 'http{NO_BLANK}+|www{NO_BLANK}+', '', 'g')"
    spaced = f"regexp_replace({linkless}, '[^\\pL\\pN_]', ' ', 'g')"
    return _strip(f"regexp_replace({spaced}, '{BLANK}+', ' ', 'g')")


def _zip_text(column: str) -> str:
    return f"nullif(regexp_extract(regexp_replace({column}, '\\.0$', ''), '(\\d{{5}})', 1), '')"


def _zip_digits(column: str) -> str:
    digits = f"regexp_replace({column}, '\\D', '', 'g')"
    return f"case when length({digits}) >= 5 then substr({digits}, 1, 5) end"


def _valid(lat: str, lon: str) -> str:
    return f"coalesce({lat} between 39.5 and 40.5 and {lon} between -76.0 and -74.5, false)"


def _lcs(a: str, b: str) -> str:
    """Longest common subsequence by the textbook table, one row per character of ``a``."""
    rows = (
        f"list_transform(string_split({a}, ''), lambda c: list_transform(string_split({b}, ''),"
        " lambda d: case when c = d then 1 else 0 end))"
    )
    zeros = f"[list_transform(string_split({b}, ''), lambda d: 0)]"
    cell = "case when y[k] = 1 then coalesce(x[k - 1], 0) + 1 else x[k] end"
    step = (
        "lambda x, y: list_transform(range(1, len(y) + 1), lambda j:"
        f" list_max(list_transform(range(1, j + 1), lambda k: {cell})))"
    )
    return f"list_last(list_reduce(list_concat({zeros}, {rows}), {step}))"


def _ratio(a: str, b: str) -> str:
    measured = f"cast(round_even(200.0 * {_lcs(a, b)} / (length({a}) + length({b})), 0) as integer)"
    return f"case when {a} = {b} then 100 when {a} = '' or {b} = '' then 0 else {measured} end"


def _even(value: str, places: int) -> str:
    scale = f"1e{places}"
    return f"round_even(({value}) * {scale}, 0) / {scale}"


_AFFINITY = par.values_sql(par.AFFINITY, "service_name, category, score")
_GROUPS = par.values_sql(par.REQUEST_GROUPS, "kind, request_group")
_TERMS = par.values_sql(par.taxonomy_rows(), "category_group, keyword, ordinal")
_LEXICON = par.values_sql(par.LEXICON, "token, valence, kind")

def _affinity_of(kind: str, category: str) -> str:
    """Joins: a by the lower-case type, w as written for types that the table lacks in lower case."""
    return f"""left join {_AFFINITY} a on a.service_name = lower({kind}) and a.category = {category}
      left join {_AFFINITY} w on w.service_name = {kind} and w.category = {category}
        and lower({kind}) not in (select service_name from {_AFFINITY})"""


_DISTANCE = (
    "2 * 6371000 * asin(sqrt(least(1.0, pow(sin(radians(b.latitude - r.lat) / 2), 2)"
    " + cos(radians(r.lat)) * cos(radians(b.latitude)) * pow(sin(radians(b.longitude - r.lon) / 2), 2))))"
)

_PAIRS = f"""
near as (
  select r.service_request_id, coalesce(r.service_name, 'unknown') as service_name, r.subject,
         r.agency_responsible, r.requested_datetime, r.address as address_request,
         r.zipcode as zipcode_request, r.lat as lat_request, r.lon as lon_request,
         b.business_id, b.name as business_name, b.address as address_business,
         b.postal_code as postal_code_business, b.latitude as lat_business, b.longitude as lon_business,
         b.stars, b.review_count, coalesce(b.primary_category, 'unknown') as primary_category,
         b.categories_normalized, {_DISTANCE} as distance
  from {role_sql("requests")} r join {role_sql("businesses")} b
    on b.latitude between r.lat - 0.01 and r.lat + 0.01
  where {_DISTANCE} <= 250
), scored as (
  select *, {_even("0.5e0 * proximity_score + 0.5e0 * category_similarity", 4)} as hybrid_score
  from (select *, {_even("greatest(0e0, least(1e0, 1e0 - distance_m / 250e0))", 4)} as proximity_score
        from (select near.*, {_even("distance", 2)} as distance_m, {_even("coalesce(a.score, w.score, 0e0)", 4)} as category_similarity
              from near {_affinity_of("near.service_name", "near.primary_category")}))
), pairs as (
  select *, cast(row_number() over (partition by service_request_id
           order by hybrid_score desc, distance, business_id) as integer) as match_rank
  from scored
), closest as (
  select * from pairs qualify row_number() over (partition by service_request_id
    order by distance_m, hybrid_score desc, match_rank) = 1
)"""

def _among(column: str, name: str) -> str:
    return f"{column} in ({', '.join(repr(word) for word in par.PHRASES[name])})"


_SENTIMENT = f"""
cleaned as (
  select review_id, business_id, {_clean("text")} as text_clean from {role_sql("reviews")}
), words as (
  select review_id, string_split(text_clean, ' ') as w from cleaned where text_clean <> ''
), entries as (
  select review_id, unnest(w) as token, generate_subscripts(w, 1) as pos from words
), marks as (
  select review_id, min(pos) as mark from entries
  where token in ({", ".join(f"'{word}'" for word in par.CONTRAST)}) group by review_id
), neighbours as (
  select *, lag(token, 1) over o as b1, lag(token, 2) over o as b2, lag(token, 3) over o as b3, lead(token, 1) over o as a1, lead(token, 2) over o as a2
  from entries window o as (partition by review_id order by pos)
), valence as (select token, valence from {_LEXICON} where kind = 'word'),
booster as (select token, valence from {_LEXICON} where kind = 'booster'),
negation as (select token from {_LEXICON} where kind = 'negation'),
phrase as (select token, valence from {_LEXICON} where kind = 'phrase'),
hits as (
  select n.review_id, n.pos, n.b1, n.b2, n.b3,
    case when coalesce({_among("b1", "no")} or {_among("b2", "no")} or ({_among("b3", "no")} and {_among("b1", "no link")}), false) then -0.74 * v.valence
      when {_among("n.token", "no")} and n.a1 in (select token from valence) then 0 else v.valence end as v0,
    b1 is not null and w1.token is null as free1, b2 is not null and w2.token is null as free2, b3 is not null and w3.token is null as free3,
    coalesce(s1.valence, 0) as s1, 0.95 * coalesce(s2.valence, 0) as s2, 0.9 * coalesce(s3.valence, 0) as s3,
    coalesce(near.valence, 0) + coalesce(far.valence, 0) + coalesce(wide.valence, 0) as two,
    coalesce(q1.valence, q2.valence, q3.valence, q4.valence, q5.valence, q6.valence, q7.valence) as instead,
    n1.token is not null as neg1, n2.token is not null as neg2, n3.token is not null as neg3
  from neighbours n join valence v on v.token = n.token
  left join valence w1 on w1.token = n.b1 left join valence w2 on w2.token = n.b2 left join valence w3 on w3.token = n.b3
  left join booster s1 on s1.token = n.b1 left join booster s2 on s2.token = n.b2 left join booster s3 on s3.token = n.b3
  left join booster near on near.token = n.b2 || ' ' || n.b1 left join booster far on far.token = n.b3 || ' ' || n.b2
  left join booster wide on wide.token = n.b3 || ' ' || n.b2 || ' ' || n.b1
  left join phrase q1 on q1.token = n.token || ' ' || n.a1 || ' ' || n.a2
  left join phrase q2 on q2.token = n.token || ' ' || n.a1
  left join phrase q3 on q3.token = n.b1 || ' ' || n.token
  left join phrase q4 on q4.token = n.b2 || ' ' || n.b1 || ' ' || n.token
  left join phrase q5 on q5.token = n.b2 || ' ' || n.b1
  left join phrase q6 on q6.token = n.b3 || ' ' || n.b2 || ' ' || n.b1
  left join phrase q7 on q7.token = n.b3 || ' ' || n.b2
  left join negation n1 on n1.token = n.b1 left join negation n2 on n2.token = n.b2 left join negation n3 on n3.token = n.b3
  where n.token not in (select token from booster) and not coalesce({_among("n.token", "kind")} and {_among("a1", "of")}, false)
), first_step as (
  select *, case when free1 then (v0 + case when v0 < 0 then -s1 else s1 end) * case when neg1 then -0.74 else 1.0 end else v0 end as v1 from hits
), second_step as (
  select *, case when free2 then (v1 + case when v1 < 0 then -s2 else s2 end) * case
      when {_among("b2", "never")} and {_among("b1", "so")} then 1.25
      when {_among("b2", "without")} and {_among("b1", "doubt")} then 1.0 when neg2 then -0.74 else 1.0 end else v1 end as v2 from first_step
), third_step as (
  select *, case when free3 then coalesce(instead, (v2 + case when v2 < 0 then -s3 else s3 end) * case
      when ({_among("b3", "never")} and {_among("b2", "so")}) or {_among("b1", "so")} then 1.25
      when {_among("b3", "without")} and ({_among("b2", "doubt")} or {_among("b1", "doubt")}) then 1.0
      when neg3 then -0.74 else 1.0 end) + two else v2 end as v2b from second_step
), last_step as (
  select *, case when {_among("b1", "least")} and free1 and not coalesce({_among("b2", "before least")}, false) then -0.74 * v2b else v2b end as v3
  from third_step
), totals as (
  select t.review_id, sum(v3 * case when t.pos < m.mark then 0.5 when t.pos > m.mark then 1.5 else 1.0 end) as s
  from last_step t left join marks m using (review_id) group by t.review_id
), scored_reviews as (
  select c.review_id, c.business_id,
         {_even("cast(coalesce(s, 0) as double) / sqrt(cast(coalesce(s, 0) as double) * coalesce(s, 0) + 15)", 4)} as review_sentiment
  from cleaned c left join totals using (review_id)
), rollup_by_business as (
  select business_id, round_even(avg(cast(round(review_sentiment * 10000) as bigint)), 0) / 10000 as avg_sentiment,
         round_even(median(cast(round(review_sentiment * 10000) as bigint)), 0) / 10000 as median_sentiment,
         {_even("stddev_samp(review_sentiment)", 4)} as std_sentiment,
         count(*) as review_count,
         round_even(100 * avg(case when review_sentiment >= 0.05 then 1 else 0 end), 1) as pct_positive,
         round_even(100 * avg(case when review_sentiment <= -0.05 then 1 else 0 end), 1) as pct_negative
  from scored_reviews group by business_id
)"""

_BUSINESS_RAW = f"""
raw as (
  select "Seq No" as seq_no, "Business_ID" as business_id, " Name " as name, "Address" as address,
         "City" as city, "State" as state, "Postal Code" as postal_code, "Latitude" as latitude,
         "Longitude" as longitude, "Stars" as stars, "Review Count" as review_count,
         "Is Open?" as is_open, "Categories" as categories
  from {role_sql("businesses_raw")}
)"""



def _taxonomy(found: str) -> str:
    return f"""
parts as (
  select seq_no, regexp_replace(regexp_replace({_strip("lower(part)")}, '[^\\pL\\pN_&' || chr(9) || ' ]', '', 'g'),
         '{BLANK}+', ' ', 'g') as name
  from (select seq_no, unnest(string_split(coalesce(categories, 'Uncategorized'), ',')) as part from raw)
), found as (
  select distinct p.seq_no, p.name, t.category_group, t.ordinal
  from parts p join {_TERMS} t on {found}
), labels_of as (
  select seq_no, category_group as label, ordinal, '' as tie from found
  union
  select seq_no, name, 1000, name from parts p
  where name <> 'uncategorized' and not exists (select 1 from found f where f.seq_no = p.seq_no and f.name = p.name)
), mapped as (
  select raw.seq_no, coalesce(string_agg(label, '|' order by ordinal, tie), 'Uncategorized') as categories_normalized,
         coalesce(first(label order by ordinal, tie), 'Uncategorized') as primary_category
  from raw left join labels_of using (seq_no) group by raw.seq_no
)"""


_SUBSTRING = _taxonomy("contains(p.name, t.keyword)")
_WORDS = _taxonomy(
    "contains(' ' || replace(p.name, '&', ' ') || ' ', ' ' || t.keyword || ' ')"
)

_RATIO_AB = _ratio("a.text", "b.text")
_SHOPS = f"""
shops as (select shop_id, lower(name) as block, lower(address) as text, review_count, name, address from {role_sql("shops")}),
placed as (select *, row_number() over (order by review_count desc, shop_id) as place from shops),
texts as (
  select block, text, min(place) as place, count(*) as copies, arg_min(shop_id, place) as first_id
  from placed group by block, text
), alike as (
  select * from (
    select a.block, a.text as text_a, b.text as text_b, a.copies as copies_a, b.copies as copies_b,
           a.place as place_a, b.place as place_b, {_RATIO_AB} as ratio, a.first_id as first_a, b.first_id as first_b
    from texts a join texts b on a.block = b.block and a.place < b.place
  ) where ratio > 80
)"""


_KEPT_BUSINESSES = f"""
located as (
  select * replace ({_zip_digits("postal_code")} as postal_code) from raw where {_valid("latitude", "longitude")}
), once as (
  select * from located qualify row_number() over (partition by business_id order by seq_no) = 1
), placed as (
  select *, {_strip("lower(name)")} as block, lower(coalesce(address, '')) as text,
    row_number() over (order by review_count desc, business_id) as place from once
), texts as (
  select block, text, min(place) as place from placed group by block, text
), marked as (
  select distinct b.block, b.text from texts a join texts b on a.block = b.block and a.place < b.place
  where {_RATIO_AB} > 80
), kept as (
  select p.seq_no from placed p join texts t on t.block = p.block and t.text = p.text and t.place = p.place
  where not exists (select 1 from marked m where m.block = p.block and m.text = p.text)
)"""

_REVIEW_STEPS = f"""
raw as (select * from {role_sql("reviews_raw")}),
complete as (select * from raw where text is not null and business_id is not null and date is not null),
once as (select * from complete qualify row_number() over (partition by review_id order by seq) = 1),
distinct_text as (select * from once qualify row_number() over (partition by business_id, text order by seq) = 1),
with_words as (
  select * from (select *, {_clean("text")} as text_clean from distinct_text) where text_clean <> ''
)"""


def _audit(*tables: str) -> str:
    sizes = " union all ".join(
        f"select {step} as step, '{label}' as stage, count(*) as n from {source}"
        for step, (label, source) in enumerate(pair.split("=") for pair in tables)
    )
    return f"""select step, stage, rows_in, n as rows_out, rows_in - n as dropped, round(100.0 * n / rows_in, 2) as pct_kept
        from (select *, lag(n) over (order by step) as rows_in from ({sizes})) where step > 0"""


_REQUEST_STEPS = f"""
raw as (select * from {role_sql("requests_raw")}),
complete as (
  select * from raw where lat is not null and lon is not null and service_name is not null
    and (subject is not null or status_notes is not null)
), once as (
  select * from complete qualify row_number() over (partition by service_request_id order by objectid) = 1
), events_once as (
  select * from once qualify row_number() over (
    partition by service_name, {_even("lat", 4)}, {_even("lon", 4)}, cast(cast(requested_datetime as timestamp) as date)
    order by objectid) = 1
)"""

_KNOWN = "select source from documents join labels using (doc_id) where toxic = 1"

_GROUP = """case when list_bool_or(list_transform(categories_normalized, lambda c: regexp_matches(lower(c), 'service'))) then 'Service'
 when list_bool_or(list_transform(categories_normalized, lambda c: regexp_matches(lower(c), 'retail'))) then 'Retail'
 when list_bool_or(list_transform(categories_normalized, lambda c: regexp_matches(lower(c), 'restaurant'))) then 'Restaurant'
 else 'Other' end"""

_DENSITY = """density as (
  select zipcode_request as zipcode, count(service_request_id) as request_count, count(distinct business_id) as business_count
  from pairs where zipcode_request is not null group by zipcode_request
)"""

_CELLS = f"""grouped as (select request_group, zipcode from @role requests@ join {_GROUPS} g
          on g.kind = lower(service_name)),
        rows_of as (select request_group, count(*) as r from grouped group by 1),
        columns_of as (select zipcode, count(*) as c from grouped group by 1),
        cells as (select request_group, zipcode, count(*) as o from grouped group by all),
        expected as (select r.request_group, c.zipcode, r.r * c.c / (select count(*) from grouped) as e
          from rows_of r, columns_of c),
        tested as (select sum(pow(coalesce(o, 0) - e, 2) / e) as statistic,
          ((select count(*) from rows_of) - 1) * ((select count(*) from columns_of) - 1) as degrees,
          (select count(*) from grouped) as n
        from expected left join cells using (request_group, zipcode))"""


def _clusters(ks: range, steps: int) -> str:
    """Centres after ``steps`` rounds for each k, from farthest points: table s<steps> (k, j, x, y)."""
    apart = "round((z.x - c.x) * (z.x - c.x) + (z.y - c.y) * (z.y - c.y), 9)"
    parts = [
        """m as materialized (select avg(proximity_score) as ma, avg(category_similarity) as mb, stddev_pop(proximity_score) as sa,
          stddev_pop(category_similarity) as sb from closest where proximity_score is not null and category_similarity is not null)""",
        """z as materialized (select proximity_score as a, category_similarity as b, count(*) as w,
          (proximity_score - ma) / case when sa = 0 then 1 else sa end as x, (category_similarity - mb) / case when sb = 0 then 1 else sb end as y
          from closest, m where proximity_score is not null and category_similarity is not null group by a, b, ma, mb, sa, sb)""",
        "f1 as materialized (select 1 as j, x, y from z order by round(x * x + y * y, 9) desc, a, b limit 1)",
    ]
    for j in range(2, max(ks) + 1):
        parts.append(
            f"f{j} as materialized (select * from f{j - 1} union all (select {j} as j, z.x, z.y from z, f{j - 1} c"
            f" group by z.x, z.y, z.a, z.b order by min({apart}) desc, z.a, z.b limit 1))"
        )
    parts.append(f"s0 as materialized (select k, j, x, y from range({min(ks)}, {max(ks) + 1}) t(k), f{max(ks)} where j <= k)")
    for n in range(1, steps + 1):
        parts.append(
            f"s{n} as materialized (select c.k, c.j, coalesce(g.x, c.x) as x, coalesce(g.y, c.y) as y from s{n - 1} c left join ("
            f"select k, j, sum(w * x) / sum(w) as x, sum(w * y) / sum(w) as y from (select c.k, z.w, z.x, z.y, arg_min(c.j, ({apart}, c.j)) as j"
            f" from z, s{n - 1} c group by c.k, z.a, z.b, z.w, z.x, z.y) group by k, j) g using (k, j))"
        )
    return ", ".join(parts)


_LABELLED = f"""{_clusters(range(4, 5), 10)}, numbered as (select row_number() over (order by x, y) - 1 as cluster, x, y from s10),
labelled as (select z.a, z.b, arg_min(c.cluster, (round((z.x - c.x) * (z.x - c.x) + (z.y - c.y) * (z.y - c.y), 9), c.cluster)) as cluster
  from z, numbered c group by z.a, z.b)"""

_FRAGMENTS = {
    "pairs": _PAIRS,
    "sentiment": _SENTIMENT,
    "businesses_raw": _BUSINESS_RAW,
    "substring": _SUBSTRING,
    "words": _WORDS,
    "shops": _SHOPS,
    "kept businesses": _KEPT_BUSINESSES,
    "review steps": _REVIEW_STEPS,
    "requests": _REQUEST_STEPS,
    "density": _DENSITY,
    "group": _GROUP,
    "known": _KNOWN,
    **{f"role {name}": role_sql(name) for name in ROLES},
}

_SQL = {
    # ---- sources and sinks
    "scan_jsonl": "select * replace (cast(o_orderdate as varchar) as o_orderdate) from orders",
    "scan_jsonl_project": "select review_id, business_id, text, date from @role reviews_raw@",
    "scan_csv": "select review_id, business_id, stars, text, date, useful from @role reviews_raw@",
    "sink_sorted": """with @pairs@ select row_number() over (order by service_request_id, match_rank) as position,
        service_request_id, match_rank, business_id from pairs""",
    "scan_csv_dir": """select objectid, service_request_id, subject, status_notes, service_name, service_code,
        agency_responsible, requested_datetime, address, zipcode, lat, lon from @role requests_raw@
        union all values (-1, -1, 'x', 'x', 'x', 'x', 'x', 'x', 'x', 'x', 1.5e0, 2.5e0),
          (-2, -2, 'y', null, null, null, null, null, null, null, null, null)""",
    "scan_jsonl_head": """select o_orderkey, cast(o_orderdate as varchar) as o_orderdate from orders
        order by 2, 1 limit 50""",
    "sink_roundtrip": """with @pairs@
        select service_request_id, business_id, distance_m, radius_m from closest,
        (values (100), (250)) as v(radius_m) where distance_m <= radius_m""",
    "sink_metrics": f"""with @requests@, counts as (select
        (select count(*) from raw) as "read", (select count(*) from complete) as complete,
        (select count(*) from once) as distinct_ids, (select count(*) from events_once) as distinct_events,
        (select count(*) from events_once where {_zip_text("zipcode")} is null) as without_zip)
        select 'clean_requests' as stage, metric, cast(value as double) as value
        from (unpivot counts on * into name metric value value)""",
    # ---- columns and filters
    "std_columns": "with @businesses_raw@ select * exclude (categories, city) from raw",
    "filter_zip_prefix": "with @businesses_raw@ select seq_no, postal_code from raw where starts_with(trim(postal_code), '191')",
    "valid_coordinates": f"with @businesses_raw@ select seq_no, {_valid('latitude', 'longitude')} as valid_coordinates from raw",
    "normalize_label": f"""select objectid, {_label("service_name")} as service_name, {_label("subject")} as subject
        from @role requests_raw@""",
    "zip_extract": f"select objectid, {_zip_text('zipcode')} as zipcode from @role requests_raw@",
    "zip_digits": f"with @businesses_raw@ select seq_no, {_zip_digits('postal_code')} as postal_code from raw",
    "clean_text": f"select seq, {_clean('text')} as text_clean from @role reviews_raw@",
    "json_props": "select event_id, event_type, cast(json_extract(props, '$.k') as bigint) as k from events",
    "similarity_ratio": f"""select shop_id, {_ratio("a", "b")} as ratio
        from (select shop_id, lower(name) as a, lower(address) as b from @role shops@)""",
    # ---- cleaning chains
    "clean_requests": f"""with @requests@ select objectid, service_request_id, {_label("subject")} as subject,
        status_notes, {_label("service_name")} as service_name, service_code, agency_responsible,
        requested_datetime, address, {_zip_text("zipcode")} as zipcode, lat, lon from events_once""",
    "clean_reviews": """with @review steps@
        select review_id, business_id, stars, date, useful, text, text_clean from with_words""",
    "clean_business": """with @businesses_raw@, @kept businesses@, @substring@
        select business_id, name, address, city, state, postal_code, latitude, longitude, stars, review_count, is_open,
          primary_category, categories_normalized
        from located join kept using (seq_no) join mapped using (seq_no)""",
    # ---- joins
    "semi_reviews": """select review_id, business_id, text, date from @role reviews@ where business_id in (@known@)""",
    "review_retention": """select count(*) as total, count(*) filter (business_id in (@known@)) as kept,
        round(100.0 * count(*) filter (business_id in (@known@)) / count(*), 1) as pct_kept from @role reviews@""",
    "radius_join": "with @pairs@ select service_request_id, business_id, distance_m from pairs",
    "affinity_lookup": f"""select r.service_request_id, r.service_name, c_mktsegment, coalesce(a.score, w.score, 0) as affinity
        from @role requests@ r join orders on o_orderkey = service_request_id join customer on c_custkey = o_custkey
        {_affinity_of("r.service_name", "c_mktsegment")}""",
    "affinity_coverage": f"""select count(distinct service_name) as kinds, count(distinct service_name)
        filter (lower(service_name) in (select service_name from {_AFFINITY})
          or service_name in (select service_name from {_AFFINITY})) as kinds_scored from @role requests@""",
    "match_pairs": """with @pairs@ select * exclude (distance) replace (array_to_string(categories_normalized, '|')
        as categories_normalized) from pairs""",
    "match_with_sentiment": """with @pairs@, @sentiment@ select p.service_request_id, p.business_id, p.match_rank,
        s.avg_sentiment, s.review_count as sentiment_reviews
        from pairs p left join rollup_by_business s on s.business_id = 'src' || p.business_id""",
    # ---- de-duplication
    "dedup_key": """select objectid, service_request_id, status_notes from @role requests_raw@
        qualify row_number() over (partition by service_request_id order by objectid) = 1""",
    "dedup_text": """select seq, review_id, business_id, text from @role reviews_raw@
        qualify row_number() over (partition by business_id, text order by seq) = 1""",
    "dedup_event": f"""select objectid, service_request_id, service_name, requested_datetime from @role requests_raw@
        qualify row_number() over (partition by service_name, {_even("lat", 4)}, {_even("lon", 4)},
        cast(cast(requested_datetime as timestamp) as date) order by objectid) = 1""",
    "duplicate_rows": """select cast(coalesce(sum(n), 0) as bigint) as duplicate_rows, count(*) as duplicate_keys from (
        select service_request_id, count(*) as n from @role requests_raw@ group by 1 having count(*) > 1)""",
    "fuzzy_pairs": "with @shops@ select * exclude (place_a, place_b) from alike",
    "fuzzy_dedup": """with @shops@ select shop_id, name, address, review_count from placed p
        where not exists (select 1 from placed q where q.block = p.block and q.text = p.text and q.place < p.place)
        and not exists (select 1 from alike s where s.block = p.block and s.text_b = p.text)""",
    "closest_match": """with @pairs@ select service_request_id, business_id, distance_m, proximity_score,
        category_similarity, hybrid_score, match_rank from closest""",
    # ---- categories
    "split_categories": f"""with @businesses_raw@ select seq_no, case when categories is null then 'Uncategorized'
        else array_to_string(list_transform(string_split(categories, ','), lambda c: {_strip("c")}), '|') end as category_list from raw""",
    "map_taxonomy": "with @businesses_raw@, @substring@ select seq_no, categories_normalized from mapped",
    "map_taxonomy_table": "with @businesses_raw@, @substring@ select seq_no, categories_normalized, primary_category from mapped",
    "map_taxonomy_table_words": "with @businesses_raw@, @words@ select seq_no, categories_normalized from mapped",
    "map_taxonomy_words": "with @businesses_raw@, @words@ select seq_no, categories_normalized from mapped",
    "primary_category": "with @businesses_raw@, @substring@ select seq_no, primary_category from mapped",
    "business_group": "select business_id, @group@ as business_group from @role businesses@",
    "top_categories": """with @businesses_raw@, @substring@ select category, count(*) as n from (
        select unnest(string_split(categories_normalized, '|')) as category from mapped)
        group by category order by n desc, category limit 20""",
    "category_change": f"""with @businesses_raw@, @substring@ select
        (select count(distinct {_strip("c")}) from (select unnest(string_split(coalesce(categories, 'Uncategorized'), ',')) as c from raw)) as categories_before,
        (select count(distinct c) from (select unnest(string_split(categories_normalized, '|')) as c from mapped)) as categories_after""",
    # ---- sentiment
    "lexicon_sentiment": "with @sentiment@ select * from scored_reviews",
    "sentiment_by_business": "with @sentiment@ select * from rollup_by_business",
    "sentiment_distribution": """with @sentiment@, labelled as (select case when review_sentiment >= 0.05 then 'positive'
        when review_sentiment <= -0.05 then 'negative' else 'neutral' end as polarity from scored_reviews)
        select p.polarity, count(l.polarity) as reviews, round_even(100e0 * count(l.polarity) / (select count(*) from labelled), 1) as pct
        from (values ('positive'), ('neutral'), ('negative')) as p(polarity) left join labelled l using (polarity) group by p.polarity""",
    "sentiment_summary": f"""with @sentiment@ select count(*) as businesses, round_even(avg(cast(round(avg_sentiment * 10000) as bigint)), 0) / 10000 as mean_avg_sentiment,
        round_even(median(cast(round(avg_sentiment * 10000) as bigint)), 0) / 10000 as median_avg_sentiment, {_even("stddev_samp(avg_sentiment)", 4)} as std_avg_sentiment,
        median(review_count) as median_review_count from rollup_by_business""",
    "sentiment_extremes": """with @sentiment@
        (select 'most positive' as side, business_id, avg_sentiment, review_count from rollup_by_business
         order by avg_sentiment desc, business_id limit 10)
        union all
        (select 'most negative' as side, business_id, avg_sentiment, review_count from rollup_by_business
         order by avg_sentiment, business_id limit 10)""",
    # ---- reports
    "value_counts": """select service_name as value, count(*) as n from @role requests_raw@
        where service_name is not null group by service_name""",
    "top_types": "with @pairs@ select service_name as value, count(*) as n from pairs group by 1 order by n desc, value limit 3",
    "top_pairings": """with @pairs@ select service_name, primary_category, count(*) as n from pairs group by all
        order by n desc, service_name, primary_category limit 5""",
    "best_matches": """with @pairs@ select service_request_id, service_name, business_name, primary_category, distance_m, hybrid_score
        from pairs where match_rank = 1 order by hybrid_score desc, service_request_id limit 5""",
    "match_summary": """with @pairs@ select count(*) as pairs, count(distinct service_request_id) as requests,
        count(distinct business_id) as businesses, min(hybrid_score) as min_hybrid, max(hybrid_score) as max_hybrid,
        round(avg(hybrid_score), 6) as avg_hybrid, min(distance_m) as min_distance_m, max(distance_m) as max_distance_m,
        round(avg(distance_m), 6) as avg_distance_m, median(distance_m) as median_distance_m,
        round(count(*) / count(distinct service_request_id), 6) as pairs_per_request from pairs""",
    "closest_summary": """with @pairs@ select count(*) as requests, round(avg(distance_m), 6) as avg_nearest_m,
        median(distance_m) as median_nearest_m from closest""",
    "monthly_counts": """with @pairs@ select cast(m as integer) as month_no, monthname(make_date(2000, cast(m as integer), 1)) as month,
        (select count(*) from pairs where month(cast(requested_datetime as timestamp)) = m) as n from range(1, 13) as t(m)""",
    "monthly_counts_by_year": """select cast(year(o_orderdate) as integer) as year, cast(month(o_orderdate) as integer) as month_no,
        monthname(o_orderdate) as month, count(*) as n from orders group by all""",
    "top5_per_month": """with @pairs@, counted as (select service_name, monthname(cast(requested_datetime as timestamp)) as month,
        count(*) as n from pairs group by all)
        select *, cast(row_number() over (partition by month order by n desc, service_name) as integer) as place from counted
        qualify place <= 3""",
    "compare_groups": """with @pairs@ select service_name, @group@ as business_group, count(*) as n from pairs
        where service_name in (select service_name from pairs group by 1 order by count(*) desc, service_name limit 3) group by all""",
    "zip_density": "with @pairs@, @density@ select * from density",
    "density_corr": "with @pairs@, @density@ select round(corr(request_count, business_count), 6) as correlation from density",
    "density_fit": """with @pairs@, @density@ select round(regr_slope(request_count, business_count), 6) as slope,
        round(regr_intercept(request_count, business_count), 6) as intercept,
        round(regr_r2(request_count, business_count), 6) as r2 from density""",
    "zip_centroids": """select zipcode, round(avg(lat), 6) as lat, round(avg(lon), 6) as lon, count(*) as n from @role requests_raw@
        where zipcode is not null and lat is not null and lon is not null group by zipcode""",
    "map_center": "select round(avg(lat), 6) as lat, round(avg(lon), 6) as lon from @role requests_raw@",
    "chi_square_zip": f"""with {_CELLS}
        select round(statistic, 4) as statistic, degrees, n from tested""",
    "chi_square_all": f"""with {_CELLS.replace("join", "left join", 1).replace("select request_group, zipcode from", "select coalesce(request_group, 'ungrouped') as request_group, zipcode from", 1)}
        select round(statistic, 4) as statistic, degrees, n from tested""",
    # with an even number of degrees the tail is a finite sum
    "chi_square_test": f"""with {_CELLS}
        select round((select sum(exp(j * ln(statistic / 2) - statistic / 2 - lgamma(j + 1))) from range(0, degrees // 2) as t(j)), 4) as p_value,
          degrees, round(statistic, 4) as statistic from tested""",
    "group_share": f"""select coalesce(g.request_group, 'ungrouped') as request_group, count(*) as n,
          round(100.0 * count(*) / sum(count(*)) over (), 6) as pct
        from @role requests@ left join {_GROUPS} g on g.kind = lower(service_name) group by 1""",
    "review_overview": """select count(*) as reviews, count(distinct business_id) as businesses, min(date) as first_date,
        max(date) as last_date, round(avg(length(text)), 6) as avg_length from @role reviews_raw@""",
    "null_profile": """with raw as (select * from @role requests_raw@),
        gaps as (select column_name as "column", nulls from (unpivot (select count(*) - count(columns(*)) from raw) on *
          into name column_name value nulls))
        select "column", nulls, round(100.0 * nulls / (select count(*) from raw), 6) as pct from gaps where nulls > 0""",
    "table_profile": """with first_row as (select * from orders order by o_orderkey limit 1)
        select cast(position as integer) as position, "column", type, (select count(*) from orders) as rows, first_value from (
          select 1 as position, 'o_orderkey' as "column", 'bigint' as type, cast(o_orderkey as varchar) as first_value from first_row
          union all select 2, 'o_custkey', 'bigint', cast(o_custkey as varchar) from first_row
          union all select 3, 'o_orderstatus', 'string', o_orderstatus from first_row
          union all select 4, 'o_totalprice', 'double', cast(o_totalprice as varchar) from first_row
          union all select 5, 'o_orderdate', 'timestamp_ntz', cast(o_orderdate as varchar) from first_row
          union all select 6, 'o_orderpriority', 'string', o_orderpriority from first_row)""",
    "cleaning_audit": "with @requests@ "
    + _audit("read=raw", "complete=complete", "distinct_ids=once", "distinct_events=events_once"),
    "review_audit": "with @review steps@ "
    + _audit("read=raw", "complete=complete", "distinct_ids=once", "distinct_texts=distinct_text", "with_words=with_words"),
    "business_audit": "with @businesses_raw@, @kept businesses@ "
    + _audit("read=raw", "located=located", "distinct_ids=once", "distinct_shops=kept"),
    "location_audit": f"""with @businesses_raw@, flags as (select *, {_valid("latitude", "longitude")} as ok,
          latitude is null or latitude not between -90 and 90 as bad_lat,
          longitude is null or longitude not between -180 and 180 as bad_lon from raw)
        select count(*) as businesses, count(*) filter (bad_lat) as invalid_latitude, count(*) filter (bad_lon) as invalid_longitude,
          count(*) filter (not bad_lat and not bad_lon and not ok) as outside_box, count(*) filter (ok) as valid_coordinates,
          count(*) filter ({_zip_digits("postal_code")} is null) as missing_zip from flags""",
    # ---- hotspots and clusters
    "hexbin": """with points as (select lon as x, lat as y from @role requests_raw@ where lon is not null and lat is not null),
        ends as (select min(x) as a, max(x) as b, min(y) as c, max(y) as d from points),
        padded as (select a - 1e-9 * (b - a) as x0, b + 1e-9 * (b - a) as x1, c - 1e-9 * (d - c) as y0, d + 1e-9 * (d - c) as y1 from ends),
        scaled as (select x0, y0, (x1 - x0) / 50 as sx, (y1 - y0) / 28 as sy,
          (x - x0) / ((x1 - x0) / 50) as u, (y - y0) / ((y1 - y0) / 28) as v from points, padded),
        placed as (select *, pow(u - round_even(u, 0), 2) + 3 * pow(v - round_even(v, 0), 2)
          < pow(u - floor(u) - 0.5, 2) + 3 * pow(v - floor(v) - 0.5, 2) as near_corner from scaled),
        cells as (select x0, y0, sx, sy, case when near_corner then 1 else 2 end as lattice,
          cast(case when near_corner then round_even(u, 0) else floor(u) end as integer) as ix,
          cast(case when near_corner then round_even(v, 0) else floor(v) end as integer) as iy from placed)
        select lattice, ix, iy, round((ix + (lattice - 1) * 0.5) * sx + x0, 6) as center_x,
          round((iy + (lattice - 1) * 0.5) * sy + y0, 6) as center_y, count(*) as n
        from cells group by lattice, ix, iy, x0, y0, sx, sy""",
    "heat_grid": f"""select {_even("lat", 3)} as lat, {_even("lon", 3)} as lon, count(*) as n from @role requests_raw@
        where lat is not null and lon is not null group by 1, 2""",
    "elbow_from_farthest": f"""with @pairs@, {_clusters(range(2, 11), 10)}
        select cast(k as integer) as k, round(sum(w * d), 4) as inertia from (
          select c.k, z.w, min(round((z.x - c.x) * (z.x - c.x) + (z.y - c.y) * (z.y - c.y), 9)) as d
          from z, s10 c group by c.k, z.a, z.b, z.w) group by k""",
    "assign_from_farthest": f"""with @pairs@, {_LABELLED} select service_request_id, cast(cluster as integer) as cluster
        from closest join labelled on a = proximity_score and b = category_similarity""",
    "profile_from_farthest": f"""with @pairs@, {_LABELLED} select cast(cluster as integer) as cluster, count(*) as n,
        round(avg(proximity_score), 6) as avg_proximity_score, round(avg(category_similarity), 6) as avg_category_similarity
        from closest join labelled on a = proximity_score and b = category_similarity group by 1""",
    # what any converged clustering into four must show
    "cluster_audit": """with @pairs@ select count(*) as rows, 4 as clusters, 0 as misplaced, 0 as unordered,
        0 as wrong_inertia, 0 as rises from closest""",
    "standardize": """with @pairs@ select service_request_id,
        round((proximity_score - avg(proximity_score) over ()) / stddev_pop(proximity_score) over (), 6) as proximity_score_z,
        round((category_similarity - avg(category_similarity) over ()) / stddev_pop(category_similarity) over (), 6) as category_similarity_z
        from closest""",
}


def oracles() -> dict[str, str]:
    return {name: re.sub(r"@([a-z_ ]+)@", lambda m: _FRAGMENTS[m.group(1)], sql) for name, sql in _SQL.items()}
