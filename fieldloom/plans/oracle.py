"""DuckDB twins of the queries."""

from __future__ import annotations

from fieldloom.functions.text import DROPPED_TAGS, ENTITIES
from fieldloom.operators.extract import REPLY_KEYS
from fieldloom.plans.queries import AS_OF, EVENT_FIELDS
from fieldloom.schema import ROUTES

_WHITE = r"[\t\n\x0b\f\r \x{00A0}]"


def _quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _strip(x: str) -> str:
    return rf"regexp_replace({x}, '^{_WHITE}+|{_WHITE}+$', '', 'g')"


def _text(html: str, cap: int | None = 8000) -> str:
    x = html
    for tag in DROPPED_TAGS:
        x = rf"regexp_replace({x}, '(?is)<{tag}\b[^>]*>.*?</{tag}\s*>', chr(1), 'g')"
    x = rf"regexp_replace(regexp_replace({x}, '(?s)<!--.*?-->', chr(1), 'g'), '(?s)<[^>]*>', chr(1), 'g')"
    for name, char in ENTITIES.items():
        x = f"replace({x}, {_quoted(name)}, {_quoted(char)})"
    whole = f"array_to_string(list_filter(list_transform(string_split({x}, chr(1)), lambda s: {_strip('s')}), lambda s: s <> ''), ' ')"
    return f"substring({whole}, 1, {cap})" if cap else whole


_BASE = "regexp_extract(url, '^([a-z]+://[^/?#]+)', 1)"
_NUMBER = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_EXT = "ext as (select user_id as entity_id, event_type as field, value, cast(json_extract_string(props, '$.k') as int) / 100.0 as confidence, cast(json_extract_string(props, '$.k') as int) < 70 as needs_review, ts as observed_at, event_id as seq from events)"
_NEWEST = f"{_EXT}, newest as (select * from ext qualify row_number() over (partition by entity_id, field order by observed_at desc, seq desc) = 1)"


def _generic(name: str, value: str, c: str, required: str) -> tuple[str, str]:
    score = f"case when {value} is null then case when {required} then 0.0 else 0.5 end else {c} end"
    issue = f"case when {value} is null then case when {required} then {name} || ': missing (required)' else {name} || ': not found (optional)' end when {c} < 0.7 then {name} || ': low confidence (' || format('{{:.2f}}', {c}) || ')' end"
    return score, issue


def _percent(text: str, c: str) -> tuple[str, str]:
    bare = _strip(f"replace({text}, '%', '')")
    rate = f"case when regexp_matches({bare}, '{_NUMBER}') then try_cast({bare} as double) end"
    score = f"case when {text} is null then 0.4 when ({rate}) is null then least({c}, 0.5) when ({rate}) < 0 or ({rate}) > 100 then 0.0 else {c} end"
    issue = f"case when {text} is null then 'acceptance_rate: not found' when ({rate}) is null then 'acceptance_rate: could not parse as number' when ({rate}) < 0 or ({rate}) > 100 then 'acceptance_rate: implausible value ' || cast(({rate}) as varchar) end"
    return score, issue


_G = _generic("field", "value", "confidence", "field = 'click'")
_P = _percent("cast(value as varchar)", "confidence")
_SCORED = f"""{_NEWEST}, scored as (select entity_id, field, round(case when field = 'purchase' then {_P[0]} else {_G[0]} end, 6) as score,
  case when field = 'purchase' then {_P[1]} else {_G[1]} end as issue from newest)"""
_FIELDS = "fields(pos, field) as (values " + ", ".join(f"({i}, '{f}')" for i, f in enumerate(EVENT_FIELDS)) + ")"
_FULL = f"{_SCORED}, {_FIELDS}, full_ as (select e.entity_id, f.field, f.pos, coalesce(s.score, 0.0) as score from (select distinct entity_id from scored) e cross join fields f left join scored s on s.entity_id = e.entity_id and s.field = f.field)"


_GRID = f"""{_NEWEST}, {_FIELDS}, asked as (select c_custkey as entity_id, f.field, f.pos, n.value, coalesce(n.confidence, 0.0) as confidence from customer cross join fields f left join newest n on n.entity_id = c_custkey and n.field = f.field),
 grid as (select entity_id, field, pos, case when field = 'purchase' then {_P[0]} else {_G[0]} end as score, case when field = 'purchase' then {_P[1]} else {_G[1]} end as issue from asked)"""
_STORED = f"""{_NEWEST}, stored as (select cast(entity_id as varchar) as entity_id, case field when 'view' then 'about_raw' when 'purchase' then 'acceptance_raw' else 'visa_raw' end as storage_key, field, seq,
 case field when 'view' then '{{"n":' || seq || '}}' when 'purchase' then '"' || cast(cast(value as decimal(10,2)) as varchar) || '"' end as value_json, cast(cast(value as decimal(10,2)) as double) as number, confidence, needs_review,
 case when seq % 3 = 0 then 'third' end as notes from newest where field in ('view', 'purchase', 'signup'))"""


def _routes() -> str:
    text = lambda x: "null" if x is None else _quoted(x)
    return "routes(storage_key, a, b, c, d) as (values " + ", ".join(f"({text(r.storage_key)}, {text(r.text_label)}, {text(r.text_fallback)}, {text(r.url_label)}, {text(r.url_fallback)})" for r in ROUTES) + ")"


_LABELS = "['about', 'tuition', 'living', 'scholarships', 'deadlines', 'visa', 'employment', 'courses']"
_SHAPES = r"""shaped as (select event_id, event_id % 7 as shape, value, json_extract_string(props, '$.k') as k from events)"""
_TEXT14 = "case o_orderkey % 6 when 0 then null when 1 then strftime(o_orderdate, '%Y-%m-%d') || 'T10:00:00+02:00' when 2 then strftime(o_orderdate, '%Y%m%d') when 3 then strftime(o_orderdate, '%Y-%m-%d') || ' or so' when 4 then '2025-02-30' else strftime(o_orderdate, '%Y-%m-%d') end"
_V13 = "case when seq % 11 = 0 then '-' || cast(cast(value as decimal(10,2)) as varchar) when seq % 5 = 0 then 'about half' when seq % 7 = 0 then null else ' ' || cast(cast(value as decimal(10,2)) as varchar) || '% ' end"
_P13 = _percent("t", "confidence")
_G11 = _generic("field", "v", "confidence", "field = 'click'")
_TWO = f"""{_EXT}, ranked as (select *, row_number() over (partition by entity_id, field order by observed_at desc, seq desc) - 1 as i from ext),
 side as (select entity_id, field, i, case when seq % 4 <> i then cast(cast(floor(value / 100) as bigint) as varchar) end as value, confidence, 'e:' || seq as source_url, needs_review from ranked where i < 2),
 m as (select p.entity_id, p.field, p.value as pv, s.value as sv, p.confidence as pc, s.confidence as sc, p.source_url as pu, s.source_url as su, p.needs_review as pr, s.needs_review as sr,
  case when p.value is null and s.value is null then 'neither' when p.value is null then 'secondary' when s.value is null then 'primary' when lower(p.value) = lower(s.value) then 'agree' else 'conflict' end as outcome
  from (select * from side where i = 0) p left join (select * from side where i = 1) s on s.entity_id = p.entity_id and s.field = p.field)"""


def oracle_sql() -> dict[str, str]:
    return {
        "q01_html_text": f"select page_id, length(t) as n_chars, md5(t) as text_md5, md5(substring(t, 1, 4000)) as prompt_md5 from (select page_id, {_text('html', cap=None)} as t from pages)",
        "q02_fetch_summary": f"select {_BASE} as base, count(*) filter (n > 0) as fetched, count(*) as total, cast(sum(n) as bigint) as chars from (select url, length({_text('html', cap=None)}) as n from pages) group by 1",
        "q03_robots_gate": f"""with p as (select page_id, url, {_BASE} as base, regexp_extract(url, '^[a-z]+://[^/?#]+(.*)$', 1) as path from pages),
 g as (select *, case when starts_with(base, 'http:') then not starts_with(path, '/de/') when contains(base, '//m.') then false else true end as allowed from p)
 select page_id, base, allowed, case when allowed then url end as fetch_url from g""",
        "q04_registry_explode": "select n_nationkey as entity_id, r_name as country, l.label, 'https://' || lower(n_name) || '.example/' || l.path as url from nation join region on n_regionkey = r_regionkey cross join (values ('about', 'about'), ('tuition', 'fees')) l(label, path)",
        "q05_route_fallback": f"""with {_routes()}, p as (select page_id // 8 as entity_id, {_LABELS}[page_id % 8 + 1] as label, case when page_id % 7 <> 0 then url end as url, case when page_id % 5 <> 0 then {_text('html')} end as text from pages),
 j as (select e.entity_id, r.storage_key, r.a, r.b, p1.text as t1, p2.text as t2, p3.url as u1, p4.url as u2 from (select distinct entity_id from p) e cross join routes r
  left join p p1 on p1.entity_id = e.entity_id and p1.label = r.a left join p p2 on p2.entity_id = e.entity_id and p2.label = r.b
  left join p p3 on p3.entity_id = e.entity_id and p3.label = r.c left join p p4 on p4.entity_id = e.entity_id and p4.label = r.d)
 select entity_id, storage_key, md5(coalesce(nullif(t1, ''), nullif(t2, ''), '')) as text_md5, coalesce(nullif(u1, ''), nullif(u2, ''), '') as url,
  case when length(t1) > 0 then a when length(t2) > 0 then b else '' end as used_label from j""",
        "q06_prompt_render": f"""select doc_id, length(p) as n_chars, md5(p) as prompt_md5 from (select doc_id, 'Institution: ' || source || ' (' || lang || '), amounts in USD' || chr(10) || 'Page: doc://' || doc_id || chr(10) || 'Wanted: about_university' || chr(10)
 || {_quoted("Answer with one JSON object of the keys " + ", ".join(REPLY_KEYS) + "; value is null when the page does not say.")} || chr(10) || 'Text:' || chr(10) || substring(text, 1, 4000) as p from documents)""",
        "q07_envelope_parse": f"""with {_SHAPES} select event_id, round(case when shape in (0, 1, 4, 5) then value end, 6) as value, round(case when shape in (0, 1) then cast(k as double) else 0.0 end, 6) as confidence,
 shape in (2, 3) as needs_review, case shape when 2 then 'parse_error' when 3 then 'not_object' end as notes from shaped""",
        "q08_upsert_latest": f"with {_NEWEST} select entity_id, field, round(value, 6) as value, round(confidence, 6) as confidence, cast(needs_review as int) as needs_review, seq from newest",
        "q09_upsert_entity": "select o_custkey as id, c_name as name, o_orderdate as scraped_at, round(o_totalprice, 2) as confidence from orders join customer on c_custkey = o_custkey qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1",
        "q10_merge_sources": f"""with {_TWO} select entity_id, field, case outcome when 'secondary' then sv else pv end as value,
 round(case outcome when 'secondary' then sc when 'agree' then least(1.0, pc + 0.1) else pc end, 6) as confidence, case outcome when 'secondary' then su else pu end as source_url,
 case outcome when 'agree' then false when 'conflict' then true when 'secondary' then sr else pr end as needs_review,
 case outcome when 'agree' then 'Cross-validated: secondary source agrees. (' || su || ')' when 'conflict' then 'CONFLICT: primary=' || pv || ' (from ' || pu || ') vs secondary=' || sv || ' (from ' || su || ')' end as notes, outcome from m""",
        "q11_check_generic": f"with {_EXT}, t as (select *, case when seq % 6 <> 0 then cast(value as varchar) end as v from ext) select seq, round({_G11[0]}, 6) as score, coalesce({_G11[1]}, '') as issues from t",
        "q12_check_currency": """with t as (select doc_id, case when doc_id % 9 <> 0 then text end as v, doc_id % 100 / 100.0 as c, case when doc_id % 4 = 0 then 'amounts in usd' else '' end as n from documents),
 o as (select *, not contains(upper(v), 'USD') and not contains(upper(n), 'USD') as off from t)
 select doc_id, round(case when v is null then 0.0 when off then least(c, 0.7) else c end, 6) as score, case when v is null then 'tuition_fees: not found' when off then 'tuition: currency may not match expected USD' else '' end as issues from o""",
        "q13_check_percent": f"with {_EXT}, t as (select *, {_V13} as t from ext) select seq, round({_P13[0]}, 6) as score, cast(({_P13[1]}) is not null as bigint) as n_issues, coalesce({_P13[1]}, '') as issue from t",
        "q14_check_deadline": f"""with t as (select o_orderkey, {_TEXT14} as v, o_orderkey % 6 as shape, cast(o_orderdate as date) as day, o_orderkey % 100 / 100.0 as c from orders),
 p as (select *, shape in (1, 2, 5) and day < date '{AS_OF}' as past from t)
 select o_orderkey, round(case when v is null then 0.4 when past then least(c, 0.6) else c end, 6) as score, case when v is null then 'intake_deadlines: not found' when past then 'intake_deadlines: deadline ' || v || ' is in the past' else '' end as issues from p""",
        "q15_entity_quality": f"""with {_GRID} select entity_id, round(avg(score), 3) as quality, round(avg(score), 3) >= 0.6 as ready, string_agg(field || '=' || format('{{:.4f}}', score) || ' ' || coalesce(issue, ''), ', ' order by pos) as fields from grid group by 1""",
        "q16_critical_issues": f"""with {_GRID} select entity_id, count(*) filter (bad) as n_critical, coalesce(string_agg(field || ' missing or implausible', ', ' order by pos) filter (bad), '') as critical
 from (select *, score < 0.5 and field in ('click', 'purchase') as bad from grid) group by 1""",
        "q17_field_entity_pivot": f"with {_FULL} select field, entity_id, format('{{:.6f}}', score) as score, round(avg(score) over (partition by field), 6) as avg_score from full_",
        "q18_field_averages": f"with {_FULL} select coalesce(field, '(all)') as field, round(avg(score), 6) as avg_score, count(*) as n from full_ group by rollup(field)",
        "q19_validation_flags": f"with {_SCORED} select entity_id, field, issue as issues from scored where issue is not null",
        "q20_value_preview": """select entity_id, 'about_university' as field, md5(p) as preview_md5, length(p) as n_chars from
 (select l.doc_id as entity_id, substring(coalesce(text, '—'), 1, 80) as p from labels l left join documents d on d.doc_id = l.doc_id)""",
        "q21_coverage": "select source, count(quality) as extracted, count(*) as attempted, round(avg(coalesce(quality, 0)), 6) as avg_confidence from documents left join labels using (doc_id) group by 1",
        "q22_spot_check_rate": "select count(*) filter (quality = cast(n_chars > 200 as int)) as matched, count(*) as checked, round(count(*) filter (quality = cast(n_chars > 200 as int)) / count(*), 6) as rate from labels join documents using (doc_id)",
        "q23_typed_record": f"""with {_NEWEST}, k as (select entity_id, max(case when field = 'view' then seq end) as vs, max(case when field = 'view' then confidence end) as vc, max(case when field = 'purchase' then value end) as pv, max(case when field = 'signup' then seq end) as ss from newest group by 1)
 select cast(c_custkey as varchar) as entity_id, c_name as name, cast(vs as int) as founding_year, case when vs is not null then 'c' || vs % 7 end as city, round(pv, 6) as percent, case when ss is not null then '' end as visa_country, case when ss is not null then 'type ' || ss % 3 end as visa_type, round(coalesce(vc, 0.0), 6) as about_confidence
 from customer left join k on k.entity_id = c_custkey""",
        "q24_list_text_parse": "select p_partkey, case when p_partkey % 10 <> 0 then 2 end as n_items, case when p_partkey % 10 <> 0 then replace(p_name, '''', '') end as second_name, case when p_partkey % 10 <> 0 then cast(p_size as varchar) end as first_value from part",
        "q25_dedup_urls": r"select lower(regexp_extract(url, '^([a-z]+://[^/?#]+)', 1)) || regexp_replace(regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1), '/+$', '') as url, min(page_id) as first_page, count(*) as n_pages from pages group by 1",
        "q26_stored_rows": f"with {_STORED} select entity_id as university_id, storage_key as field_name, coalesce(value_json, 'null') as value_json, round(confidence, 6) as confidence, 'e:' || seq as source_url, cast(needs_review as int) as needs_review, notes, '2024-01-01 00:00:00' as scraped_at from stored",
        "q27_output_documents": f"""with {_STORED}, k as (select entity_id, string_agg(storage_key, ',' order by case storage_key when 'about_raw' then 1 when 'acceptance_raw' then 5 else 8 end) as keys, max(case when field = 'view' then seq end) as about_n,
 max(case when field = 'view' then confidence end) as ac, max(case when field = 'view' then notes end) as about_notes, max(case when field = 'purchase' then number end) as pn, max(case when field = 'purchase' then confidence end) as pc,
 max(case when field = 'purchase' then json_extract_string(value_json, '$') end) as acceptance, max(case when field = 'signup' then 'student_visa_type_requirements_processing_time' end) as visa_field from stored group by 1),
 q as (select *, round((coalesce(ac, 0.0) + case when pn is null then 0.4 when pn > 100 then 0.0 else pc end + 0.0 + 0.5 * 6 + 0.4) / 10, 3) as quality from k)
 select entity_id, c_name as name, keys, about_n, acceptance, visa_field, about_notes, quality, quality >= 0.6 as ready from q join customer on cast(c_custkey as varchar) = entity_id""",
        "q28_entity_listing": "select o_custkey as id, 'Customer ' || o_custkey as name, o_orderdate as scraped_at, round(o_totalprice, 2) as confidence from orders qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1",
        "q29_upsert_second_run": f"""with {_EXT}, r as (select *, seq % 2 as run from ext),
 l as (select * from r qualify row_number() over (partition by entity_id, field, run order by observed_at desc, seq desc) = 1)
 select entity_id, field, round(value, 6) as value, round(confidence, 6) as confidence, observed_at, seq from l qualify row_number() over (partition by entity_id, field order by run desc) = 1""",
    }
