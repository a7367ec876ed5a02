"""The catalog's queries in SQL, over the same tables."""

from __future__ import annotations

from quotarium.operators.prompts import HEAD, tail
from quotarium.plans.derived import CATEGORY, DEFECTS, FABRICATED, FRAMEWORK, GOOD_CODE, RUN_TS


def _text(x: str | None) -> str:
    return "''" if x is None else "'" + x.replace("'", "''") + "'"


def _rows(rows) -> str:
    return ", ".join("(" + ", ".join([*map(_text, r), str(i)]) + ")" for i, r in enumerate(rows))


def _with(*ctes: str, query: str) -> str:
    return f"with {', '.join(ctes)} {query}"


_COLS = "category, code, description, inclusion_criteria, exclusion_criteria"
RAW = f"raw({_COLS}, ord) as (values {_rows(FRAMEWORK)})"
BAD = f"raw({_COLS}, ord) as (values {_rows(DEFECTS)})"
FW = f"fw as (select {', '.join(f'trim({c}) as {c}' for c in _COLS.split(', '))}, ord::bigint as ord from raw)"
CATS = "cats as (select category, row_number() over (order by min(ord)) as cat_ord, count(*) as n_codes, string_agg(code, ',' order by ord) as codes from fw group by category)"
DOCS = "docs as (select *, printf('doc_%06d.pdf', doc_id) as filename from documents)"
FILES = "files as (select filename, 'file_' || doc_id as file_id, row_number() over (order by filename) as idx from docs)"
SPACES = r"[\s\x0b\x1c-\x1f\x85\p{Z}]+"


def _cf(x: str) -> str:
    return f"replace(lower({x}), 'ß', 'ss')"


def _norm(x: str) -> str:
    """Of texts without the odd characters that only NFKC folds."""
    return rf"trim(regexp_replace(regexp_replace({x}, '([\p{{L}}\p{{N}}_])-[ \t]*\n[ \t]*([\p{{L}}\p{{N}}_])', '\1\2', 'g'), '{SPACES}', ' ', 'g'))"


PAGES = f"pages_ as (select filename, i::bigint as page_no, {_cf(_norm('line'))} as cf from (select filename, unnest(string_split(coalesce(text, ''), chr(10))) as line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as i from docs))"
PLACED = "placed as (select *, coalesce(sum(length(cf) + 1) over (partition by filename order by page_no rows between unbounded preceding and 1 preceding), 0)::bigint as start from pages_)"
TEXTS = "texts as (select filename, string_agg(cf, ' ' order by page_no) as full_cf, list(start order by page_no) as starts from placed group by filename)"
CORPUS = (DOCS, PAGES, PLACED, TEXTS)


def _page(place: str) -> str:
    return f"len(list_filter(starts, lambda s: s <= {place}))::bigint"


def _found(kind: str, quote: str) -> str:
    return f"""f_{kind} as (select '{kind}_' || (doc_id // 2) as snippet_id, case when doc_id % 7 = 3 then 'elsewhere.pdf' else filename end as filename,
        case when doc_id % 7 = 5 then {_text(FABRICATED)} else {quote} end as snippet, doc_id as finding_ord
        from (select *, substr(text, 1 + (doc_id * 37) % greatest(length(text) - 120, 1), 100) as cut from docs))"""


EXACT = _found("exact", "case when doc_id % 2 = 0 then upper(cut) else replace(cut, ' ', ' ') end")
FRAGMENTED = _found("fragmented", "substr(cut, 1, 30) || ' ... ' || substr(cut, 61, 30)")
SPLIT = r"\s*(?:\[\s*\.\.\.\s*\]|\.\s*\.\s*\.)\s*"


def _verdicts(kind: str) -> tuple[str, ...]:
    """Exact and fragmented rungs; at most two pieces occur in these quotes."""
    return (
        f"n_{kind} as (select *, {_cf(_norm('snippet'))} as needle, list_transform(list_filter(regexp_split_to_array(snippet, '{SPLIT}'), lambda p: trim(p) <> ''), lambda p: {_cf(_norm('p'))}) as pieces from f_{kind})",
        f"j_{kind} as (select n.*, full_cf, starts, case when needle <> '' then instr(full_cf, needle) - 1 else -1 end as p0, case when len(pieces) = 2 then instr(full_cf, pieces[1]) - 1 else -1 end as p1 from n_{kind} n left join texts using (filename))",
        f"q_{kind} as (select *, case when p1 < 0 then -1 when instr(substr(full_cf, (p1 + length(pieces[1]) + 1)::bigint), pieces[2]) > 0 then p1 + length(pieces[1]) + instr(substr(full_cf, (p1 + length(pieces[1]) + 1)::bigint), pieces[2]) - 1 else instr(full_cf, pieces[2]) - 1 end as p2 from j_{kind})",
        f"""v_{kind} as (select snippet_id, filename, finding_ord,
            case when full_cf is null then 'pdf_missing' when length(trim(full_cf)) < 50 then 'no_text_layer' when p0 >= 0 then 'verified' when p1 >= 0 and p2 >= 0 then 'verified_fragmented' else 'not_found' end as verification_status,
            case when p0 >= 0 then p0 when p1 >= 0 and p2 >= 0 then least(p1, p2) end as place, starts from q_{kind})""",
        f"""verdicts_{kind} as (select snippet_id, filename, finding_ord, verification_status, case when verification_status in ('verified', 'verified_fragmented') then 100.0::double else 0.0::double end as match_score,
            case verification_status when 'verified' then 'exact' when 'verified_fragmented' then 'fragmented' else 'none' end as match_method,
            case when verification_status in ('verified', 'verified_fragmented') then {_page('place')} end as page_number from v_{kind})""",
    )


FUZZY = _found("fuzzy", r"regexp_replace(cut, '^(.{40}).(.{30}).', '\1~\2~')")
SHOWN = f"shown as (select filename, string_agg(display, ' ' order by page_no) as full_display from (select filename, i as page_no, {_norm('line')} as display from (select filename, unnest(string_split(coalesce(text, ''), chr(10))) as line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as i from docs)) group by filename)"
#: Windows of every STEP-th place are scored first. A window that moves on by one changes its LCS by one at most, so between two of them only such are scored that could be the best.
STEP = 8


def _aligned(kind: str) -> tuple[str, ...]:
    """All three rungs. The LCS is kept as a bit vector of at most 126 bits; the shorter text slides over the longer one."""
    k = kind
    run = lambda part: f"n - bit_count(list_reduce({part}, lambda v, x: ((v + (v & x)) | xor(v, v & x)) & every, every))::bigint"
    return (
        f"open_{k} as (select finding_ord, needle, full_cf, length(needle) as nn, length(full_cf) as nt from q_{k} where full_cf is not null and length(trim(full_cf)) >= 50 and needle <> '' and p0 < 0 and not (p1 >= 0 and p2 >= 0))",
        f"pairs_{k} as (select finding_ord, nt, 0 as swapped, needle as a, full_cf as b, nn as n, nt as m from open_{k} where nn <= nt union all select finding_ord, nt, 1, full_cf, needle, nt, nn from open_{k} where nn >= nt)",
        f"letters_{k} as (select finding_ord, swapped, c, sum(1::hugeint << (i - 1)::hugeint)::hugeint as mask from (select finding_ord, swapped, unnest(string_split(a, '')) as c, generate_subscripts(string_split(a, ''), 1) as i from pairs_{k}) group by all)",
        f"places_{k} as (select finding_ord, swapped, unnest(string_split(b, '')) as c, generate_subscripts(string_split(b, ''), 1) as i from pairs_{k})",
        f"masks_{k} as (select finding_ord, swapped, list(coalesce(mask, 0::hugeint) order by i) as ms from places_{k} left join letters_{k} using (finding_ord, swapped, c) group by all)",
        f"ready_{k} as materialized (select p.finding_ord, p.swapped, p.nt, p.n::bigint as n, p.m::bigint as m, ms, (1::hugeint << p.n::hugeint) - 1 as every from pairs_{k} p join masks_{k} using (finding_ord, swapped))",
        f"some_{k} as materialized (select finding_ord, swapped, pos, {run('ms[pos + 1 : pos + n]')} as v from (select *, unnest(list_distinct(list_append(range(0, m - n + 1, {STEP}), m - n))) as pos from ready_{k}))",
        f"gaps_{k} as (select *, lead(pos) over w as next_pos, lead(v) over w as next_v, max(v) over (partition by finding_ord, swapped) as top from some_{k} window w as (partition by finding_ord, swapped order by pos))",
        f"rest_{k} as (select finding_ord, swapped, pos, {run('ms[pos + 1 : pos + n]')} as v from (select r.*, unnest(range(g.pos + 1, g.next_pos)) as pos from gaps_{k} g join ready_{k} r using (finding_ord, swapped) where (g.v + g.next_v + g.next_pos - g.pos) // 2 >= g.top))",
        f"full_{k} as (select finding_ord, swapped, pos, v from some_{k} union all select * from rest_{k})",
        f"best_full_{k} as (select finding_ord, swapped, max(v) as v, arg_max(pos, (v, -pos)) as pos from full_{k} group by all)",
        f"parts_{k} as (select finding_ord, swapped, nt, n, m, p, p as place, 0 as a, p as z, {run('ms[1 : p]')} as v from (select *, unnest(range(1, n)) as p from ready_{k}) union all select finding_ord, swapped, nt, n, m, p, n + m + n - p, m - p, m, {run('ms[m - p + 1 : m]')} from (select *, unnest(range(1, n)) as p from ready_{k}))",
        f"scored_{k} as (select finding_ord, swapped, nt, place, a, z, 200.0::double * v / (n + p) as score from parts_{k} union all select finding_ord, swapped, r.nt, r.n + f.pos, f.pos, f.pos + r.n, 100.0::double * f.v / r.n from best_full_{k} f join ready_{k} r using (finding_ord, swapped))",
        f"won_{k} as (select finding_ord, score, case when swapped = 1 then 0 else a end as a, case when swapped = 1 then nt else z end as z from (select *, row_number() over (partition by finding_ord order by score desc, swapped, place) as r from scored_{k}) where r = 1)",
        f"""ladder_{k} as (select v.snippet_id, v.filename, v.finding_ord,
            case when verification_status <> 'not_found' or score is null or score < 93 then verification_status when score >= 97 and length(q.needle) >= 40 then 'verified_fuzzy' else 'near_match' end as verification_status,
            case when verification_status in ('verified', 'verified_fragmented') then 100.0::double else coalesce(score, 0.0::double) end as match_score,
            case verification_status when 'verified' then 'exact' when 'verified_fragmented' then 'fragmented' else case when score >= 93 then 'fuzzy' else 'none' end end as match_method,
            case when verification_status in ('verified', 'verified_fragmented') then page_number when score >= 93 then len(list_filter(q.starts, lambda s: s <= w.a))::bigint end as page_number,
            case when score >= 93 then substr(full_display, w.a + 1, w.z - w.a) else '' end as matched_text
            from verdicts_{k} v join q_{k} q using (finding_ord) left join won_{k} w using (finding_ord) left join shown on shown.filename = v.filename)""",
    )


def _json(code: str) -> str:
    return f"json_object('label_code', {code}, 'snippet', quote, 'reasoning', ' it says so ', 'confidence', 'High')::varchar"


_GOOD = "case category " + " ".join(f"when '{c}' then '{g}'" for c, g in GOOD_CODE.items()) + " end"
_ONE = _json("good")
_OF = lambda *items: "'{\"findings\": [' || " + " || ', ' || ".join(items) + " || ']}'"
RESPONSES = f"""responses as (select category, doc_id as response_ord, case when doc_id % 10 = 9 then 'req-lost' else 'req-' || printf('%04d', doc_id + 1) || '-' || regexp_replace(filename, '[^a-zA-Z0-9_-]', '_', 'g') end as custom_id,
    doc_id % 14 <> 5 as success, case when doc_id % 14 = 5 then 'overloaded' end as error_message,
    case doc_id % 14 when 0 then {_OF(_ONE)} when 1 then '```json' || chr(10) || {_OF(_ONE)} || chr(10) || '```' when 2 then 'Here it is: ' || {_OF(_ONE)} when 3 then {_OF(_ONE)} || ' as you asked'
        when 4 then '' when 6 then '{{}}' when 7 then '{{"findings": "x"}}' when 8 then '[]' when 9 then {_OF("'1'", _ONE)} when 10 then {_OF(_json("'  '"), _ONE)}
        when 11 then {_OF(_json("null"))} when 12 then {_OF(_json("'OUT_NEW'"), _ONE)} when 13 then {_OF(_ONE, "'\"no\"'", _ONE)} end as text
    from (select *, {_GOOD} as good from (select *, [{", ".join(map(_text, CATEGORY))}][1 + doc_id % 3] as category, substr(text, 1 + (doc_id * 11) % greatest(length(text) - 70, 1), 60) as quote from docs)))"""
NAMED = "named as (select r.*, coalesce(f.filename, 'unknown') as filename from responses r left join (select *, 'req-' || printf('%04d', idx) || '-' || regexp_replace(filename, '[^a-zA-Z0-9_-]', '_', 'g') as cid from files) f on f.cid = r.custom_id)"
_STRIP = rf"'^{SPACES}|{SPACES}$', '', 'g'"
_FENCES = rf"regexp_replace(regexp_replace(regexp_replace(text, {_STRIP}), '^```(?:json)?{SPACES[:-1]}*', ''), '\n?```{SPACES[:-1]}*$', '')"
CLEANED = f"cleaned as (select *, regexp_replace(case when instr(bare, '{{') > 1 then substr(bare, instr(bare, '{{')) else bare end, {_STRIP}) as j from (select *, {_FENCES} as bare from named))"
KINDS = """kinds as (select *, case when not success then 'api_error' when coalesce(text, '') = '' then 'no_text' when not json_valid(j) then 'json_parse_failed' when json_type(j) <> 'OBJECT' or coalesce(json_type(j, '$.findings'), 'ARRAY') <> 'ARRAY' then 'invalid_structure' end as whole from cleaned)"""
ITEMS = """elements as (select category, response_ord, filename, pos - 1 as pos, json_extract(j, '$.findings[' || (pos - 1) || ']') as item from (select *, unnest(range(1, 1 + coalesce(json_array_length(j, '$.findings'), 0)::bigint)) as pos from kinds where whole is null)),
    fields as (select *, json_type(item) as kind, trim(coalesce(item->>'label_code', 'None')) as label_code, regexp_replace(coalesce(item->>'snippet', 'None'), '^[\\s\\x0b\\x1c-\\x1f\\x85\\p{Z}]+|[\\s\\x0b\\x1c-\\x1f\\x85\\p{Z}]+$', '', 'g') as snippet, trim(item->>'reasoning') as reasoning, lower(trim(item->>'confidence')) as confidence from elements),
    judged as (select f.*, case when kind <> 'OBJECT' then 'invalid_finding_item' when label_code = '' or snippet = '' then 'missing_fields' when (category, label_code) not in (select (category, code) from fw) then 'hallucinated_code' end as error_type from fields f)"""
PARSED = (RAW, FW, DOCS, FILES, RESPONSES, NAMED, CLEANED, KINDS, ITEMS)
ITEMS_SAID = f"""said as (select *, case error_type when 'invalid_finding_item' then 'Finding #' || pos || ' is not a dict: ' || case kind when 'VARCHAR' then 'str' else 'int' end
    when 'missing_fields' then 'Finding #' || pos || ' missing label_code or snippet.'
    when 'hallucinated_code' then 'Finding #' || pos || ': label_code ''' || label_code || ''' is not in category ''' || category || '''. Valid: [' || (select string_agg('''' || code || '''', ', ' order by code) from (select distinct code, category as c from fw) where c = judged.category) || ']' end as error_message,
    case when error_type in ('missing_fields', 'hallucinated_code') then left('{{"label_code": ' || (item->'label_code')::varchar || ', "snippet": ' || (item->'snippet')::varchar || ', "reasoning": ' || (item->'reasoning')::varchar || ', "confidence": ' || (item->'confidence')::varchar || '}}', 500) else '' end as raw_text from judged)"""
_TAIL = len("as you asked")
_WHOLE = f"case whole when 'api_error' then error_message when 'no_text' then 'LLM returned no text content blocks.' when 'json_parse_failed' then 'Extra data: line 1 column ' || (length(j) - {_TAIL} + 1) || ' (char ' || (length(j) - {_TAIL}) || ')' else case when j = '[]' then 'answer is not an object: list' else '''findings'' field is not a list: str' end end"
ERRORS = "errs as (select filename, category as label_category, whole as error_type, response_ord, -1::bigint as pos from kinds where whole is not null union all select filename, category, error_type, response_ord, pos from judged where error_type is not null)"
SAID = (ITEMS_SAID, f"told as (select filename, category as label_category, whole as error_type, {_WHOLE} as error_message, case when whole in ('json_parse_failed', 'invalid_structure') then left(text, 2000) else '' end as raw_text, response_ord, -1::bigint as pos from kinds where whole is not null union all select filename, category, error_type, error_message, raw_text, response_ord, pos from said where error_type is not null)")
STEM = r"regexp_replace(filename, '\.[^.]+$', '')"


def _safe(x: str, n: int) -> str:
    return f"trim(substr(regexp_replace({x}, '[^A-Za-z0-9_-]', '_', 'g'), 1, {n}), '_')"


BLOCKS = r"""lines as (select filename, unnest(string_split(coalesce(text, ''), chr(10))) as line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1)::bigint as page_no from docs),
    blocks as (select filename, page_no, 0 as block_no, 'Journal Vol. 5 page ' || page_no as text, true as margin from lines union all select filename, page_no, 1, line, false from lines union all select filename, page_no, 2, substr(line, 1, 6), true from lines),
    counts as (select filename, count(distinct page_no) as n_pages from blocks group by filename)"""
SIGNED = "signed as (select *, trim(regexp_replace(" + _cf(_norm("text")) + r", '\p{Nd}+', '#', 'g')) as sig from blocks where trim(regexp_replace(text, '\s', '', 'g')) <> '')"
SIGS = "sigs as (select filename, sig, count(distinct page_no) as pages, any_value(n_pages) as n_pages from signed join counts using (filename) where margin and sig <> '' group by filename, sig having any_value(n_pages) >= 2 and count(distinct page_no) >= greatest(2, round_even(any_value(n_pages) * 0.25, 0)))"
STRIPPED = f"""kept as (select s.* from signed s left join sigs g on g.filename = s.filename and g.sig = s.sig and s.margin where g.sig is null),
    page_raw as (select l.filename, l.page_no, coalesce(string_agg(k.text, ' ' order by k.block_no), '') as raw from lines l left join kept k on k.filename = l.filename and k.page_no = l.page_no group by all),
    pages_ as (select filename, page_no, {_cf(_norm('raw'))} as cf from page_raw)"""
USAGE = "usage as (select event_type as lane, event_id as seq, epoch_us(ts) as ts_us, round(value * 100)::bigint as tokens from events where round(value * 100)::bigint > 0)"
WINDOW = """w as (select *, (sum(tokens) over tr - sum(tokens) over pe)::bigint as used, count(*) over tr - count(*) over pe as n_in, min(ts_us) over tr as oldest, greatest(coalesce(trunc(avg(tokens) over last5)::bigint, 0), 1) as estimate from usage
    window tr as (partition by lane order by ts_us range between 3600000000 preceding and current row), pe as (partition by lane, ts_us order by seq desc rows between unbounded preceding and current row),
           last5 as (partition by lane order by ts_us, seq rows between 5 preceding and 1 preceding)),
    admitted as (select *, n_in = 0 or used + estimate <= 54000 as ok from w)"""
_VERDICT = "snippet_id, filename, finding_ord, verification_status, match_score, match_method, page_number"
_LAST = "last_ as (select snippet_id, max_by(page_number_or, finding_ord) as p, max_by(verification_status, finding_ord) as s, max_by(match_method, finding_ord) as m from (select *, coalesce(page_number, -1) as page_number_or from verdicts_{0}) group by snippet_id)"
_BOTH = "both_ as (select * from verdicts_exact union all select * from verdicts_fragmented)"

ORACLES: dict[str, str] = {
    "framework_load": _with(RAW, FW, query=f"select {_COLS}, ord from fw"),
    "framework_duplicates": _with(BAD, FW, query="select category, code, count(*) as n from fw group by all having count(*) > 1"),
    "framework_categories": _with(RAW, FW, CATS, query="select * from cats"),
    "label_prompt_blocks": _with(RAW, FW, CATS, query="select category, cat_ord, n_codes, (select string_agg('- ' || code || ': ' || description || chr(10) || '  Include: ' || inclusion_criteria || case when exclusion_criteria <> '' then chr(10) || '  Exclude: ' || exclusion_criteria else '' end, chr(10) order by ord) from fw where fw.category = cats.category) as blocks from cats"),
    "analysis_prompts": "",
    "document_data_uris": "select doc_id, 'data:application/pdf;base64,' || to_base64(encode(coalesce(text, ''))) as uri from documents",
    "run_summary": _with(*PARSED, ERRORS, PAGES, PLACED, TEXTS, EXACT, *_verdicts("exact"), query="select (select count(*) from judged where error_type is null) as n_findings, (select count(*) from errs) as n_errors, count(*) filter (verification_status like 'verified%') as n_verified, count(*) filter (verification_status = 'not_found') as n_not_found from verdicts_exact"),
    "request_matrix": _with(RAW, FW, CATS, DOCS, FILES, query="select category, cat_ord, idx, substr('req-' || printf('%04d', idx) || '-' || regexp_replace(filename, '[^A-Za-z0-9_-]', '_', 'g'), 1, 64) as custom_id, filename, file_id from files, cats"),
    "cost_estimate": _with(RAW, FW, query="select n_documents, n_categories, n_documents * n_categories as n_requests, 0.01::double as cost_per_request, n_documents * n_categories * 0.01::double as cost from (select count(*) as n_documents from documents), (select count(distinct category) as n_categories from fw)"),
    "doc_limit_sorted": "select '/corpus/' || name as path, name as filename, row_number() over (order by name) as idx from (select source || '_' || doc_id || ['.pdf', '.DOCX', '.txt', '.ppt', '.xlsx'][1 + doc_id % 5] as name from documents where doc_id % 5 in (0, 1, 3) order by name limit 50)",
    "response_text_assembly": rf"select conv_id, true as success, nullif(regexp_replace(coalesce(string_agg(text, chr(10) order by turn) filter (role = 'assistant'), ''), {_STRIP}), '') as text from conversations group by conv_id",
    "response_success_counts": _with(DOCS, RESPONSES, query="select category, count(*) filter (success) as succeeded, count(*) filter (not success) as errored from responses group by category"),
    "custom_id_join": _with(DOCS, FILES, RESPONSES, NAMED, query="select response_ord, custom_id, filename from named"),
    "clean_json": _with(DOCS, FILES, RESPONSES, NAMED, CLEANED, query="select response_ord, j as cleaned from cleaned where success"),
    "parse_findings": _with(*PARSED, query=f"""select {_safe(STEM, 40)} || '__' || {_safe('category', 30)} || '__' || printf('%04d', row_number() over (partition by category, response_ord order by pos)) as snippet_id, filename, category as label_category, label_code, snippet, reasoning, confidence,
        '{RUN_TS}' as timestamp, left(sha256(filename || '|' || category || '|' || label_code || '|' || snippet), 16) as finding_hash, response_ord from judged where error_type is null"""),
    "parse_errors": _with(*PARSED, *SAID, query="select * from told"),
    "parse_error_counts": _with(*PARSED, ERRORS, query="select label_category, error_type, count(*) as n from errs group by all"),
    "hallucinated_codes": _with(RAW, FW, query=f"select * from (select doc_id, [{', '.join(map(_text, CATEGORY))}][1 + doc_id % 3] as label_category, ['OUT_GAIN', 'COST', 'MET_SURVEY', 'NEW_CODE'][1 + doc_id % 4] as label_code from documents) x where not exists (select 1 from fw where fw.category = label_category and fw.code = label_code)"),
    "finding_identifiers": f"""select doc_id, {_safe(STEM, 40)} || '__' || {_safe('category', 30)} || '__' || printf('%04d', doc_id) as snippet_id, substr('req-' || printf('%04d', doc_id) || '-' || regexp_replace(filename, '[^A-Za-z0-9_-]', '_', 'g'), 1, 64) as custom_id,
        left(sha256(filename || '|' || category || '|COST|' || snippet), 16) as finding_hash, {_safe('category', 60)} as prompt_part
        from (select doc_id, coalesce(source, '') || ' & Söhne (v1.2) ' || doc_id || '.final.pdf' as filename, coalesce(lang, '') || ': costs/benefits' as category, coalesce(substr(text, 1, 80), '') as snippet from documents)""",
    "dedup_by_hash": """select arg_min(snippet_id, (run, snippet_id)) as snippet_id, finding_hash from (select 0 as run, 'a_' || doc_id as snippet_id, * from h where doc_id % 4 < 2 union all select 1, 'b_' || doc_id, * from h where doc_id % 4 > 0) group by finding_hash""",
    "normalize_text": "",
    "page_offsets": _with(DOCS, PAGES, PLACED, query="select filename, page_no, start from placed"),
    "page_lookup": _with(*CORPUS, query=f"select filename, place, {_page('place')} as page_number from (select *, (substr(filename, 5, 6)::bigint * 53) % greatest(length(full_cf), 1) as place from texts)"),
    "no_text_layer_docs": _with(*CORPUS, query="select filename, length(full_cf) as n_chars from texts where length(trim(full_cf)) < 50"),
    "boilerplate_signatures": _with(DOCS, BLOCKS, SIGNED, SIGS, query="select filename, sig, pages, n_pages from sigs"),
    "boilerplate_stripped_text": _with(DOCS, BLOCKS, SIGNED, SIGS, STRIPPED, PLACED, query="select filename, length(trim(string_agg(cf, ' ' order by page_no))) >= 50 as has_text_layer, string_agg(cf, ' ' order by page_no) as full_cf, count(*) as n_pages, max(start) as last_start from placed group by filename"),
    "verify_exact": _with(*CORPUS, EXACT, *_verdicts("exact"), query=f"select {_VERDICT} from verdicts_exact"),
    "verify_fragmented": _with(*CORPUS, FRAGMENTED, *_verdicts("fragmented"), query=f"select {_VERDICT} from verdicts_fragmented"),
    "status_summary": _with(*CORPUS, EXACT, FRAGMENTED, *_verdicts("exact"), *_verdicts("fragmented"), _BOTH, query="select verification_status, count(*) as n from both_ group by all"),
    "verified_ratio": _with(*CORPUS, EXACT, FRAGMENTED, *_verdicts("exact"), *_verdicts("fragmented"), _BOTH, query="select n_verified, n_findings, n_verified / n_findings as ratio from (select count(*) filter (verification_status like 'verified%') as n_verified, count(*) as n_findings from both_)"),
    "clean_findings": _with(*CORPUS, EXACT, *_verdicts("exact"), query="select snippet_id, filename, finding_ord, page_number from verdicts_exact where snippet_id not in (select snippet_id from verdicts_exact where verification_status = 'not_found')"),
    "audit_findings": _with(*CORPUS, FRAGMENTED, *_verdicts("fragmented"), _LAST.format("fragmented"), query="select snippet_id, filename, finding_ord, nullif(p, -1) as page_number, verification_status, match_score, match_method from verdicts_fragmented join last_ using (snippet_id)"),
    "standalone_audit": _with(*CORPUS, EXACT, *_verdicts("exact"), _LAST.format("exact"), query="select snippet_id, finding_ord, 'kept' as note, nullif(p, -1) as page_number, s as verification_status, m as match_method from f_exact join last_ using (snippet_id)"),
    "benchmark_passages_located": _with(*CORPUS, f"needles as (select item_id as key, {_cf(_norm('text'))} as needle from benchmark)", query="select key, filename, instr(full_cf, needle) - 1 as place from needles, texts where needle <> '' and instr(full_cf, needle) > 0"),
    "resume_plan": _with(RAW, FW, CATS, query="select category, cat_ord, case when category = 'Methods' then 'b2' end as batch_id from cats"),
    "resume_pending_categories": _with(RAW, FW, CATS, query="select category, cat_ord from cats where category <> 'Methods'"),
    "token_window_usage": _with(USAGE, WINDOW, query="select lane, seq, tokens, used, case when n_in > 0 then oldest end as oldest_us from w"),
    "token_estimate_last5": _with(USAGE, WINDOW, query="select lane, seq, estimate from w"),
    "rate_limit_admission": _with(USAGE, WINDOW, query="select lane, seq, ok as admitted, case when ok then 0 else greatest(oldest + 3600000000 - ts_us, 1000000) end as wait_us from admitted"),
}
_SHOWN = f"{_VERDICT}, matched_text"
ORACLES["verify_fuzzy"] = _with(*CORPUS, SHOWN, FUZZY, *_verdicts("fuzzy"), *_aligned("fuzzy"), query=f"select {_SHOWN} from ladder_fuzzy")
_ALL = [cte for kind, found in (("exact", EXACT), ("fragmented", FRAGMENTED), ("fuzzy", FUZZY)) for cte in (found, *_verdicts(kind), *_aligned(kind))]
ORACLES["verify_ladder"] = _with(*CORPUS, SHOWN, *_ALL, query=" union all ".join(f"select {_SHOWN} from ladder_{kind}" for kind in ("exact", "fragmented", "fuzzy")))
ORACLES["pacing_replay"] = """with recursive
    u as (select lane, seq, ts_us, tokens, row_number() over (partition by lane order by ts_us, seq) as k from (select event_type as lane, event_id as seq, epoch_us(ts) as ts_us, round(value * 100)::bigint as tokens from events)),
    s as (select distinct lane, 1::bigint as k, 0::bigint as clock, []::struct(t bigint, n bigint)[] as used, []::bigint[] as recent, null::bigint as sent_us from u
        union all
        select lane, case when go then k + 1 else k end, case when go then asked else asked + greatest(live[1].t + 3600000000 - asked, 1000000) end,
               case when go and tokens > 0 then list_append(live, {'t': asked, 'n': tokens}) else live end, case when go and tokens > 0 then list_append(recent, tokens)[-5:] else recent end, case when go then asked end
        from (select *, len(live) = 0 or list_sum(list_transform(live, lambda x: x.n)) + greatest(coalesce(list_sum(recent) // nullif(len(recent), 0), 0), 1) <= 54000 as go
              from (select s.lane, s.k, s.recent, u.tokens, greatest(s.clock, u.ts_us) as asked, list_filter(s.used, lambda x: x.t >= greatest(s.clock, u.ts_us) - 3600000000) as live from s join u on u.lane = s.lane and u.k = s.k)))
    select u.lane, u.seq, u.ts_us, u.tokens, s.sent_us from s join u on u.lane = s.lane and u.k = s.k - 1 where s.sent_us is not null"""
_HASHED = "h as (select doc_id, left(sha256(coalesce(source, '') || '|' || coalesce(lang, '') || '|COST|' || coalesce(text, '')), 16) as finding_hash from documents)"
ORACLES["dedup_by_hash"] = _with(_HASHED, query="select min_by(snippet_id, run || snippet_id) as snippet_id, finding_hash from (select '0' as run, 'a_' || doc_id as snippet_id, finding_hash from h where doc_id % 4 < 2 union all select '1', 'b_' || doc_id, finding_hash from h where doc_id % 4 > 0) group by finding_hash")
_FOLDED = "x" + "'" * 5 + '"' * 4 + "''" + "-" * 7 + "... x "
_NOISY = f"""case doc_id % 6 when 0 then replace(text, ' ', chr(160)) when 1 then replace(replace(text, '''', chr(8217)), 'e ', 'e ' || chr(8212) || ' ') when 2 then replace(text, 'ne', 'n- ' || chr(10) || ' e')
    when 3 then replace(text, '. ', chr(8230) || chr(9) || chr(8203) || ' ') when 4 then text else {_text(_FOLDED)} || text end"""
_MAPPED = "replace(replace(translate(coalesce(noisy, ''), chr(160) || chr(8217) || chr(8212), ' ''-'), chr(8230), '...'), chr(8203), '')"
ORACLES["normalize_text"] = _with(f"n as (select doc_id, {_NOISY} as noisy from documents)", f"m as (select doc_id, {_norm(_MAPPED)} as display from n)", query=f"select doc_id, display, {_cf('display')} as cf from m")
_BLOCKS_SQL = ORACLES["label_prompt_blocks"].split(" select category, cat_ord, n_codes, ", 1)
ORACLES["analysis_prompts"] = f"{_BLOCKS_SQL[0]}, b as (select category, cat_ord, {_BLOCKS_SQL[1]}) select category, cat_ord, {_text(HEAD)} || blocks || {_text(tail(True))} as prompt from b"
_ASK = "You sum up coded findings of a systematic review.\nYou get a JSON object with findings (label_code, snippet, reasoning) from several documents. For each of the codes "
_SHAPE = ' write three to five sentences on the themes of its snippets. Answer with JSON only:\n{"syntheses": [{"label_code": "<code>", "summary": "<text>"}]}\n'
ORACLES["summary_prompts"] = _with(RAW, FW, CATS, query=f"select category, cat_ord, {_text(_ASK)} || replace(codes, ',', ', ') || {_text(_SHAPE)} as prompt from cats")
_CONTENT = "json_array(json_object('type', 'document', 'source', json_object('type', 'file', 'file_id', file_id)), json_object('type', 'text', 'text', prompt))"
_BODY = f"json_object('custom_id', custom_id, 'params', json_object('model', 'some-model', 'max_tokens', 8192, 'messages', json_array(json_object('role', 'user', 'content', {_CONTENT}))))::varchar"
_CUSTOM = "substr('req-' || printf('%04d', idx) || '-' || regexp_replace(filename, '[^A-Za-z0-9_-]', '_', 'g'), 1, 64)"
_PROMPTS = ORACLES["analysis_prompts"].removeprefix("with ")
_HEADS, _LAST_SELECT = _PROMPTS.rsplit(" select category, cat_ord, ", 1)
ORACLES["batch_bodies"] = f"with {_HEADS}, asked as (select category, cat_ord, {_LAST_SELECT}), {DOCS}, {FILES} select category, custom_id, {_BODY} as body from (select category, prompt, file_id, {_CUSTOM} as custom_id from files, asked)"
