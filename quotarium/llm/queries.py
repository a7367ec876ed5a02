"""The queries opN_ of the corpus operators: production parameters, whole tables, full results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotarium.llm import exact_dedup, language_id, line_dedup, minhash, packing, pieces, quality_crf, quality_rules, token_counts, warc
from quotarium.llm.common import table


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = line_dedup.passage_dedup(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_lines", "n_removed_lines", F.sha2("text", 256).alias("text_sha256"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "documents").select("doc_id", "text").schema
    return exact_dedup.exact_dedup_files(spark, f"{sf_dir}/documents.parquet", schema)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.warc_round_trip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_crf.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_with_offsets(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"), full=False)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict:
    return {k: f for k, f in globals().items() if k.startswith("op") and callable(f)} | {"pipeline": pipeline}


#: The sketches are integer histograms, so SQL gives the same thresholds.
_RULES = """
    with t as (select doc_id, lang, source, coalesce(text, '') as text from documents),
    w as (select *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') as words, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as lines from t),
    g as (select *, case when len(words) < 3 then [] else list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2]) end as grams from w),
    e as (select row_number() over () as r, * from g),
    x as (select r, unnest(grams) as gram, generate_subscripts(grams, 1) as i from e),
    d as (select r, i from (select r, i, count(*) over (partition by r, gram) as c from x) where c > 1),
    p as (select r, count(distinct i + k) as n from d, (values (0), (1), (2)) v(k) group by r),
    m as (select doc_id, lang, source, len(words) as n_words, coalesce(list_sum(list_transform(words, lambda v: length(v))), 0)::bigint as word_chars,
                 len(regexp_extract_all(text, '[#*$%&|<>]')) as n_symbols, len(lines) - len(list_distinct(lines)) as n_dup_lines, coalesce(p.n, 0) as n_repeat_words,
                 len(lines) as n_lines, len(regexp_extract_all(text, '[A-Z][A-Z]')) as n_capitals from e left join p using (r)),
    b as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed, coalesce('v' || lang, 'n') as lk, coalesce('v' || source, 'n') as sk, row_number() over () as r,
                 word_chars * 1000 // nullif(n_words, 0) as word_length, n_symbols * 1000 // nullif(n_words, 0) as symbols, n_dup_lines * 1000 // nullif(n_lines, 0) as dup_lines,
                 n_repeat_words * 1000 // nullif(n_words, 0) as repeats, n_capitals * 1000 // nullif(n_words, 0) as capitals from m),
    u as (select r, lk, sk, base_failed, unnest(['word_length', 'symbols', 'dup_lines', 'repeats', 'capitals']) as measure, unnest([word_length, symbols, dup_lines, repeats, capitals]) as v from b),
    k as (select lk, sk, measure, (v >> greatest(length(bin(v)) - 7, 0)) << greatest(length(bin(v)) - 7, 0) as bucket from u where not base_failed),
    s as (select 2 as level, lk, sk, measure, bucket, count(*) as n from k group by all union all select 1, lk, '', measure, bucket, count(*) from k group by all union all select 0, '', '', measure, bucket, count(*) from k group by all),
    c as (select *, sum(n) over (partition by level, lk, sk, measure order by bucket) as cum, sum(n) over (partition by level, lk, sk, measure) as rows_ from s),
    q as (select level, lk, sk, measure, max(rows_) as rows_, min(case when 4 * cum >= rows_ then bucket end) as q1, min(case when 4 * cum >= 3 * rows_ then bucket end) as q3 from c group by all),
    f as (select *, 3 * (q3 - q1) as far, case measure when 'word_length' then 1500 when 'symbols' then 300 when 'dup_lines' then 400 when 'repeats' then 350 else 700 end as slack from q),
    j as (select u.r, bool_and(coalesce(u.v <= a.q3 + a.far + a.slack and (u.measure <> 'word_length' or u.v >= a.q1 - a.far - a.slack), false)) as within
          from u left join f f2 on f2.level = 2 and f2.lk = u.lk and f2.sk = u.sk and f2.measure = u.measure left join f f1 on f1.level = 1 and f1.lk = u.lk and f1.measure = u.measure
          left join f a on a.measure = u.measure and a.level = case when f2.rows_ >= 100 then 2 when f1.rows_ >= 100 then 1 else 0 end
                       and (a.level < 2 or a.sk = u.sk) and (a.level < 1 or a.lk = u.lk) group by u.r)
    select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and within as kept from b join j using (r)"""


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_RUN = 50

#: Words are numbered through a text. A window of words that stood before drops its words; what is left of a line keeps the white space before kept words, and that at its end.
_PASSAGES = f"""
    with lines as (select doc_id, i as line, x as text from (select doc_id, unnest(string_split(text, chr(10))) as x, generate_subscripts(string_split(text, chr(10)), 1) as i from documents where text <> '')),
    units as (select doc_id, line, unnest(us) as u, generate_subscripts(us, 1) as k, len(us) as n from (select doc_id, line, regexp_extract_all(text, '[\\x20\\x09\\x0B-\\x0D]*[^\\x20\\x09-\\x0D]+') as us from lines)),
    words as (select *, ltrim(u, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) as w, row_number() over (partition by doc_id order by line, k) as at_ from units),
    texts as (select doc_id, list(w order by at_) as ws from words group by doc_id having count(*) >= {_RUN}),
    windows as (select doc_id, p, md5(array_to_string(ws[p : p + {_RUN - 1}], ' ')) as m from (select *, unnest(range(1, len(ws) - {_RUN} + 2)) as p from texts)),
    hits as (select doc_id, p from (select doc_id, p, row_number() over (partition by m order by doc_id, p) as r from windows) where r > 1),
    marked as (select w.*, max(h.p) over o is not null as gone, max(h.p) over i is not null as inside from words w left join hits h on h.doc_id = w.doc_id and h.p = w.at_
               window o as (partition by w.doc_id order by w.at_ rows between {_RUN - 1} preceding and current row), i as (partition by w.doc_id order by w.at_ rows between {_RUN - 1} preceding and 1 preceding)),
    own as (select doc_id, line, count(*) as n, count(*) filter (not gone) as n_kept, sum(length(u)) as used, list(substr(u, 1, length(u) - length(w)) order by k) as spaces from marked group by doc_id, line),
    next_ as (select l.doc_id, l.line, l.text, o.n, o.n_kept, o.used, first_value(m.inside ignore nulls) over (partition by l.doc_id order by l.line rows between 1 following and unbounded following) as enclosed
              from lines l left join own o using (doc_id, line) left join (select doc_id, line, inside from marked where k = 1) m using (doc_id, line)),
    kept_ as (select *, coalesce(max(case when not gone then k end) over (partition by doc_id, line order by k rows between unbounded preceding and 1 preceding), 0) as last_ from marked),
    rest as (select doc_id, line, string_agg(o.spaces[last_ + 1] || w, '' order by k) as kept from kept_ join own o using (doc_id, line) where not gone group by doc_id, line),
    left_ as (select n.*, r.kept, case when n.n is null then coalesce(n.enclosed, false) else n.n_kept = 0 end as whole from next_ n left join rest r using (doc_id, line)),
    out as (select doc_id, count(*) as n_lines, count(*) filter (whole) as n_removed_lines, coalesce(string_agg(case when n is null or n_kept = n then text else kept || substr(text, used::bigint + 1) end, chr(10) order by line) filter (not whole), '') as text from left_ group by doc_id)
    select d.doc_id, coalesce(n_lines, 0) as n_lines, coalesce(n_removed_lines, 0) as n_removed_lines, sha256(coalesce(out.text, '')) as text_sha256 from documents d left join out using (doc_id)"""

_NEAR = f"""
    with recursive t as (select doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') as w from documents),
    s as (select distinct doc_id, unnest(case when len(w) >= 3 then list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i : i + 2], ' ')) when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as x from t),
    n as (select doc_id, count(*) as n from s group by doc_id),
    b as (select a.doc_id as a, b.doc_id as b, count(*) as both_ from s a join s b on a.x = b.x and a.doc_id < b.doc_id group by all),
    l as (select a, b from b join n na on na.doc_id = a join n nb on nb.doc_id = b where 100 * both_ >= 85 * (na.n + nb.n - both_)),
    e as (select a, b from l union all select b, a from l),
    r as (select doc_id as id, doc_id as to_ from t union select r.id, e.b from r join e on e.a = r.to_)
    select id as doc_id, coalesce(n.n, 0) as n_shingles, min(to_) as component_id, id = min(to_) as kept from r left join n on n.doc_id = id group by id, n.n"""


ORACLES = {
    "op1_line_dedup": _PASSAGES,
    "op6_minhash": _NEAR,
    "op2_quality_rules": _RULES,
    "op3_exact_dedup": """
        with t as (select doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) as text_sha256,
                          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as norm from documents),
             g as (select norm, max(doc_id) as keep_id, count(*) as group_size from t group by norm)
        select t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id as kept, t.text_sha256 from t join g on t.norm = g.norm""",
    "op4_warc": """
        with p as (select page_id, coalesce(html, '') as html from pages),
             g as (select html, min(page_id) as first_id from p where octet_length(encode(html)) >= 100 group by html),
             r as (select p.page_id, octet_length(encode(p.html)) as payload_bytes, sha256(p.html) as payload_digest, g.first_id from p left join g on p.html = g.html)
        select page_id, payload_bytes, payload_digest, case when first_id <> page_id then 'revisit' else 'response' end as record_type,
               case when first_id <> page_id then first_id end as refers_to from r""",
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
