"""SQL counterparts, for DuckDB, of the queries that SQL can express.

The others (learned profiles, 64-bit hashes that DuckDB lacks, page markup, token ids, the filled
lookup table, stopping by probability, entropy scans) are held against brute force in tests/llm.
"""

from __future__ import annotations

from tallywright.llm import divergence, licenses

_WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[ \t\n\x0b\x0c\r]+'), lambda x: x <> '')"

_DOMAIN = r"""case when try_cast(nullif(regexp_extract(coalesce(source, ''), '([0-9]+)$', 1), '') as int) = 0 then 'web'
    when try_cast(nullif(regexp_extract(coalesce(source, ''), '([0-9]+)$', 1), '') as int) % 3 = 1 then 'books'
    when try_cast(nullif(regexp_extract(coalesce(source, ''), '([0-9]+)$', 1), '') as int) % 3 = 2 then 'forum'
    else 'news' end"""


def _filled(nodes: str, parents: str, order: str) -> str:
    """SQL that splits each parent's budget among its children, as the mixing module does."""
    by = f"partition by {parents}" if parents else ""
    return f"""
      select *, case when is_full then cap
        else least(cap, greatest(0, (weight * (budget - taken)) // nullif(all_weight - gone, 0))) end as given
      from (select *, coalesce(sum(case when is_full then cap end) over ({by}), 0) as taken,
                   coalesce(sum(case when is_full then weight end) over ({by}), 0) as gone
            from (select *, cast(cap as double) * cast(all_weight - passed as double)
                            <= cast(weight as double) * cast(budget - used as double) as is_full
                  from (select *, coalesce(sum(cap) over before, 0) as used,
                               coalesce(sum(weight) over before, 0) as passed,
                               sum(weight) over ({by}) as all_weight
                        from {nodes}
                        window before as ({by} order by cap::double / weight, {order}
                                          rows between unbounded preceding and 1 preceding))))"""


_OP7 = f"""
with d as (select doc_id, {_DOMAIN} as domain, lang, source, len({_WORDS}) as tokens from documents),
leaf as (select domain, lang, source, sum(tokens)::bigint as tokens, 2 * sum(tokens)::bigint as cap,
                case domain when 'web' then 4 when 'books' then 3 when 'forum' then 2 else 1 end as w0,
                case lang when 'en' then 5 when 'fr' then 2 when 'de' then 2 else 1 end as w1
         from d group by 1, 2, 3 having sum(tokens) > 0),
n0 as (select domain, sum(cap) as cap, first(w0) as weight,
              (select floor(sum(tokens) * 0.5)::bigint from leaf) as budget from leaf group by 1),
b0 as ({_filled("n0", "", "domain nulls first")}),
n1 as (select l.domain, l.lang, sum(l.cap) as cap, first(w1) as weight, first(b0.given) as budget
       from leaf l join b0 on b0.domain is not distinct from l.domain group by 1, 2),
b1 as ({_filled("n1", "domain", "domain nulls first, lang nulls first")}),
n2 as (select l.domain, l.lang, l.source, l.tokens, l.cap, 1 as weight, b1.given as budget
       from leaf l join b1 on b1.domain is not distinct from l.domain and b1.lang is not distinct from l.lang),
b2 as ({_filled("n2", "domain, lang", "domain nulls first, lang nulls first, source nulls first")}),
plan as (select domain, lang, source, given::bigint // tokens as epochs, given::bigint % tokens as rest from b2),
rows as (select d.*, p.epochs, p.rest, md5('11:' || p.epochs || ':' || coalesce(doc_id::varchar, 'null')) as place
         from d join plan p on d.domain is not distinct from p.domain and d.lang is not distinct from p.lang
                           and d.source is not distinct from p.source),
cut as (select *, sum(tokens) over (partition by domain, lang, source order by place) <= rest and rest > 0 as more from rows)
select doc_id, unnest(range(epochs + more::int))::int as epoch, domain, lang, source, tokens::bigint as tokens
from (select *, row_number() over () as k from cut) where epochs + more::int > 0"""

_OP8 = f"""
with d as (select doc_id, {_WORDS} as ws from documents),
windows as (select doc_id, i, list_aggregate(ws[i : i + 19], 'string_agg', ' ') as win
            from (select doc_id, ws, unnest(range(1, len(ws) - 18)) as i from d where len(ws) >= 20)),
later as (select doc_id, i from (select doc_id, i, row_number() over (partition by win order by doc_id, i) as k from windows)
          where k > 1),
gone as (select distinct doc_id, unnest(range(i, i + 20)) as i from later),
words as (select doc_id, unnest(range(1, len(ws) + 1)) as i, unnest(ws) as w from d),
kept as (select w.doc_id, count(g.i) as n_removed,
                coalesce(string_agg(w.w, ' ' order by w.i) filter (where g.i is null), '') as text
         from words w left join gone g on w.doc_id = g.doc_id and w.i = g.i group by 1)
select d.doc_id, len(d.ws)::bigint as n_words, coalesce(n_removed, 0)::bigint as n_removed,
       sha256(coalesce(kept.text, '')) as kept_sha256
from d left join kept on d.doc_id = kept.doc_id"""

_OP9 = rf"""
with d as (select doc_id, coalesce(text, '') as t, {_WORDS} as ws,
                  list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^ \t\n\x0b\x0c\r]')) as ls
           from documents),
wins as (select doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] as win
         from (select doc_id, ws, unnest(range(1, len(ws) - 1)) as i from d where len(ws) >= 3)),
again as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, win) as n from wins) where n > 1),
covered as (select doc_id, count(distinct p) as n from (select doc_id, unnest([i, i + 1, i + 2]) as p from again) group by 1),
c as (select d.doc_id, len(ws)::bigint as n_words, length(list_aggregate(ws, 'string_agg', ''))::bigint as chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols, len(ls) as n_lines,
             (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines, coalesce(covered.n, 0)::bigint as n_repeat_words,
             length(regexp_replace(t, '[^\p{{Lu}}]', '', 'g')) as upper_chars,
             length(regexp_replace(t, '[^!?]', '', 'g')) as marks
      from d left join covered on d.doc_id = covered.doc_id),
j as (select *, coalesce(chars, 0)::bigint as word_chars, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from c)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not (base_failed or 10 * n_symbols > n_words or word_chars < 2 * n_words or word_chars > 20 * n_words
            or 10 * n_dup_lines > 3 * n_lines or 2 * upper_chars > word_chars or 2 * marks > n_words) as kept
from j"""

_LOWERED = f"translate(coalesce(text, ''), '{licenses.UPPER}', '{licenses.LOWER}')"


def _phrase_places(phrase: str) -> str:
    own = licenses.template_words(phrase)
    test = " and ".join(f"ws[i + {k}] = '{w}'" for k, w in enumerate(own))
    return f"select r, '{licenses.PHRASES[phrase]}' as label, i - 1 as place from w, unnest(range(1, len(ws) + 1)) as u(i) where {test}"


_TEMPLATES = ", ".join(
    f"('{t.label}', [{', '.join(repr(w) for w in t.words)}], {t.overlap(licenses.CONTAINMENT)})"
    for t in licenses.cut_templates(licenses.TEMPLATES)
)
# every block against every template, without any of the filters
_OP11 = rf"""
with w as (select row_number() over () as r, doc_id,
                  list_filter(string_split_regex({_LOWERED}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as ws
           from documents),
base as ({" union all ".join(_phrase_places(p) for p in licenses.PHRASES)}),
b as (select r, count(*) as n, min(place) as first_word, max(place) as last_word,
             string_agg(distinct label, ',' order by label) as base_labels from base group by 1),
t as (select label, words, need, row_number() over () as k from (values {_TEMPLATES}) v(label, words, need)),
tw as (select k, need, len(words) as size, label, unnest(words) as word from t),
places as (select r, ws[i] as word, i - 1 as place, greatest(0, ceil((len(ws) - {licenses.BLOCK_WORDS}) / {licenses.STEP_WORDS}.0))::bigint as last
       from w, unnest(range(1, len(ws) + 1)) as u(i)),
own as (select distinct r, word, unnest([place // {licenses.STEP_WORDS} - k for k in range({licenses.BLOCK_WORDS // licenses.STEP_WORDS})]) as block, last
        from places where word in (select word from tw)),
hit as (select r, label, count(*) / size as containment from own join tw using (word) where block between 0 and last
        group by r, block, k, label, size, need having count(*) >= need),
h as (select r, list(distinct label) as more, max(containment) as best from hit group by 1)
select w.doc_id, len(ws)::bigint as n_words, coalesce(b.n, 0)::bigint as n_base, first_word::bigint as first_word,
       last_word::bigint as last_word, coalesce(base_labels, '') as base_labels,
       array_to_string(list_sort(list_distinct(list_concat(
           coalesce(list_filter(string_split(base_labels, ','), lambda x: x <> ''), []), coalesce(more, [])))), ',') as labels,
       case when b.n > 0 then 1.0 else coalesce(best, 0) end::double as score
from w left join b using (r) left join h using (r)"""

_SHARE = f"1 + ({divergence.WHOLE}::hugeint * ({{n}} + {divergence.SMOOTHING})) // ({{total}} + {divergence.SMOOTHING} * terms)"
_OP12 = rf"""
with d as (select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source, {_LOWERED} as t from documents),
w as (select r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from d),
kept as (select lang, term, count(*) as whole_n from w group by 1, 2 having count(distinct r) >= {divergence.LEAST_DOCUMENTS}),
n as (select lang, source, term, count(*) as n from w group by 1, 2, 3),
langs as (select lang, count(*) as terms, sum(whole_n) as whole from kept group by 1),
g as (select lang, source, coalesce(sum(n.n), 0) as total
      from (select distinct lang, source from d) left join (n semi join kept using (lang, term)) n using (lang, source) group by 1, 2),
p as (select lang, source, term, coalesce(n.n, 0) as n, ({_SHARE.format(n="coalesce(n.n, 0)", total="total")})::bigint as p,
             ({_SHARE.format(n="whole_n", total="whole")})::bigint as q
      from g join kept using (lang) join langs using (lang) left join n using (lang, source, term)),
pairs as (select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as value
          from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by 1, 2, 3),
report as (select a.lang, a.source, 'pair' as part, b.source as item, coalesce(pairs.value, 0)::bigint as value
         from g a join g b on a.lang = b.lang and a.source <> b.source
         left join pairs on pairs.lang = a.lang and pairs.source = a.source and pairs.item = b.source
         union all select lang, source, 'term', term, p - q from p where n > 0 and p > q)
select lang, source, part, item, value, rank::int as rank
from (select *, row_number() over (partition by lang, source, part order by value desc, item) as rank from report)
where part = 'pair' or rank <= {divergence.TERM_RANKS}"""

_OP13 = """
with v as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                  list_transform(embedding, lambda x: floor(256 * x::double)) as x
           from embeddings
           where vec_id is not null and label is not null and embedding is not null
             and len(list_filter(embedding, lambda x: x is null or not isfinite(x::double))) = 0),
s as (select a.vec_id as anchor_id, a.label as own, b.vec_id as other_id, b.label,
             cast(list_inner_product(a.x, b.x) as bigint) as score
      from v a join v b on len(a.x) = len(b.x) and a.vec_id <> b.vec_id where a.vec_id % 100 = 0),
positive as (select * from (select *, row_number() over (partition by anchor_id order by score desc, other_id) as k from s where own = label)
             where k <= 5)
select anchor_id, positive_id, rank::int as rank, negative_id, positive_score, negative_score
from (select p.anchor_id, p.other_id as positive_id, n.other_id as negative_id, p.score as positive_score, n.score as negative_score,
             row_number() over (partition by p.anchor_id, p.other_id order by n.score desc, n.other_id) as rank
      from positive p join s n on p.anchor_id = n.anchor_id and n.own <> n.label
                               and 30 * p.score <= 100 * n.score and 100 * n.score <= 90 * p.score)
where rank <= 10"""

ORACLES: dict[str, str] = {
    "op7_source_mix": _OP7,
    "op8_substring_dedup": _OP8,
    "op9_quality_rules": _OP9,
    "op11_license_scans": _OP11,
    "op12_source_divergence": _OP12,
    "op13_hard_negatives": _OP13,
}
