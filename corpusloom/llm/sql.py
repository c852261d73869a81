"""SQL twins of the queries that SQL can express."""

from __future__ import annotations

from corpusloom.llm import lexical, licenses, mixing, quality_rules, secrets, topk, vectors_dedup, warc
from corpusloom.llm.license_rules import rules
from corpusloom.llm.queries import DOMAINS, WEIGHTS

SQL: dict[str, str] = {}


# -- secrets -----------------------------------------------------------------


def _quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _found(kind: int, pattern: str, group: int) -> str:
    p = _quoted(pattern)
    return f"""select id, {kind} as kind, unnest(range(1, len(hits) + 1)) as i, gaps, hits, vals
        from (select id, string_split_regex(text, {p}) as gaps, regexp_extract_all(text, {p}) as hits,
                  regexp_extract_all(text, {p}, {group}) as vals from texts)"""


_KIND = "(case kind " + " ".join(f"when {i} then '{k}'" for i, k in enumerate(secrets.KINDS)) + " end)"
_SPAN = f"string_agg({_KIND} || ':' || s || ':' || e, ',' order by s, kind, e)"
SQL["op2_secret_spans"] = f"""
with texts as (select doc_id as id, source, coalesce(text, '') as text from documents),
found as ({_found(0, secrets.ASSIGN, 2)} union all {_found(1, secrets.ACCESS, 0)}
    union all {_found(2, secrets.HEX, 0)}),
placed as (
    select id, kind, vals[i] as val, length(hits[i]) as n,
        list_sum(list_transform(gaps[1:i], lambda x: length(x)))
            + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) as s
    from found),
base as (
    select id, kind, s, s + n as e, s + n - length(val) as vs, val from placed
    where length(val) >= {secrets.MIN_VALUE}),
owned as (
    select val, count(distinct coalesce(source, '')) as owners from base join texts using (id) group by val),
added as (
    select distinct id, case when owners >= {secrets.COPIED_OWNERS} then 4 else 3 end as kind, vs as s, e
    from base join owned using (val)
    where owners >= {secrets.COPIED_OWNERS}
        or (len(list_distinct(string_split(val, ''))) >= {secrets.LIVE_CHARACTERS}
            and regexp_matches(val, '[0-9]') and not regexp_matches(val, {_quoted(secrets.PLACEHOLDER)}))),
spans as (select id, kind, s, e from base union all select * from added),
told as (
    select id, count(*) filter (kind = 0) as n_assign, count(*) filter (kind = 1) as n_access,
        count(*) filter (kind = 2) as n_hex, count(*) filter (kind = 3) as n_live,
        count(*) filter (kind = 4) as n_copied, {_SPAN} as spans, {_SPAN} filter (kind < 3) as base_spans
    from spans group by id),
most as (select id, max(owners) as most_owners from base join owned using (val) group by id)
select id as doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access,
    coalesce(n_hex, 0) as n_hex, sha256(coalesce(base_spans, '')) as base_sha256,
    coalesce(spans, '') as spans, coalesce(n_live, 0) as n_live, coalesce(n_copied, 0) as n_copied,
    coalesce(most_owners, 0) as most_owners
from texts left join told using (id) left join most using (id)"""


# -- vectors -------------------------------------------------------------------

SQL["op3_vector_near_dedup"] = f"""
with recursive vecs as (
    select vec_id, list_transform(embedding, lambda x: x::double) as v from embeddings),
links as (
    select a.vec_id as a, b.vec_id as b from vecs a, vecs b
    where a.vec_id <> b.vec_id and len(a.v) = len(b.v) and list_cosine_similarity(a.v, b.v) >= {vectors_dedup.THRESHOLD}),
reach as (
    select vec_id as a, vec_id as b from vecs
    union select reach.a, links.b from reach join links on reach.b = links.a),
counts as (select a, count(*) as n from links group by a)
select vec_id, coalesce(n, 0) as n_links, component_id, vec_id = component_id as kept
from vecs left join counts on a = vec_id
join (select a as vec_id, min(b) as component_id from reach group by a) using (vec_id)"""

SQL["op8_exact_top_k"] = f"""
with vecs as (
    select vec_id, list_transform(embedding, lambda x: floor({topk.SCALE} * x::double)) as v from embeddings),
scored as (
    select q.vec_id as query_id, c.vec_id, list_dot_product(q.v, c.v)::bigint as score
    from vecs q, vecs c where q.vec_id % 50 = 0 and q.vec_id <> c.vec_id)
select * from (
    select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank,
        vec_id, score from scored)
where rank <= 5"""


# -- archives --------------------------------------------------------------------

SQL["op5_warc_round_trip"] = f"""
with payloads as (
    select page_id, strlen(coalesce(html, '')) as n, sha256(coalesce(html, '')) as digest from pages),
firsts as (select digest, min(page_id) as first_id from payloads where n >= {warc.MIN_REVISIT} group by digest)
select page_id, n::bigint as payload_bytes, digest as payload_digest,
    case when first_id is null or first_id = page_id then 'response' else 'revisit' end as record_type,
    case when first_id <> page_id then first_id end as refers_to
from payloads left join firsts using (digest)"""


# -- mixing ----------------------------------------------------------------------

_LEVELS = ["domain", "lang", "source"]


def _weight(depth: int) -> str:
    path = " || chr(31) || ".join(_LEVELS[:depth])
    cases = " ".join(
        f"when {_quoted('~'.join(p))} then {w}" for p, w in WEIGHTS.items() if len(p) == depth
    )
    return f"(case replace({path}, chr(31), '~') {cases} else 1 end)" if cases else "1"


def _fill(depth: int) -> str:
    """The level's nodes with their part of the parent's budget."""
    own, key = ", ".join(_LEVELS[:depth]), _LEVELS[depth - 1]
    by = f"partition by {', '.join(_LEVELS[: depth - 1])}" if depth > 1 else ""
    before = f"over ({by} order by ratio, {key} rows between unbounded preceding and 1 preceding)"
    source = f"join take{depth - 1} using ({', '.join(_LEVELS[: depth - 1])})" if depth > 1 else ", total"
    budget = "take" if depth > 1 else "budget"
    return f"""
caps{depth} as (
    select {own}, (sum(tokens) * {mixing.MAX_EPOCHS})::hugeint as cap, {_weight(depth)}::hugeint as weight
    from leaves group by {own}),
nodes{depth} as (
    select {own}, cap, weight, cap::double / weight::double as ratio,
        least({budget}, sum(cap) over ({by}))::hugeint as budget
    from caps{depth} {source}),
ordered{depth} as (
    select *, (budget - coalesce(sum(cap) {before}, 0)) * weight
        >= cap * (sum(weight) over ({by}) - coalesce(sum(weight) {before}, 0)) as is_full
    from nodes{depth}),
parts{depth} as (
    select *, case when is_full then cap else
        ((budget - coalesce(sum(cap) filter (is_full) over ({by}), 0))::hugeint * weight)
            // (sum(weight) filter (not is_full) over ({by}))::hugeint end as part,
        row_number() over ({by} order by is_full, {key}) as turn
    from ordered{depth}),
take{depth} as (
    select {own}, (part + case when not is_full and turn <= budget - sum(part) over ({by}) then 1 else 0 end)
        ::bigint as take
    from parts{depth})"""


SQL["op4_source_mix"] = rf"""
with counted as (
    select doc_id, 'domain' || coalesce(try_cast(nullif(regexp_extract(source, '([0-9]+)$', 1), '') as int), 0)
            % {DOMAINS} as domain,
        coalesce(lang, '') as lang, coalesce(source, '') as source,
        len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) as tokens
    from documents where text is not null),
leaves as (
    select domain, lang, source, sum(tokens)::hugeint as tokens from counted where tokens > 0 group by all),
total as (select sum(tokens)::hugeint as budget from leaves),
{_fill(1)}, {_fill(2)}, {_fill(3)},
plan as (
    select *, take // tokens as epochs, take % tokens as rest from leaves join take3 using (domain, lang, source)),
docs as (
    select c.*, p.epochs, p.rest from counted c
    join plan p on c.domain = p.domain and c.lang = p.lang and c.source = p.source where c.tokens > 0),
cut as (
    select *, rest - coalesce(sum(tokens) over (
        partition by domain, lang, source order by md5('{mixing.SEED}:' || epochs || ':' || doc_id), doc_id
        rows between unbounded preceding and 1 preceding), 0) as room
    from docs)
select doc_id, domain, lang, source, unnest(range(epochs::bigint))::bigint as epoch, tokens::bigint as tokens
from docs
union all
select doc_id, domain, lang, source, epochs::bigint, least(tokens, room)::bigint from cut where room > 0"""


# -- licences --------------------------------------------------------------------


def _pattern(rule: str) -> str:
    """Two blanks between words and one at both ends: this dialect has no
    look-around, so a match takes its blanks and leaves the next word its own."""
    return f" (?:{rule.replace(' ?', '(?: )?').replace(' ', '  ')}) "


def _keywords(rule) -> str:
    return "[" + ", ".join(_quoted(f" {word} ") for word in rule.keyword.split()) + "]"


_RULES = ",\n    ".join(
    f"({_quoted(r.label)}, {_keywords(r)}, {_quoted(_pattern(r.pattern))}, {r.priority}, {i}, {r.weight})"
    for i, r in enumerate(rules())
)


def _phrase(phrase: str) -> str:
    first, *rest = phrase.split(" ")
    ahead = [f"w{i} = '{w}'" for i, w in enumerate(rest, 1)]
    return " and ".join([f"w = '{first}'", *ahead])


_PHRASES = " ".join(f"when {_phrase(p)} then '{label}'" for p, label in licenses.PHRASES.items())
_ORDER = "({0}.s, -{0}.e, {0}.priority, {0}.rule)"
SQL["op10_license_scan"] = rf"""
with texts as (
    select doc_id as id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
    from documents),
tokens as (select id, unnest(words) as w, unnest(range(len(words))) as i from texts),
ahead as (
    select *, lead(w, 1) over (partition by id order by i) as w1,
        lead(w, 2) over (partition by id order by i) as w2 from tokens),
base as (
    select id, i, case {_PHRASES} end as label from ahead),
told as (
    select id, count(*) as n, min(i) as first, max(i) as last, list(distinct label) as labels
    from base where label is not null group by id),
known(label, keywords, pattern, priority, rule, weight) as (values
    {_RULES}),
spaced as (select id, ' ' || array_to_string(words, '  ') || ' ' as t from texts where len(words) > 0),
found as (
    select id, label, priority, rule, weight, regexp_extract_all(t, pattern) as hits,
        string_split_regex(t, pattern) as gaps
    from spaced join known on len(list_filter(keywords, lambda k: contains(t, k))) > 0),
places as (
    select *, unnest(range(1, len(hits) + 1)) as i from found),
dets as (
    select id, label, priority, rule, weight, s, s + length(hits[i]) as e from (
        select *, list_sum(list_transform(gaps[1:i], lambda x: length(x)))
            + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) as s from places)),
kept as (
    select * from dets d where not exists (
        select 1 from dets o where o.id = d.id and (
            ({_ORDER.format("o")} < {_ORDER.format("d")} and o.priority <= d.priority and o.e >= d.e)
            or ({_ORDER.format("o")} > {_ORDER.format("d")} and o.priority < d.priority and o.e <= d.e)))),
method as (select id, list(distinct label) as labels, max(weight) as score from kept group by id)
select id as doc_id, len(words)::bigint as n_words, coalesce(n, 0) as n_base, first as first_word,
    last as last_word, coalesce(array_to_string(list_sort(told.labels), ','), '') as base_labels,
    array_to_string(list_sort(list_distinct(list_concat(coalesce(told.labels, []),
        coalesce(method.labels, [])))), ',') as labels,
    greatest(case when n > 0 then {licenses.BASE_SCORE} else 0 end, coalesce(score, 0))::double as score
from texts left join told using (id) left join method using (id)"""


# -- quality rules ---------------------------------------------------------------


def _broken(rule: quality_rules.Rule) -> str:
    share, bounds = f"100 * {rule.count}", []
    if rule.least is not None:
        bounds.append(f"{share} < {rule.least} * {rule.of}")
    if rule.most is not None:
        bounds.append(f"{share} > {rule.most} * {rule.of}")
    ranges = " or ".join(bounds)
    return f"case when {rule.of} > 0 and n_words >= {rule.from_words} and ({ranges}) then '{rule.name}' end"


_STOPS = ", ".join(_quoted(w) for w in quality_rules.all_stop_words())
_BROKEN = ",\n        ".join(_broken(r) for r in quality_rules.TABLE)
_W = quality_rules.WINDOW
SQL["op12_quality_rules"] = rf"""
with texts as (
    select row_number() over () as r, doc_id, coalesce(text, '') as text from documents),
worded as (
    select *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as words,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
    from texts),
windows as (
    select r, unnest(range(1, len(words) - {_W - 2})) as i, words from worded where len(words) >= {_W}),
named as (select r, i, array_to_string(words[i:i + {_W - 1}], ' ') as w from windows),
repeated as (select *, count(*) over (partition by r, w) as times from named),
covered as (
    select r, count(distinct i + k) as n from repeated, range({_W}) t(k) where times > 1 group by r),
counted as (
    select doc_id, len(words)::bigint as n_words,
        coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::bigint as word_chars,
        (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
        (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
        coalesce(n, 0)::bigint as n_repeat_words,
        len(list_filter(words, lambda x: lower(x) in ({_STOPS})))::bigint as n_stop_words,
        len(list_filter(words, lambda x: regexp_matches(x, '\p{{L}}')))::bigint as n_letter_words,
        len(lines)::bigint as n_lines,
        coalesce(list_sum(list_transform(lines, lambda x: length(x))), 0)::bigint as line_chars,
        (coalesce(list_sum(list_transform(lines, lambda x: length(x))), 0)
            - coalesce(list_sum(list_transform(list_distinct(lines), lambda x: length(x))), 0))::bigint
            as dup_line_chars,
        len(list_filter(lines, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*\x{{2022}}]')))::bigint
            as n_bullet_lines,
        len(list_filter(lines, lambda x: regexp_matches(x, '(?:\.\.\.|\x{{2026}})[\x20\x09-\x0D]*\z')))::bigint
            as n_ellipsis_lines
    from worded left join covered using (r)),
judged as (
    select *, n_words < {quality_rules.LEAST_WORDS}
            or 100 * n_repeat_words > {quality_rules.MOST_REPEATED} * n_words as base_failed,
        concat_ws(',', {_BROKEN}) as failed
    from counted)
select *, not base_failed and failed = '' as kept from judged"""


# -- ranked lexical search -------------------------------------------------------

_TERMS = (
    "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)
SQL["op13_ranked_search"] = f"""
with items as (
    select row_number() over () as q, item_id, list_distinct({_TERMS}) as terms from benchmark),
asked as (select q, unnest(terms) as t from items),
docs as (select row_number() over () as r, doc_id, {_TERMS} as terms from documents),
held as (select r, unnest(terms) as t from docs),
sizes as (select r, count(*)::hugeint as n from held group by r),
totals as (select count(*)::hugeint as docs, sum(n)::hugeint as terms from sizes),
counted as (
    select r, t, count(*)::bigint as tf from held where t in (select t from asked) group by r, t),
weights as (
    select t, floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1)::double))::bigint as w
    from counted, totals group by t, docs),
impacts as (
    select r, t, w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // totals.terms)))
        as part
    from counted join weights using (t) join sizes using (r), totals),
scored as (
    select q, r, sum(part)::bigint as score from asked join impacts using (t) group by q, r),
ranked as (
    select q, doc_id, score, row_number() over (partition by q order by score desc, doc_id) as rank
    from scored join docs using (r) where score > 0)
select item_id, rank::int as rank, doc_id, score from ranked join items using (q)
where rank <= {lexical.K}"""
