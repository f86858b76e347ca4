"""DuckDB SQL of the registered queries that SQL can express."""

from __future__ import annotations

import string

from .queries import URL_RULES

_LOWER = f"translate({{}}, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
_WORDS = "[x for x in string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+') if x <> '']"
_TEST_WORDS = f"regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


def _windows(table: str, key: str, width: int) -> str:
    """Every window of ``width`` words of ``table`` (key, ws): key, its first
    word's place and its words as text."""
    return f"""select {key}, i, array_to_string(ws[i:i + {width - 1}], ' ') as w
  from (select {key}, ws, unnest(range(1, len(ws) - {width} + 2)) as i from {table})"""


OP4 = f"""with d as (select doc_id, {_TEST_WORDS} as ws from documents),
b as (select coalesce(cast(item_id as varchar), '') as item, {_TEST_WORDS} as ws from benchmark),
sized as (select item, ws, least(10, len(ws)) as n from b where len(ws) > 0),
items as (select distinct item, n, array_to_string(ws[i:i + n - 1], ' ') as w
  from (select item, ws, n, unnest(range(1, len(ws) - n + 2)) as i from sized)),
lengths as (select distinct n from items),
starts as (select doc_id, n, ws, unnest(range(1, len(ws) - n + 2)) as i from d, lengths),
hits as (select s.doc_id, s.n, s.i, t.item from starts s join items t on s.n = t.n and array_to_string(s.ws[s.i:s.i + s.n - 1], ' ') = t.w),
covered as (select doc_id, count(distinct k) as n_hit from (select doc_id, unnest(range(i, i + n)) as k from hits) group by doc_id),
named as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as names from (select distinct doc_id, item from hits) group by doc_id)
select d.doc_id, len(d.ws) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join covered using (doc_id) left join named using (doc_id)"""

OP6 = f"""with d as (select doc_id, {_WORDS} as ws from documents),
windows as ({_windows("d", "doc_id", 35)}),
twice as (select w from windows group by w having count(*) > 1),
covered as (select distinct doc_id, unnest(range(i, i + 35)) as k from windows where w in (select w from twice)),
places as (select doc_id, unnest(range(1, len(ws) + 1)) as k, unnest(ws) as word from d),
kept as (select p.doc_id, count(c.k) as n_removed, string_agg(p.word, ' ' order by p.k) filter (c.k is null) as text
  from places p left join covered c on p.doc_id = c.doc_id and p.k = c.k group by p.doc_id)
select d.doc_id, len(ws) as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(text, '')) as kept_sha256
from d left join kept using (doc_id)"""

_RULES = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in URL_RULES)
_HOST = _LOWER.format("regexp_extract({0}, '(?s)^.*?://([^/?#]*)', 1)")
_PATH = "regexp_extract({0}, '(?s)^.*?://[^/?#]*([^?#]*)', 1)"


def _node(url: str) -> str:
    scheme = f"regexp_replace(lower(regexp_extract({url}, '(?s)^\\s*([a-zA-Z][a-zA-Z0-9+.-]*)://', 1)), '^https$', 'http')"
    path = _PATH.format(url)
    query = f"regexp_extract({url}, '(?s)^.*?://[^/?#]*[^?#]*([^#]*)', 1)"
    return f"nullif({scheme}, '') || '://' || nullif({_HOST.format(url)}, '') || case when {path} = '' then '/' else {path} end || {query}"


def _attribute(name: str) -> str:
    value = f"regexp_extract(tag, '(?is)\\s{name}\\s*=\\s*(\"[^\"]*\"|''[^'']*''|[^\\s\"''>]+)', 1)"
    return f"trim(regexp_replace({value}, '^[\"'']|[\"'']$', '', 'g'))"


def _ruled(table: str, key: str) -> str:
    return f"""select {key}, max_by({{'rule': r.host || r.path, 'verdict': r.verdict}}, length(r.host || r.path) * 2 + (r.verdict = 'allow')::int) as best
  from {table} t join rules r on (t.host = r.host or ends_with(t.host, '.' || r.host)) and starts_with(t.path, r.path) group by {key}"""


_SHOWN = "regexp_replace(html, '(?is)<!--.*?(?:-->|\\z)" + "".join(f"|<{t}\\b.*?(?:</{t}\\s*>|\\z)" for t in ("script", "style", "template")) + "', ' ', 'g')"

OP8 = f"""with recursive rules(verdict, host, path) as (values {_RULES}),
own as (select page_id, coalesce({_HOST.format("url")}, '') as host, coalesce({_PATH.format("url")}, '') as path, {_node("url")} as node from pages),
tags as (select url, unnest(regexp_extract_all({_SHOWN}, '(?is)<(?:link|meta)\\s[^>]*>')) as tag from pages where regexp_matches(html, '(?i)canonical|refresh')),
found as (select url, regexp_replace(case
    when regexp_matches(lower({_attribute("rel")}), '(^|\\s)canonical(\\s|$)') then {_attribute("href")}
    when lower({_attribute("http-equiv")}) = 'refresh' then regexp_extract({_attribute("content")}, '(?is)[;,]\\s*url\\s*=\\s*[''"]?\\s*([^''"]+)', 1)
  end, '(?i)&(amp|#38|#x26);', '&', 'g') as link from tags),
parts as (select url, link, regexp_extract(url, '(?s)^([a-zA-Z][a-zA-Z0-9+.-]*):', 1) as scheme, regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1) as site,
    {_PATH.format("url")} as path from found where link <> ''),
whole as (select url, case
    when regexp_matches(link, '(?s)^[a-zA-Z][a-zA-Z0-9+.-]*:') then link
    when starts_with(link, '//') then scheme || ':' || link
    when starts_with(link, '/') then scheme || '://' || site || link
    when starts_with(link, '?') then scheme || '://' || site || path || link
    when not starts_with(link, '#') then scheme || '://' || site || coalesce(nullif(regexp_extract(path, '(?s)^(.*/)', 1), ''), '/') || link
  end as target from parts),
links as (select {_node("url")} as u, {_node("target")} as v from whole),
edges as (select u, v from links where u <> v union select v, u from links where u <> v),
reached(node, other) as (select u, u from edges union select r.node, e.v from reached r join edges e on r.other = e.u),
places as (select distinct other as node, {_HOST.format("other")} as host, {_PATH.format("other")} as path from reached),
blocked as (select node from ({_ruled("places", "node")}) where best.verdict = 'block'),
aliases as (select distinct node from reached where other in (select node from blocked)),
judged as ({_ruled("own", "page_id")})
select o.page_id, o.host, o.path, j.best.rule as rule,
       coalesce(j.best.verdict, case when a.node is not null then 'block' else 'allow' end) as verdict,
       j.best is null and a.node is not null as inherited
from own o left join judged j using (page_id) left join aliases a on o.node = a.node"""

OP9 = f"""with d as (select doc_id, coalesce(text, '') as text, {_WORDS} as ws from documents),
windows as ({_windows("d", "doc_id", 8)}),
twice as (select doc_id, w from windows group by doc_id, w having count(*) > 1),
covered as (select doc_id, count(distinct k) as n from (select doc_id, unnest(range(i, i + 8)) as k from windows join twice using (doc_id, w)) group by doc_id),
lines as (select doc_id, [x for x in string_split(text, chr(10)) if regexp_matches(x, '[^\\x20\\x09-\\x0D]')] as ls from d),
m as (select d.doc_id, text, len(ws) as n_words, length(regexp_replace(text, '[\\x20\\x09-\\x0D]+', '', 'g')) as word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as n_symbols, len(ls) - len(list_distinct(ls)) as n_dup_lines,
    coalesce(n, 0) as n_repeat_words
  from d join lines using (doc_id) left join covered using (doc_id)),
judged as (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not (base_failed or (n_dup_lines >= 3 and 8 * n_dup_lines > n_words) or 10 * n_symbols > n_words
         or word_chars < 2 * n_words or word_chars > 20 * n_words
         or 2 * length(regexp_replace(text, '[^\\p{{Lu}}]', '', 'g')) > length(regexp_replace(text, '[^\\p{{L}}]', '', 'g'))
         or 4 * len(regexp_extract_all(text, '[!?]{{2,}}')) > n_words) as kept
from judged"""

OP12 = f"""with base as (select doc_id, coalesce(lang, '') as part, coalesce(text, '') as text, {_WORDS} as ws from documents),
told as (select *, min(doc_id) over (partition by text) as first from base),
marked as (select doc_id, part,
    (len(ws) < 200)::int + 2 * (100 * len(list_distinct(ws)) < 50 * len(ws))::int
    + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text))::int
    + 8 * regexp_matches(text, '[#$%&*|]')::int + 16 * coalesce(first < doc_id, false)::int as mask
  from told),
tagged as (select part, mask, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic from marked
  left join (select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic from labels group by doc_id) using (doc_id)),
grouped as (select part, mask, count(*) as n, sum(good) as good, sum(toxic) as toxic from tagged group by all),
letters(x, bit) as (values ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders as (select [a.x, b.x, c.x, d.x, e.x] as names, [a.bit, b.bit, c.bit, d.bit, e.bit] as bits
  from letters a, letters b, letters c, letters d, letters e where len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps as (select array_to_string(names, '') as filter_order, step, bits[step] as own, list_sum(list_concat([0], bits[:step - 1])) as before
  from orders, (select unnest(range(1, 6)) as step)),
figures as (select part, filter_order, step, own,
    sum(n) filter (mask & (before + own) = 0) as kept, sum(n) filter (mask & before = 0 and mask & own > 0) as removed,
    sum(n) filter (mask & before > 0 and mask & own > 0) as redundant, sum(n) filter (mask = own) as unique_fails,
    sum(good) filter (mask & before = 0 and mask & own > 0) as good_lost, sum(toxic) filter (mask & before = 0 and mask & own > 0) as toxic_lost
  from grouped, steps group by all)
select part, filter_order, step::int as step, coalesce(kept, 0)::bigint as kept, coalesce(removed, 0)::bigint as removed, coalesce(redundant, 0)::bigint as redundant,
  coalesce(unique_fails, 0)::bigint as unique_fails, coalesce(good_lost, 0)::bigint as good_lost, coalesce(toxic_lost, 0)::bigint as toxic_lost,
  coalesce(sum(removed) over (partition by part, own), 0)::bigint as shapley
from figures"""

OP13 = """with v as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    [floor(256 * x::double)::bigint for x in embedding] as e
  from embeddings where label is not null and embedding is not null and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
pairs as (select a.vec_id as anchor_id, r.vec_id as other, a.label = r.label as same,
    list_sum([a.e[i] * r.e[i] for i in range(1, len(a.e) + 1)])::bigint as score
  from v a join v r on a.vec_id <> r.vec_id where a.vec_id % 100 = 0),
positives as (select anchor_id, other as positive_id, score as positive_score from pairs where same
  qualify row_number() over (partition by anchor_id order by score desc, other) <= 5)
select anchor_id, positive_id, (row_number() over (partition by anchor_id, positive_id order by score desc, other))::int as rank,
  other as negative_id, positive_score, score as negative_score
from positives join pairs using (anchor_id) where not same and 80 * positive_score <= 100 * score and score <= positive_score
qualify rank <= 5"""

ORACLE: dict[str, str] = {"op4_benchmark_decontamination": OP4, "op6_substring_dedup": OP6, "op8_url_filter": OP8, "op9_quality_rules": OP9, "op12_filter_audit": OP12, "op13_hard_negatives": OP13}
