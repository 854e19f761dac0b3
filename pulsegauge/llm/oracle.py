"""SQL for the queries it can express, for DuckDB."""

from __future__ import annotations

from . import mixing, negatives, quality, urls, warc

ORACLE: dict[str, str] = {}

_WORD = r"[^\x20\x09-\x0D]+"

_WEIGHTS = "[" + ", ".join(map(str, mixing.WEIGHTS)) + "]"

ORACLE["op1_mixing"] = f"""
with docs as (
  select doc_id, source, coalesce(md5(doc_id::varchar), '') as h,
         coalesce(len(regexp_extract_all(text, '{_WORD}')), 0)::bigint as size
  from documents),
placed as (
  select *, ('0x' || h[1:4])::bigint % {mixing.SALTS} as salt,
         case when size < 16 then size
              else (length(bin(size)) - 1) * 16 + ((size >> (length(bin(size)) - 5)) & 15) end as band
  from docs),
sources as (
  select source, sum(size)::bigint as source_size,
         {_WEIGHTS}[1 + (row_number() over (order by source nulls last) - 1) % {len(mixing.WEIGHTS)}]
           as weight
  from docs group by source),
filled as (
  select *, {mixing.MOST} * source_size as cap, {mixing.MOST} * source_size / weight as fill,
         sum(source_size) over () as total
  from sources),
levels as (
  select *, (total - coalesce(sum(cap) over (order by fill, source nulls last
                       rows between unbounded preceding and 1 preceding), 0))
            / sum(weight) over (order by fill, source nulls last
                       rows between current row and unbounded following) as level
  from filled),
targets as (
  select source, source_size, least(weight * settled, cap)::double as target,
         ('0x' || md5('{mixing.SEED}:' || coalesce(source, ''))[1:8])::bigint / {mixing.SPAN}.0::double
           as tooth
  from (select *, max(level) over () as settled from levels)),
ranked as (
  select p.doc_id, p.size, t.*, row_number() over (partition by p.source
           order by p.band, p.salt, p.size, p.h, p.doc_id) as n,
         case when t.source_size > 0 then t.target / t.source_size else 0 end as expected
  from placed p join targets t on p.source is not distinct from t.source)
select doc_id, size, source_size, target,
       ((floor(n * expected + tooth) - floor((n - 1) * expected + tooth))::int * size)::bigint as taken
from ranked
"""

ORACLE["op2_warc"] = f"""
with held as (
  select page_id, strlen(coalesce(html, '')) as payload_bytes,
         sha1(coalesce(html, '')) as payload_digest from pages),
lasting as (
  select *, max(page_id) over (partition by payload_digest, payload_bytes) as last from held),
typed as (
  select *, payload_bytes >= {warc.REVISIT_BYTES} and page_id is distinct from last as again
  from lasting)
select page_id, payload_bytes, payload_digest,
       case when again then 'revisit' else 'response' end as record_type,
       case when again then last end as refers_to
from typed
"""


def _any(terms: tuple[str, ...]) -> str:
    return " + ".join(
        f"regexp_matches(lowered, '(^|[^a-z0-9]){t}($|[^a-z0-9])')::int" for t in terms
    )


_RULES = ", ".join(f"('{r.host}', '{r.path}', '{r.name}', '{r.verdict}')" for r in urls.RULES)

ORACLE["op3_url_filters"] = f"""
with rules(rule_host, rule_path, name, verdict) as (values {_RULES}),
cut as (
  select page_id, translate(coalesce(url, ''), '{urls.UPPER}', '{urls.LOWER}') as lowered,
         case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest
  from pages),
parts as (
  select page_id, lowered,
         translate(regexp_extract(rest, '^[^/?#]*'), '{urls.UPPER}', '{urls.LOWER}') as host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
  from cut),
ruled as (
  select *, (select {{'name': name, 'verdict': verdict}} from rules
             where (host = rule_host or ends_with(host, '.' || rule_host))
               and starts_with(path, rule_path)
             order by length(name) desc limit 1) as r
  from parts)
select page_id, host, path, r.name as rule,
       coalesce(r.verdict,
         case when {_any(urls.STRICT)} > 0 or {_any(urls.SOFT)} >= {urls.SOFT_LIMIT}
              then 'block' else 'allow' end) as verdict
from ruled
"""

ORACLE["op4_quality"] = f"""
with docs as (
  select doc_id, coalesce(text, '') as text, row_number() over () as r from documents),
split as (
  select *, regexp_extract_all(text, '{_WORD}') as w,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) as lines
  from docs),
windows as (
  select r, i, count(*) over (partition by r, w[i], w[i + 1], w[i + 2]) as n
  from (select r, w, unnest(range(1, len(w) - 1)) as i from split)),
repeated as (
  select r, count(distinct j) as n
  from (select r, unnest([i, i + 1, i + 2]) as j from windows where n > 1) group by r),
counts as (
  select doc_id, len(w)::bigint as n_words, length(array_to_string(w, ''))::bigint as word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
         (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
         coalesce(n, 0)::bigint as n_repeat_words
  from split left join repeated using (r))
select *, n_words < {quality.LEAST_WORDS}
            or 100 * n_repeat_words > {quality.MOST_REPEATED} * n_words as base_failed,
       not (n_words < {quality.LEAST_WORDS}
            or 100 * n_repeat_words > {quality.MOST_REPEATED} * n_words
            or 10 * n_symbols > n_words
            or word_chars < 2 * n_words or word_chars > 15 * n_words) as kept
from counts
"""

ORACLE["op7_passages"] = f"""
with docs as (
  select doc_id, coalesce(regexp_extract_all(text, '{_WORD}'), []) as w,
         row_number() over () as r from documents),
windows as (
  select r, i, doc_id > min(doc_id) over (partition by k) as gone
  from (select r, doc_id, i, array_to_string(w[i : i + 12], ' ') as k
        from (select r, doc_id, w, unnest(range(1, len(w) - 11)) as i from docs))),
removed as (
  select r, list(distinct i + j) as places
  from windows, range(13) t(j) where gone group by r),
kept as (
  select doc_id, len(w) as n, len(coalesce(places, [])) as gone,
         case when places is null then w
              else list_filter(w, lambda x, i: not list_contains(places, i)) end as k
  from docs left join removed using (r))
select doc_id, n::bigint as n_words, gone::bigint as n_removed,
       sha256(array_to_string(k, ' ')) as kept_sha256
from kept
"""

# The CRC of a decimal number, byte by byte and bit by bit.
_CRC32 = """xor(list_reduce(
    list_prepend(4294967295::ubigint, list_transform(range(1, length({0}) + 1), lambda i: ord({0}[i])::ubigint)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), [0::ubigint, 0, 0, 0, 0, 0, 0, 0]),
                          lambda x, z: xor(x >> 1, (x & 1) * 3988292384::ubigint))), 4294967295::ubigint)"""

ORACLE["op11_prefix_trie"] = f"""
with told as (
  select conv_id, turn, coalesce(text, '') as text,
         sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) as said
  from conversations where conv_id is not null),
turns as (
  select *, row_number() over (partition by conv_id order by turn nulls first, said) as pos from told),
convs as (
  select conv_id as c, conv_id - conv_id % 5 as base, count(*) as n,
         ({_CRC32.format("(conv_id::varchar)")} % 9)::bigint as h
  from turns group by conv_id),
heads as (
  select c, pos as depth, said, text from convs join turns on conv_id = base and pos <= h),
lengths as (
  select c, h, n, coalesce(b, 0) as b, coalesce(b, 0) + greatest(n - h, 0) as len
  from convs left join (select c, max(depth) as b from heads group by c) using (c)),
rebuilt as (
  select * from heads
  union all
  select c, pos - h + b, said, text from lengths join turns on conv_id = c and pos > h),
keyed as (
  select c, depth, strlen(text) as size,
         md5(string_agg(said, ',') over (partition by c order by depth)) as k from rebuilt),
prefixes as (
  select c, depth, size, k, coalesce(lag(k) over (partition by c order by depth), '') as parent from keyed
  union all
  select c, 0, 0, '', null from convs),
nodes as (
  select depth, k, min(parent) as parent, min(c) as rep, count(*) as n, min(size) as size
  from prefixes group by depth, k),
children as (select depth - 1 as depth, parent as k, count(*) as n_children from nodes group by all),
whole as (select nodes.*, coalesce(n_children, 0) as n_children from nodes left join children using (depth, k)),
sums as (
  select p.depth, p.k, sum((w.n - 1) * w.size) as saved, count_if(w.n_children = 0) as leaves
  from whole w join prefixes p on p.c = w.rep and p.depth <= w.depth group by all),
ends as (
  select depth, k, sha256(string_agg(c::varchar, ',' order by c)) as ends_sha256
  from prefixes join lengths using (c) where depth = len group by all)
select w.rep as conv_id, w.depth, p.rep as parent_conv_id, w.n as n_convs, w.n_children,
       leaves::bigint as n_leaves, saved::bigint as saved_tokens,
       coalesce(ends_sha256, sha256('')) as ends_sha256
from whole w join sums using (depth, k) left join ends using (depth, k)
left join nodes p on p.depth = w.depth - 1 and p.k = w.parent
"""

ORACLE["op12_hard_negatives"] = f"""
with vectors as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(x::double * {negatives.SCALE})) as v
  from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select a.vec_id as anchor_id, x.vec_id, a.label = x.label as same,
         list_inner_product(a.v, x.v)::bigint as score
  from vectors a join vectors x on a.vec_id % 50 = 0 and a.vec_id <> x.vec_id),
positives as (
  select anchor_id, vec_id as positive_id, score as positive_score from scored where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= {negatives.POSITIVES})
select anchor_id, positive_id,
       row_number() over (partition by anchor_id, positive_id order by score desc, vec_id)::int as rank,
       vec_id as negative_id, positive_score, score as negative_score
from positives join scored using (anchor_id)
where not same and {negatives.LEAST} * positive_score <= 100 * score
  and 100 * score <= {negatives.MOST} * positive_score
qualify rank <= {negatives.NEGATIVES}
"""

ORACLE["op13_near_duplicates"] = f"""
with recursive docs as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') as w
  from documents),
sets as (
  select doc_id, list_distinct(case when len(w) = 0 then []
           when len(w) < 5 then [list_aggregate(w, 'string_agg', ' ')]
           else list_transform(range(1, len(w) - 3), lambda i: list_aggregate(w[i:i + 4], 'string_agg', ' '))
           end) as s
  from docs),
distinct_sets as (
  select min(doc_id) as id, list(doc_id) as members, any_value(s) as s, k
  from (select *, md5(list_aggregate(list_sort(s), 'string_agg', '\n')) as k from sets where len(s) > 0)
  group by k),
shingles as (select id, len(s) as n, hash(unnest(s)) as shingle from distinct_sets),
few as (
  select shingle from shingles group by shingle having count(*) > 1),
links as (
  select a.id as u, b.id as v
  from (select * from shingles semi join few using (shingle)) a
  join (select * from shingles semi join few using (shingle)) b on a.shingle = b.shingle and a.id <> b.id
  where 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  group by a.id, b.id having 100 * count(*) >= 85 * (min(a.n) + min(b.n) - count(*))),
reached as (
  select id as u, id as v from distinct_sets
  union
  select reached.u, links.v from reached join links on reached.v = links.u),
named as (select u as id, min(v) as component_id from reached group by u),
owned as (
  select unnest(members) as doc_id, component_id from distinct_sets join named using (id))
select doc_id, len(s)::bigint as n_shingles, coalesce(component_id, doc_id) as component_id,
       doc_id = coalesce(component_id, doc_id) as kept
from sets left join owned using (doc_id)
"""
