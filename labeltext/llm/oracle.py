"""DuckDB SQL for the queries that SQL can express, over whole tables.

op3, op7, op8 and op9 have none: a tokenizer's vocabulary, an HTML reader and trained models
aren't SQL. tests/llm holds them against brute force."""

from __future__ import annotations

from labeltext.llm.mixing import KEEP, OTHER, ROUNDS, Targets

WORDS = r"regexp_extract_all(coalesce({text}, ''), '[^\x20\x09-\x0D]+')"
LOWER = "translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ALNUM = r"regexp_extract_all({text}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _share(margin: str, targets: dict[str, float]) -> str:
    cases = " ".join(f"when '{k}' then {v!r}" for k, v in targets.items())
    return f"case {margin} {cases} end"


def _mixing() -> str:
    t = Targets()
    group = lambda c, d: f"case when {c} in ({', '.join(repr(k) for k in d if k != OTHER)}) then {c} else '{OTHER}' end"
    steps, last = [], "cells"
    margins = {"source_group": t.source, "lang_group": t.lang, "topic": t.topic}
    number = 0
    for _ in range(ROUNDS):
        for margin, targets in margins.items():
            number += 1
            share = _share(margin, targets)
            steps.append(
                f"m{number} as materialized (select margin_{number}.source_group, "
                f"margin_{number}.lang_group, margin_{number}.topic, size, "
                f"fit * ({share}) / total_share / now as fit from "
                f"(select *, sum(fit) over (partition by {margin}) as now from {last} where fit > 0) margin_{number}, "
                f"(select sum(s) as total_share from (select distinct {margin}, ({share}) as s from {last} where fit > 0)))"
            )
            last = f"m{number}"
    scales = [f"c0 as materialized (select {KEEP!r}::double as scale)"]
    for k in range(ROUNDS):
        scales.append(
            f"c{k + 1} as materialized (select any_value(scale) * {KEEP!r} / "
            f"(sum(size * least(1.0, scale * weight)) / sum(size)) as scale from weighed, c{k})"
        )
    return f"""
with tokens as (
  select doc_id, source, lang, coalesce(text, '') as text,
    len({WORDS.format(text="text")})::bigint as n_tokens from documents
), named as (
  select doc_id, n_tokens, {group("source", t.source)} as source_group,
    {group("lang", t.lang)} as lang_group,
    case when contains(text, ' | ') then 'table'
      when contains(text, 'License') or contains(text, 'Copyright') then 'license'
      when regexp_matches(text, '[#$%&*]{{3}}') then 'noisy'
      when n_tokens >= 600 then 'long' when n_tokens < 60 then 'short' else 'prose' end as topic
  from tokens
), sizes as (
  select source_group, lang_group, topic, sum(n_tokens)::double as size from named group by all
), cells as materialized (
  select *, size / (select sum(size) from sizes) as fit from sizes
), {", ".join(steps)},
weighed as materialized (
  select source_group, lang_group, topic, s.size,
    coalesce(m.fit, 0) / s.size * (select sum(size) from sizes) as weight
  from sizes s left join {last} m using (source_group, lang_group, topic) where s.size > 0
), {", ".join(scales)}
select doc_id, source_group, lang_group, topic, n_tokens,
  round(coalesce(weight, 1.0), 6) as weight,
  round(case when weight is null then {KEEP!r} else least(1.0, scale * weight) end, 6)
    as keep_probability,
  ('0x' || substr(md5('0:' || coalesce(doc_id::varchar, '')), 1, 8))::bigint / 4294967296.0
    < case when weight is null then {KEEP!r} else least(1.0, scale * weight) end as sampled
from named left join weighed using (source_group, lang_group, topic), c{ROUNDS}
"""


REPEATS = f"""
with words as materialized (
  select doc_id, {WORDS.format(text="text")} as w from documents
), starts as (
  select doc_id, unnest(range(1, len(w) - 11)) as i from words where len(w) >= 13
), windows as materialized (
  select doc_id, i, array_to_string(w[i : i + 12], ' ') as code from starts join words using (doc_id)
), firsts as (select code, min(doc_id) as first from windows group by code),
covered as (
  select distinct doc_id, unnest(range(i, i + 13)) as i
  from windows join firsts using (code) where first < doc_id
), gone as (select doc_id, count(*) as n, list(i) as at from covered group by doc_id),
flat as (
  select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as i from words
), kept as (
  select doc_id, string_agg(word, ' ' order by i) as text
  from flat anti join covered using (doc_id, i) group by doc_id
)
select doc_id, len(w)::bigint as n_words, coalesce(n, 0)::bigint as n_removed,
  sha256(coalesce(kept.text, '')) as kept_sha256
from words left join gone using (doc_id) left join kept using (doc_id)
"""

BENCHMARK = f"""
with words as materialized (
  select doc_id, {ALNUM.format(text=LOWER.format(text="coalesce(text, '')"))} as w from documents
), items as materialized (
  select item_id::varchar as item, {ALNUM.format(text=LOWER.format(text="coalesce(text, '')"))} as w
  from benchmark
), phrases as materialized (
  select distinct item, least(len(w), 10) as size,
    array_to_string(w[i : i + least(len(w), 10) - 1], ' ') as code
  from (select item, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) as i from items where len(w) > 0)
), sizes as (select distinct size from phrases),
windows as (
  select doc_id, size, unnest(range(1, len(w) - size + 2)) as i from words, sizes where len(w) >= size
), coded as (
  select doc_id, size, i, array_to_string(w[i : i + size - 1], ' ') as code
  from windows join words using (doc_id)
), hits as materialized (select doc_id, i, size, item from coded join phrases using (size, code)),
covered as (
  select doc_id, count(distinct j) as n from
    (select doc_id, unnest(range(i, i + size)) as j from hits) group by doc_id
), named as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
  from (select distinct doc_id, item from hits) group by doc_id
)
select doc_id, len(w)::bigint as n_words, coalesce(n, 0)::bigint as n_hit,
  coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(items, '')) as items_sha256,
  coalesce(n, 0) > 0 as contaminated
from words left join covered using (doc_id) left join named using (doc_id)
"""

TOP_K = """
with good as materialized (
  select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)::bigint) as v from embeddings
  where embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select q.vec_id as query_id, c.vec_id,
    coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda p: coalesce(p[1], 0) * coalesce(p[2], 0))), 0)::bigint
      as score
  from good q join good c on q.vec_id % 20 = 0 and c.vec_id <> q.vec_id
), ranked as (
  select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank
  from scored
)
select query_id, rank, vec_id, score from ranked where rank <= 20
"""

ARCHIVE = """
with payloads as (
  select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as hex from pages
), firsts as (
  select *, min(page_id) over (partition by html) as first from payloads
)
select page_id, strlen(html)::bigint as payload_bytes,
  list_aggregate(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(hex, 1 + (k // 4) * 5, 5))::bigint >> (15 - 5 * (k % 4))) & 31)::int, 1)),
    'string_agg', '') as payload_digest,
  case when page_id = first then 'response' else 'revisit' end as record_type,
  case when page_id = first then null else first end as refers_to
from firsts
"""

NEAR = f"""
with recursive words as materialized (
  select doc_id, {WORDS.format(text=LOWER.format(text="coalesce(text, '')"))} as w from documents
), shingles as materialized (
  select distinct doc_id, array_to_string(w[i : i + 4], ' ') as code from
    (select doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) as i from words where len(w) > 0)
), sizes as materialized (select doc_id, count(*) as n from shingles group by doc_id),
pairs as (
  select a.doc_id as a, b.doc_id as b, count(*) as common
  from shingles a join shingles b on a.code = b.code and a.doc_id < b.doc_id group by all
), links as materialized (
  select a, b from pairs join sizes x on x.doc_id = a join sizes y on y.doc_id = b
  where 100 * common >= 75 * (x.n + y.n - common)
), both_ways as materialized (select a, b from links union select b, a from links),
reach as (
  select a as doc_id, b as other from both_ways
  union select reach.doc_id, both_ways.b from reach join both_ways on reach.other = both_ways.a
), least_id as (select doc_id, min(other) as component from reach group by doc_id)
select w.doc_id, coalesce(n, 0)::bigint as n_shingles,
  least(w.doc_id, coalesce(component, w.doc_id)) as component_id
from words w left join sizes using (doc_id) left join least_id using (doc_id)
"""

PHRASES = rf"""
with pieces as (
  select coalesce(lang, 'und') as lang, doc_id, unnest(regexp_split_to_array(
    {LOWER.format(text="coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]')) as piece from documents
), words as materialized (
  select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces
), sizes as (select lang, sum(len(w))::bigint as n from words group by lang),
places as (
  select lang, w, unnest(range(1, len(w) + 1)) as i from words
), grams as (
  select lang, w[i : i + k - 1] as p, k from places, unnest(range(1, 6)) as ks(k)
  where i + k - 1 <= len(w)
), frequent as materialized (
  select lang, p, k, count(*)::hugeint as f from grams group by all having count(*) >= 100
), inside as (
  select lang, f, unnest([p[j : j + m - 1] for j in range(1, k - m + 2)]) as p
  from (select lang, p, k, f, unnest(range(2, k)) as m from frequent where k > 2)
), closed as (
  select * from frequent c where k > 1
    and not exists (select 1 from inside i where i.lang = c.lang and i.p = c.p and i.f >= c.f)
), cuts as (
  select c.lang, c.p, c.f as a, j, x.f as l, y.f as r, n, (1000 * c.f * n) // (x.f * y.f) as score
  from (select *, unnest(range(1, k)) as j from closed) c
  join frequent x on x.lang = c.lang and x.p = c.p[1 : j]
  join frequent y on y.lang = c.lang and y.p = c.p[j + 1 : ]
  join sizes s on s.lang = c.lang
), best as (
  select * from cuts qualify row_number() over (partition by lang, p order by score, j) = 1
), ranked as (
  select *, array_to_string(p, ' ') as phrase from best
)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank,
  phrase, a::bigint as a, l::bigint as l, r::bigint as r, n::bigint as n, score::bigint as score
from ranked qualify rank <= 2000
"""

# CRC-32, bit by bit; 3988292384 is its polynomial.
CRC = """xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(
  range(1, len(c::varchar) + 1), lambda i: ascii(substr(c::varchar, i, 1))::bigint)),
  lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0::bigint, 0, 0, 0, 0, 0, 0, 0]),
    lambda x, y: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end)))"""

TRIE = f"""
with turns as materialized (
  select conv_id, row_number() over (partition by conv_id order by turn nulls first,
    sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 as place,
    {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} as t
  from conversations where conv_id is not null
), originals as materialized (
  select conv_id as c, list(t order by place) as w from turns group by conv_id
), sharing as materialized (select c, w, c - c % 5 as base, {CRC} % 9 as h from originals),
rebuilt as materialized (
  select s.c, list_concat(coalesce(o.w[1 : s.h], []), s.w[s.h + 1 :]) as w
  from sharing s left join originals o on o.c = s.base
), paths as materialized (
  select c, len(w) as size, d, w[1 : d] as p from (select c, w, unnest(range(0, len(w) + 1)) as d from rebuilt)
), nodes as materialized (
  select p, d, min(c) as conv_id, count(*) as n_convs,
    coalesce(string_agg(case when size = d then c::varchar end, ',' order by c), '') as ends
  from paths group by p, d
), edges as materialized (
  select n.p, n.d, q.p as parent, q.conv_id as parent_conv_id
  from nodes n join nodes q on q.d = n.d - 1 and q.p = n.p[1 : n.d - 1] where n.d > 0
), children as (select parent as p, d - 1 as d, count(*) as n from edges group by all),
below as (
  select x.p[1 : k] as p, k as d,
    sum(case when x.d = 0 then 0 else (x.n_convs - 1) * strlen(x.p[x.d].text) end) as saved,
    count(*) filter (where not exists (select 1 from edges e where e.d = x.d + 1 and e.parent = x.p)) as leaves
  from (select *, unnest(range(0, d + 1)) as k from nodes) x group by all
)
select n.conv_id, n.d as depth, e.parent_conv_id, n.n_convs, coalesce(ch.n, 0) as n_children,
  b.leaves as n_leaves, b.saved::bigint as saved_tokens, sha256(n.ends) as ends_sha256
from nodes n left join edges e on e.p = n.p and e.d = n.d
left join children ch on ch.p = n.p and ch.d = n.d join below b on b.p = n.p and b.d = n.d
"""

ORACLE: dict[str, str] = {
    "op1_mixing": _mixing(),
    "op2_suffix_trees": REPEATS,
    "op4_fm_index": BENCHMARK,
    "op5_top_k": TOP_K,
    "op6_warc_bundles": ARCHIVE,
    "op10_jaccard_join": NEAR,
    "op12_phrases": PHRASES,
    "op13_prefix_trie": TRIE,
}
