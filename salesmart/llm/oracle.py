"""DuckDB twins of the corpus queries that SQL can express."""

from __future__ import annotations

_LOWER = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _words(text: str) -> str:
    split = f"string_split_regex({_LOWER.format(text)}, '[\\x20\\x09-\\x0D]+')"
    return f"list_filter({split}, lambda w: w <> '')"


def _shingles(words: str) -> str:
    """The five-word shingles of a list, in order; the whole of a shorter one."""
    return (
        f"list_transform(range(1, greatest(len({words}) - 4, least(len({words}), 1)) + 1), "
        f"lambda i: array_to_string({words}[i : i + 4], ' '))"
    )


# Each step takes one byte: eight shifts by the polynomial, written as one expression over a
# table of 256 remainders that the rule itself makes.
_CRC32 = """
crc_step as (
  select n, k, c from (select n, 0 as k, n::ubigint as c from range(256) t(n))
  union all
  select n, k + 1, case when c & 1 = 1 then xor(c >> 1, 3988292384::ubigint) else c >> 1 end
  from crc_step where k < 8
),
crc_table as (select list(c order by n) as rest from crc_step where k = 8)
"""

OP3 = f"""
with recursive {_CRC32},
bytes as (
  select row_number() over () as r, doc_id, hex(encode(coalesce(text, ''))) as h from documents
),
sums as (
  select r, doc_id, (len(h) // 2 + 1)::bigint as size,
    xor(list_reduce(
      list_concat([4294967295::ubigint], list_transform(
        regexp_extract_all(h, '..'),
        lambda x: (16 * strpos('123456789ABCDEF', x[1]) + strpos('123456789ABCDEF', x[2]))::ubigint
      )),
      lambda c, b: xor(c >> 8, rest[(xor(c, b) & 255)::bigint + 1])
    ), 4294967295::ubigint)::bigint as text_crc32
  from bytes, crc_table
),
placed as (
  select *, sum(size) over (order by doc_id nulls first, r) as upto, sum(size) over () as total
  from sums
),
cut as (
  select *, least(7, ((2 * upto - size) * 8) // (2 * total))::int as shard from placed
)
select doc_id, size, text_crc32, 'bytes' as law, shard,
  row_number() over (partition by shard order by upto, r) - 1 as slot, null::int as grown_shard
from cut
"""

OP5 = r"""
with rows as (
  select conv_id, turn, role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'
),
sized as (
  select *,
    len(text) + len(text) - len(replace(text, '\', ''))
    + (len(text) - len(replace(text, '</turn>', ''))) // 7
    + len(list_filter(range(1, len(text) - 1), lambda i: text[i : i + 2] = '###'))
    + case role when 'system' then len('### System: ') when 'user' then len('### User: ')
        when 'assistant' then len('### Assistant: ')
        else len('### Role : ') + coalesce(len(hex(encode(role))), 1) end
    + len(' </turn>') + 1 as chars,
    lag(role, 1, 'start') over w as before,
    lead(turn) over w is null and coalesce(role, '') <> 'assistant' as open_end
  from rows
  window w as (partition by conv_id order by turn, coalesce(role, ''), text)
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(coalesce(role, '') || chr(10) || text || chr(10), ''
    order by turn, coalesce(role, ''), text)) as turns_sha256,
  coalesce(sum(len(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, coalesce(role, ''), text)
    filter (role = 'assistant'), '')) as loss_sha256,
  sum(chars)::bigint as formatted_chars,
  not bool_or(open_end) and bool_and(coalesce(concat(before, '>', role) in (
    'start>system', 'start>user', 'system>user', 'user>assistant', 'assistant>user'), false)
  ) as valid
from sized group by conv_id
"""

OP4 = f"""
with recursive texts as (
  select row_number() over () as r, doc_id, {_words("text")} as words from documents
),
sets as (select r, doc_id, list_distinct({_shingles("words")}) as s from texts),
posted as (
  select distinct doc_id, len(s) as n, hash(x) as h from (select doc_id, s, unnest(s) as x from sets)
),
links as (
  select a.doc_id as a, b.doc_id as b from posted a join posted b on a.h = b.h and a.doc_id < b.doc_id
  group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 75 * (a.n + b.n - count(*))
),
both_ways as (select a, b from links union all select b, a from links),
reached as (
  select distinct doc_id as a, doc_id as b from sets
  union
  select r.a, e.b from reached r join both_ways e on r.b = e.a
),
parts as (select a, min(b) as component_id from reached group by a)
select doc_id, len(s)::bigint as n_shingles, component_id, doc_id = component_id as kept
from sets join parts on a = doc_id
"""


def _weighted(words: str) -> str:
    return (
        f"list_distinct(list_transform(range(1, greatest(len({words}) - 4, least(len({words}), 1)) "
        f"+ 1), lambda i: {{'s': array_to_string({words}[i : i + 4], ' '), 'w': 1 + "
        f"len(list_filter({words}[i : i + 4], lambda w: len(w) > 3))}}))"
    )


OP2 = f"""
with items as (
  select item_id, words, len(words) as n, {_weighted("words")} as s
  from (select item_id, {_words("text")} as words from benchmark) where len(words) > 0
),
posted as (
  select item_id, n, h, min(place) as place from (
    select item_id, n, generate_subscripts({_shingles("words")}, 1) as place,
      unnest({_shingles("words")}) as h from items)
  group by item_id, n, h
),
texts as (select distinct doc_id, {_words("text")} as words from documents),
places as (
  select doc_id, words, generate_subscripts({_shingles("words")}, 1) as p,
    unnest({_shingles("words")}) as h from texts
),
windows as (
  select distinct doc_id, greatest(p - place, 0) + 1 as start,
    words[greatest(p - place, 0) + 1 : p - place + n] as words
  from places join posted using (h)
),
shared as (
  select doc_id, start, len(words) as n_words, {_weighted("words")} as s, words from windows
),
pairs as (
  select doc_id, item_id, start, n_words,
    coalesce(list_sum(list_transform(list_intersect(a.s, b.s), lambda x: x.w)), 0) as common,
    list_sum(list_transform(a.s, lambda x: x.w)) + list_sum(list_transform(b.s, lambda x: x.w))
      as sum_
  from shared a join items b
    on list_has_any(list_transform(a.s, lambda x: x.s), list_transform(b.s, lambda x: x.s))
)
select doc_id, item_id, arg_max(start, (similarity, -start))::int as start,
  arg_max(n_words, (similarity, -start))::int as n_words, max(similarity) as similarity
from (select *, common / (sum_ - common) as similarity from pairs
      where 100 * common >= 75 * (sum_ - common))
group by doc_id, item_id
"""

_TERMS = (
    f"regexp_extract_all({_LOWER.format('text')}, "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)

OP11 = f"""
with item_terms as (
  select item_id, t, count(*) as times
  from (select item_id, unnest({_TERMS}) as t from benchmark)
  group by all
),
doc_terms as (
  select doc_id, unnest({_TERMS}) as t from documents
),
lengths as (select doc_id, count(*) as n from doc_terms group by doc_id),
corpus as (select count(*) as docs, sum(n)::bigint as total from lengths),
counts as (
  select doc_id, t, count(*) as tf from doc_terms where t in (select t from item_terms) group by all
),
weights as (
  select t, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::bigint as w
  from counts, corpus group by t, docs
),
scored as (
  select item_id, doc_id,
    sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // total))))::bigint as score
  from item_terms join counts using (t) join weights using (t) join lengths using (doc_id), corpus
  group by all
)
select item_id, row_number() over (partition by item_id order by score desc, doc_id)::int as rank,
  doc_id, score
from scored where score > 0
qualify rank <= 10
"""

OP12 = rf"""
with pieces as (
  select row_number() over () as piece, lang,
    list_filter(string_split_regex(p, '[\x20\x09]+'), lambda w: w <> '') as w
  from (
    select coalesce(lang, 'und') as lang,
      unnest(string_split_regex({_LOWER.format('text')}, '[.,;:!?\x0A-\x0D]')) as p
    from documents
  )
),
places as (
  select lang, w, unnest(range(1, len(w) + 1)) as i from pieces
),
phrases as (
  select lang, size, array_to_string(w[i : i + size - 1], ' ') as phrase, count(*) as f
  from places, (values (1), (2), (3)) s(size)
  where i + size - 1 <= len(w)
  group by all
),
totals as (select lang, sum(f)::bigint as n from phrases where size = 1 group by lang),
candidates as (select *, string_split(phrase, ' ') as w from phrases where size > 1 and f >= 10),
held as (
  select c.lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) as phrase, f
  from candidates c where size = 3
),
kept as (
  select c.* from candidates c left join (select lang, phrase, max(f) as more from held group by all) h
    on c.lang = h.lang and c.phrase = h.phrase and size = 2
  where more is null or 100 * more < 50 * f
),
cuts as (
  select lang, size, phrase, f as a, k,
    array_to_string(w[1:k], ' ') as lefts, array_to_string(w[k + 1:size], ' ') as rights
  from kept, (values (1), (2)) s(k) where k < size
),
scored as (
  select c.lang, c.phrase, a, x.f as l, y.f as r,
    ((1000000::hugeint * a * a) // (x.f::hugeint * y.f))::bigint as score, k
  from cuts c join phrases x on x.lang = c.lang and x.phrase = lefts
    join phrases y on y.lang = c.lang and y.phrase = rights
),
lowest as (
  select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1
)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank,
  phrase, a, l, r, n, score
from lowest join totals using (lang)
qualify rank <= 2000
"""

ORACLE: dict[str, str] = {
    "op2_decontamination": OP2,
    "op3_sharding": OP3,
    "op4_near_dedup": OP4,
    "op5_chat_format": OP5,
    "op11_lexical_search": OP11,
    "op12_collocations": OP12,
}
