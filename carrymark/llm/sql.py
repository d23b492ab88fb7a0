"""DuckDB text of the operators that SQL can express."""

_SPACE = r"[ \t\n\v\f\r]"
_CLASSES = {"upper": r"\p{Lu}", "digit": r"\p{Nd}", "mark": r"[.,;:!?()''" + '"' + r"\-]"}


def _distance(shares: str, reference: str) -> str:
    """Jensen-Shannon distance of two lists of shares."""
    half = "case when {a} > 0 then {a} * log2(2 * {a} / ({a} + {b})) else 0 end"
    both = f"{half.format(a='x[1]', b='x[2]')} + {half.format(a='x[2]', b='x[1]')}"
    return (f"sqrt(least(greatest(list_sum(list_transform(list_zip({shares}, {reference}), "
            f"lambda x: {both})) / 2, 0), 1))")


QUALITY_RULES = f"""
with base as (
    select doc_id, coalesce(lang, '') as lang, coalesce(text, '') as text from documents
), tokens as (
    select doc_id, lang, text,
           list_filter(regexp_split_to_array(text, '{_SPACE}+'), lambda w: w <> '') as words
    from base
), counts as (
    select *, len(words) as n_words, length(array_to_string(words, '')) as word_chars,
           length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as n_symbols,
           {", ".join(f"length(text) - length(regexp_replace(text, '{p}', '', 'g')) as n_{c}"
                      for c, p in _CLASSES.items())}
    from tokens
), spoken as (
    select doc_id, lang, unnest(words) as word, generate_subscripts(words, 1) as i from tokens
), windows as (
    select s.doc_id, s.i, count(*) over (partition by s.doc_id, t.words[s.i:s.i + 4]) as times
    from spoken s join tokens t using (doc_id) where s.i + 4 <= len(t.words)
), repeats as (
    select doc_id, count(distinct i + k) as n_repeat_words
    from windows, (select unnest(range(5)) as k) where times > 1 group by doc_id
), lines as (
    select doc_id, count(*) - count(distinct line) as n_dup_lines
    from (select doc_id, unnest(string_split(text, chr(10))) as line from base)
    where regexp_matches(line, '[^ \t\n\v\f\r]') group by doc_id
), classes as (
    select lang, sum(length(text)) as n,
           [sum(length(text) - word_chars), sum(n_symbols), sum(n_upper), sum(n_digit),
            sum(n_mark)] as c
    from counts group by lang
), common as (
    select lang, word, count(*) as n, sum(count(*)) over (partition by lang) as total
    from spoken group by lang, word
    qualify n >= 0.001 * total
        and row_number() over (partition by lang order by n desc, word) <= 25
), lists as (
    select lang, list(word order by word) as words, any_value(total) as total,
           list(n order by word) as n
    from common group by lang
), refs as (
    select lang, list_transform(list_append(c, classes.n - list_sum(c)),
                                lambda x: x / classes.n) as class_shares,
           lists.words as common,
           list_transform(list_append(lists.n, total - list_sum(lists.n)),
                          lambda x: x / total) as word_shares
    from classes left join lists using (lang)
), found as (
    select s.doc_id, r.lang, list(s.n order by s.word) as n
    from (select t.doc_id, t.lang, w.word,
                 len(list_filter(t.words, lambda x: x = w.word)) as n
          from tokens t join (select lang, unnest(common) as word from refs) w using (lang)) s
    join refs r on r.lang = s.lang group by s.doc_id, r.lang
), marks as (
    select c.doc_id, c.n_words, c.word_chars, c.n_symbols,
           coalesce(l.n_dup_lines, 0) as n_dup_lines,
           coalesce(p.n_repeat_words, 0) as n_repeat_words,
           case when length(c.text) > 0 then {_distance(
               """list_transform([length(c.text) - c.word_chars, c.n_symbols, c.n_upper,
                  c.n_digit, c.n_mark, length(c.text) - (length(c.text) - c.word_chars
                  + c.n_symbols + c.n_upper + c.n_digit + c.n_mark)],
                  lambda x: x / length(c.text))""", "r.class_shares")} end as char_distance,
           case when c.n_words > 0 then {_distance(
               """list_transform(list_append(f.n, c.n_words - list_sum(f.n)),
                  lambda x: x / c.n_words)""", "r.word_shares")} end as word_distance
    from counts c left join lines l using (doc_id) left join repeats p using (doc_id)
    left join found f using (doc_id) join refs r on r.lang = c.lang
), failed as (
    select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed from marks
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and (n_words < 30
                            or (coalesce(char_distance <= 0.30, true)
                                and coalesce(word_distance <= 0.45, true))) as kept,
       round(char_distance, 6) as char_distance, round(word_distance, 6) as word_distance
from failed
"""

EXACT_DEDUP = """
with digests as (
    select doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                    'abcdefghijklmnopqrstuvwxyz')) as text_sha256
    from documents
)
select doc_id,
       max(doc_id) over same as keep_id,
       count(*) over same as group_size,
       doc_id = max(doc_id) over same as kept,
       text_sha256
from digests
window same as (partition by text_sha256)
"""

LINE_DEDUP = """
with lines as (
    select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
           unnest(range(len(string_split(coalesce(text, ''), chr(10))))) as place
    from documents
), keyed as (
    select *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
    from lines
), many as (
    select key, max(doc_id) as last from keyed
    where length(key) >= 20 group by key having count(distinct doc_id) >= 3
), decided as (
    select keyed.*, many.key is not null and doc_id <> last as gone
    from keyed left join many using (key)
)
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by place) filter (not gone), ''))
           as kept_sha256
from decided group by doc_id
"""

#: crc32 of a conversation's decimal id, by the checksum's own polynomial, bit by bit.
_CRC = """list_reduce(list_prepend(4294967295::bigint, flatten(list_transform(
    range(1, length(c::varchar) + 1),
    lambda i: [ascii(substr(c::varchar, i::int, 1))::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda a, b: case when b >= 0 then xor(a, b)
                      when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end)"""

PREFIX_TRIE = f"""
with turns as (
    select conv_id as c, turn, coalesce(role, '') as role, coalesce(text, '') as text,
           md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) as id
    from conversations where conv_id is not null
), convs as (
    select c, list({{'id': id, 'size': strlen(text)}}
                   order by turn nulls first, role, id) as t, xor({_CRC}, 4294967295) % 9 as h
    from turns group by c
), rebuilt as (
    select v.c, list_concat(coalesce(b.t[1:v.h], []), v.t[v.h + 1:]) as t
    from convs v left join convs b on b.c = v.c - v.c % 5
), paths as (
    select c, d, len(t) = d as ends, case when d > 0 then t[d].size else 0 end as size,
           sha256(array_to_string(list_transform(t[1:d], lambda x: x.id), ',')) as prefix
    from (select c, t, unnest(range(len(t) + 1)) as d from rebuilt)
), nodes as (
    select d, prefix, min(c) as c, count(*) as n, any_value(size) as size,
           sha256(coalesce(string_agg(c::varchar, ',' order by c) filter (ends), '')) as ends
    from paths group by d, prefix
), named as (
    select p.c as member, p.d, n.c, n.n, n.size, n.ends
    from paths p join nodes n on p.d = n.d and p.prefix = n.prefix
), parents as (
    select n.c, n.d, n.n, n.size, n.ends, a.c as parent
    from nodes n left join named a on a.member = n.c and a.d = n.d - 1
), children as (
    select parent as c, d - 1 as d, count(*) as children from parents where d > 0 group by all
), sums as (
    select a.c, a.d, sum((x.n - 1) * x.size) as saved,
           count(*) filter (k.children is null) as leaves
    from parents x left join children k on k.c = x.c and k.d = x.d
    join named a on a.member = x.c and a.d <= x.d
    group by all
)
select x.c as conv_id, x.d as depth, x.parent as parent_conv_id, x.n as n_convs,
       coalesce(k.children, 0) as n_children, s.leaves as n_leaves,
       s.saved::bigint as saved_tokens, x.ends as ends_sha256
from parents x left join children k on k.c = x.c and k.d = x.d
join sums s on s.c = x.c and s.d = x.d
"""

FILL_MIDDLE = """
with drawn as (
    select doc_id, coalesce(text, '') as text, sha256('1:' || coalesce(doc_id::varchar, '')) as hex
    from documents
), numbers as (
    select doc_id, text, length(text) as n,
           list_transform([1, 9, 17, 25],
                          lambda i: ('0x' || substr(hex, i, 8))::bigint) as h
    from drawn
), cuts as (
    select *, least(h[1] % (n + 1), h[2] % (n + 1)) as a,
           greatest(h[1] % (n + 1), h[2] % (n + 1)) as b,
           case when n = 0 or contains(text, '<P>') or contains(text, '<S>')
                     or contains(text, '<M>') or h[3] % 100 >= 90 then 'plain'
                when h[4] % 100 < 20 then 'spm' else 'psm' end as form
    from numbers
), parts as (
    select *, '<P>' || substr(text, 1, a) as prefix, '<M>' || substr(text, a + 1, b - a) as middle,
           '<S>' || substr(text, b + 1) as suffix
    from cuts
)
select doc_id, n, form, case when form <> 'plain' then a end as prefix_chars,
       case when form <> 'plain' then b - a end as middle_chars,
       sha256(case form when 'plain' then text when 'psm' then prefix || suffix || middle
              else suffix || prefix || middle end) as output_sha256,
       sha256(text) as restored_sha256
from parts
"""
