"""SQL twins of the queries that SQL can express."""

from __future__ import annotations

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWERED = f"translate(text, '{_UPPER}', '{_UPPER.lower()}')"


def _words(pattern: str) -> str:
    return f"coalesce(regexp_extract_all({_LOWERED}, '{pattern}'), [])"


_PLAIN = _words(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_BLANK = _words(r"[^\x20\x09-\x0D]+")


def _crc32(text: str) -> str:
    """CRC-32 of a text of ASCII characters: a byte is mixed in, then eight shifts follow."""
    steps = f"flatten(list_transform(str_split({text}, ''), lambda c: [cast(ord(c) as bigint), 0, 0, 0, 0, 0, 0, 0]))"
    turn = "xor(xor(a, x) >> 1, 3988292384 * (xor(a, x) & 1))"
    return f"xor(list_reduce(list_concat([cast(4294967295 as bigint)], {steps}), lambda a, x: {turn}), 4294967295)"


def _lloyd(rounds: int) -> str:
    """Codebooks ``book0`` to ``book<rounds>`` and the assignments ``near0`` to ``near<rounds>``."""
    found = []
    for i in range(rounds + 1):
        found.append(f"""
near{i} as (
  select r, part, x, min_by(entry, (d, entry)) as entry, min(d) as d
  from (select v.r, v.part, v.x, b.entry,
               cast(list_dot_product(v.x, v.x) - 2 * list_dot_product(v.x, b.c) + list_dot_product(b.c, b.c) as bigint) as d
        from parts v join book{i} b using (part))
  group by r, part, x)""")
        if i < rounds:
            found.append(f"""
mean{i} as (
  select part, entry, list(m order by k) as c
  from (select part, entry, k, floor(sum(x[k]) / count(*)) as m
        from near{i}, generate_series(1, len(x)) as s(k) group by part, entry, k)
  group by part, entry),
book{i + 1} as (select part, entry, coalesce(m.c, b.c) as c from book{i} b left join mean{i} m using (part, entry))""")
    return ",".join(found)


def twins() -> dict[str, str]:
    return {
        "op2_benchmark_index": f"""
with d as (select row_number() over () as r, doc_id, {_PLAIN} as w from documents),
i as (select item_id, {_PLAIN} as w from benchmark),
starts as (select item_id, w, unnest(generate_series(1, greatest(1, len(w) - 12))) as k from i where len(w) > 0),
win as (select distinct item_id, list_slice(w, k, k + 12) as win from starts),
sizes as (select distinct len(win) as n from win),
places as (select r, w, n, unnest(generate_series(1, len(w) - n + 1)) as k from d, sizes where len(w) >= n),
found as (select r, k, n, item_id from places join win on list_slice(w, k, k + n - 1) = win),
hit as (select r, count(distinct p) as n_hit
        from (select r, unnest(generate_series(k, k + n - 1)) as p from found) group by r),
items as (select r, count(*) as n_items, string_agg(item, ',' order by item) as names
          from (select distinct r, cast(item_id as varchar) as item from found) group by r)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(names, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from d left join hit using (r) left join items using (r)""",
        "op7_impact_search": """
with v as (
  select row_number() over () as r, vec_id,
         list_transform(embedding, lambda x: floor(1024 * cast(x as double))) as q
  from embeddings
  where embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select a.vec_id as query_id, a.r as query_row, b.vec_id, b.r,
         cast(list_dot_product(a.q, b.q) as bigint) as score
  from v a join v b on a.r <> b.r where a.vec_id % 100 = 0),
ranked as (
  select query_id, vec_id, score,
         row_number() over (partition by query_id, query_row order by score desc, vec_id, r) as rank
  from scored)
select query_id, cast(rank as integer) as rank, vec_id, score from ranked where rank <= 10""",
        "op10_shingle_join": f"""
with recursive d as (select row_number() over () as r, doc_id, {_BLANK} as w from documents),
s as (select distinct r, g from (
        select r, list_slice(w, k, k + 2) as g
        from (select r, w, unnest(generate_series(1, greatest(1, len(w) - 2))) as k from d where len(w) > 0))),
n as (select r, count(*) as n from s group by r),
links as (
  select a.r as a, b.r as b
  from s a join s b on a.g = b.g and a.r <> b.r
  join n na on na.r = a.r join n nb on nb.r = b.r
  group by a.r, b.r, na.n, nb.n
  having 100 * count(*) >= 90 * (na.n + nb.n - count(*))),
reach as (select r as a, r as b from d union select reach.a, links.b from reach join links on reach.b = links.a)
select d.doc_id, coalesce(max(n.n), 0) as n_shingles, min(o.doc_id) as component_id
from d left join n using (r) join reach on reach.a = d.r join d o on o.r = reach.b
group by d.r, d.doc_id""",
        # The pages of the test tables mark their article, so that SQL can cut it out.
        "op11_main_text": r"""
with a as (select row_number() over () as r, page_id, url, regexp_extract(html, '<article>(.*?)</article>', 1, 's') as a
           from pages),
blocks as (select r, unnest(string_split_regex(a, '</?(?:p|h1)>')) as b, unnest(generate_series(1, 1 + len(a))) as k
           from a),
plain as (
  select r, k, replace(replace(replace(replace(replace(regexp_replace(b, '<[^>]*>', ' ', 'g'),
                       '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#x27;', chr(39)), '&amp;', '&') as b
  from blocks where b is not null),
texts as (
  select r, string_agg(t, chr(10) order by k) as text
  from (select r, k, trim(regexp_replace(b, '[\x20\x09-\x0D]+', ' ', 'g')) as t from plain) where t <> '' group by r)
select page_id, url, coalesce(text, '') as text, cast(length(coalesce(text, '')) as bigint) as n_chars
from a left join texts using (r)""",
        "op12_vector_codes": f"""
with recursive v as (
  select row_number() over (order by vec_id) as r, vec_id, label,
         list_transform(embedding, lambda x: floor(1024 * cast(x as double))) as q
  from embeddings
  where embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
parts as (
  select r, part, list_slice(q, part * (len(q) // 4) + 1, (part + 1) * (len(q) // 4)) as x
  from v, generate_series(0, 3) as s(part)),
book0 as (select part, r - 1 as entry, x as c from parts where r <= 256),{_lloyd(4)},
coded as (
  select r, string_agg(lpad(to_hex(entry), 2, '0'), '' order by part) as code, cast(sum(d) as bigint) as error
  from near4 group by r),
digest as (
  select sha256(string_agg(array_to_string(list_transform(c, lambda x: cast(cast(x as bigint) as varchar)), ','), ','
                           order by part, entry)) as codebooks_sha256
  from book4)
select vec_id, lower(code) as code, error, cast(sum(error) over (partition by label) as bigint) as label_error,
       codebooks_sha256
from v join coded using (r), digest""",
        "op13_periodic_runs": f"""
with plain as (
  select row_number() over () as r, doc_id, coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) as w,
         {_crc32("cast(doc_id as varchar)")} as h
  from documents),
sized as (select *, len(w) as n, h // 10 as g, if(len(w) > 0, (h // 10) % len(w), 0) as a from plain),
d as (
  select r, doc_id,
         if(h % 10 = 0 and n > 0,
            list_transform(generate_series(0, n - 1),
                           lambda i: w[1 + if(i < a, i, a + (i - a) % (1 + (n - a) // (3 + g % 8)))]),
            w) as w
  from sized),
grams as (
  select r, i, array_to_string(list_slice(w, i + 1, i + 3), ' ') as gram
  from (select r, w, unnest(generate_series(0, len(w) - 3)) as i from d where len(w) >= 6)),
twice as (select a.r, a.i, b.i - a.i as q from grams a join grams b on a.r = b.r and a.gram = b.gram and a.i < b.i),
islands as (
  select r, q, min(i) as start, count(*) + 2 + q as length
  from (select *, i - row_number() over (partition by r, q order by i) as island from twice)
  group by r, q, island),
runs as (
  select r, start, length, min(q) as period
  from islands where length >= greatest(6, 4 * q) group by r, start, length),
best as (
  select r, count(*) as n_runs,
         arg_min((start, length, period), (-length, start, period)) as b,
         string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period) as lines
  from runs group by r),
gone as (select distinct r, unnest(generate_series(start + period, start + length - 1)) as i from runs),
words as (select r, unnest(w) as word, unnest(generate_series(0, len(w) - 1)) as i from d where len(w) > 0),
kept as (
  select r, string_agg(word, ' ' order by i) as text
  from words anti join gone using (r, i) group by r)
select doc_id, coalesce(n_runs, 0) as n_runs, b[1] as start, b[2] as length, b[3] as period,
       1000 * b[2] // b[3] as exponent_milli,
       sha256(coalesce(lines, '')) as runs_sha256, sha256(coalesce(kept.text, '')) as collapsed_sha256
from d left join best using (r) left join kept using (r)""",
    }
