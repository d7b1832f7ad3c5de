"""The same results as DuckDB SQL, for the operators that SQL can express."""

from __future__ import annotations

LLM_SQL: dict[str, str] = {}

LLM_SQL["op1_line_dedup"] = """
with docs as (select row_number() over () as r, doc_id, coalesce(doc_id, -9223372036854775808) as own, string_split(coalesce(text, ''), chr(10)) as lines from documents),
split as (select r, doc_id, own, unnest(lines) as line, generate_subscripts(lines, 1) as i from docs),
keyed as (select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from split),
often as (select key, max(own) as keeper from keyed where length(key) >= 40 group by key having count(distinct own) >= 5),
marked as (select k.r, k.doc_id, k.i, k.line, o.key is not null and k.own <> o.keeper as gone from keyed k left join often o using (key))
select any_value(doc_id) as doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by i) filter (not gone), '')) as kept_sha256
from marked group by r"""


def base32(sha1: str) -> str:
    """SHA-1 in hexadecimal as base 32: the number's 5-bit groups."""
    groups = ", ".join(f"('0x' || substr({sha1}, {1 + 5 * i}, 5))::bigint" for i in range(8))
    digits = " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((x >> {s}) & 31)::int, 1)" for s in (15, 10, 5, 0))
    return f"array_to_string(list_transform([{groups}], lambda x: {digits}), '')"


LLM_SQL["op5_warc"] = f"""
with p as (select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as hex from pages),
f as (select *, min(page_id) over (partition by html) as first from p)
select page_id, strlen(html)::bigint as payload_bytes, {base32("hex")} as payload_digest,
  case when page_id is distinct from first and first is not null then 'revisit' else 'response' end as record_type,
  case when page_id is distinct from first then first end as refers_to
from f"""


LLM_SQL["op6_top_k"] = """
with v as (select row_number() over () as i, vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)) as e from embeddings
  where vec_id is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.i, q.vec_id as query_id, c.vec_id, list_dot_product(q.e, c.e)::bigint as score
  from v q join v c on q.vec_id % 100 = 0 and q.vec_id <> c.vec_id and len(q.e) = len(c.e)),
r as (select *, row_number() over (partition by i order by score desc, vec_id)::int as rank from s)
select query_id, rank, vec_id, score from r where rank <= 10"""


LLM_SQL["op4_near_vectors"] = """
with recursive v as (select row_number() over () as i, vec_id, label, list_transform(embedding, lambda x: x::double) as raw from embeddings),
ok as (select i, vec_id, label, list_transform(raw, lambda x: coalesce(x, 0)) as e from v
  where vec_id is not null and label is not null and len(raw) > 0 and len(list_filter(raw, lambda x: x is null or not isfinite(x))) = 0
  and len(list_filter(raw, lambda x: x <> 0)) > 0),
link as (select a.i as a, b.i as b from ok a join ok b on a.label = b.label and a.i <> b.i and len(a.e) = len(b.e)
  and list_cosine_similarity(a.e, b.e) >= 0.98),
reach(i, j) as (select i, i from ok union select l.b, r.j from reach r join link l on l.a = r.i),
root as (select r.i, min(v.vec_id) as component_id from reach r join v on v.i = r.j group by r.i),
n as (select a, count(*) as n_links from link group by a)
select v.vec_id, coalesce(n.n_links, 0)::bigint as n_links, coalesce(root.component_id, v.vec_id) as component_id,
  v.vec_id = coalesce(root.component_id, v.vec_id) as kept
from v left join n on n.a = v.i left join root on root.i = v.i"""

LLM_SQL["op10_ngram_join"] = r"""
with recursive w as (select row_number() over () as i, doc_id, regexp_extract_all(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
s as (select i, doc_id, list_distinct(case when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k:k+4], ' '))
  when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as s from w),
e as (select i, len(s) as n, unnest(s) as g from s),
often as (select g from e group by g having count(*) > 1),
few as (select e.* from e join often using (g)),
link as (select a.i as a, b.i as b from few a join few b on a.g = b.g and a.i <> b.i
  group by a.i, b.i having 100 * count(*) >= 75 * (any_value(a.n) + any_value(b.n) - count(*))),
reach(i, j) as (select i, i from s union select l.b, r.j from reach r join link l on l.a = r.i)
select s.doc_id, len(s.s)::bigint as n_shingles, m.component_id
from s join (select r.i, min(s.doc_id) as component_id from reach r join s on s.i = r.j group by r.i) m on m.i = s.i"""

TERMS_SQL = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9A-Za-z\x{80}-\x{10FFFF}]+')"""

LLM_SQL["op13_lexical_search"] = f"""
with d as (select row_number() over () as i, doc_id, len(w)::hugeint as n, w from (select doc_id, {TERMS_SQL} as w from documents) where len(w) > 0),
c as (select count(*) as docs, sum(n) as terms from d),
q as (select row_number() over () as j, item_id, {TERMS_SQL} as w from benchmark),
asked as (select j, item_id, term, count(*) as times from (select j, item_id, unnest(w) as term from q) group by all),
held as (select i, doc_id, n, term, count(*) as tf from (select i, doc_id, n, unnest(w) as term from d) where term in (select term from asked) group by all),
weight as (select term, floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1)::double))::bigint as w from held, c group by term, docs),
impact as (select i, doc_id, term, ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms)))::bigint as x from held, c),
s as (select j, item_id, i, doc_id, sum(times * w * x)::bigint as score from asked join weight using (term) join impact using (term) group by all),
r as (select item_id, doc_id, score, row_number() over (partition by j order by score desc, doc_id nulls first)::int as rank from s where score > 0)
select item_id, rank, doc_id, score from r where rank <= 10"""

# Windows are compared as hexadecimal text; long texts are cut into blocks first, so that no substring is far from its text's start.
LLM_SQL["op12_suffix_dedup"] = """
with d as (select row_number() over () as i, doc_id, hex(encode(coalesce(text, ''))) as h from documents),
b as (select i, k, substr(h, 512 * k + 1, 512 + 798) as h from (select i, h, unnest(range((length(h) + 511) // 512)) as k from d)),
w as (select i, 256 * k + j as p, md5_number(substr(h, 2 * j + 1, 800)) as g
  from (select i, k, h, unnest(range(least(256, length(h) // 2 - 399))) as j from b where length(h) >= 800)),
often as (select g from w group by g having count(*) > 1),
hit as (select i, p, max(p) over (partition by i order by p rows between unbounded preceding and 1 preceding) as before from w where g in (select g from often)),
part as (select i, p, sum((before is null or p > before + 400)::int) over (partition by i order by p) as run from hit),
gone as (select i, min(p) as lo, max(p) + 400 as hi from part group by i, run),
keep as (select i, coalesce(lag(hi) over (partition by i order by lo), 0) as a, lo as z from gone
  union all select d.i, max(hi), any_value(length(h) // 2) from d join gone on gone.i = d.i group by d.i),
kept as (select keep.i, string_agg(substr(h, 2 * a + 1, 2 * (z - a)), '' order by a) as h from keep join d on d.i = keep.i group by keep.i),
n as (select i, sum(hi - lo)::bigint as n_removed, count(*) as n_spans from gone group by i)
select doc_id, (length(d.h) // 2)::bigint as n_bytes, coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_spans, 0)::bigint as n_spans,
  sha256(unhex(coalesce(kept.h, d.h))) as kept_sha256
from d left join n on n.i = d.i left join kept on kept.i = d.i"""


def edit_moves() -> str:
    """What can happen up to and with one turn, as VALUES: the last initial before and after, turns inserted first, the edit, its cost."""
    after, names = {"": "us", "s": "u", "u": "a", "a": "u"}, {"u": "user", "a": "assistant"}
    rows = []
    for state in after:
        inserted, at = "", state
        for n in range(3):
            lines = "[" + ", ".join(f"'{names[x]}:'" for x in inserted) + "]::varchar[]"
            rows.append(f"('{state}', '{at}', {lines}, '{'I' * n}', '', '', {2 * n})")
            rows.append(f"('{state}', '{at}', {lines}, '{'I' * n}D', '', '', {2 * n + 3})")
            for y in after[at]:
                rows.append(f"('{state}', '{y}', {lines}, '{'I' * n}K', '{y}', '', {2 * n})")
                if y in names:
                    rows.append(f"('{state}', '{y}', {lines}, '{'I' * n}R', '{y}', '{names[y]}', {2 * n + 2})")
            at = next(x for x in after[at] if x in names)
            inserted += at
    return f"(values {', '.join(rows)}) as v(s, s2, ins, step, initial, name, cost)"


# An automaton over (turn, last initial) instead of targets and bands. CRC-32 is its bitwise definition, table and all.
LLM_SQL["op11_conversation_repair"] = f"""
with recursive bits as (select list(list_reduce([i::bigint, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, x: case when c & 1 = 1 then xor(3988292384::bigint, c >> 1) else c >> 1 end) order by i) as t from range(256) as r(i)),
k as (select *, list_transform(string_split(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '), ''), lambda c: unicode(c)::bigint) as codes from conversations),
h as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
  xor(list_reduce(list_prepend(4294967295::bigint, codes), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295::bigint) % 20 as kind from k, bits),
w as (select ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) as white),
d as (select conv_id, turn, case when kind = 4 then 'user' else role end as role, case kind when 1 then '' when 2 then translate(text, '.!?', '') else text end as text
  from h, unnest(range(case kind when 0 then 0 when 3 then 2 else 1 end))),
o as (select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as i, rtrim(text, white) as body from d, w),
f as (select *, left(role, 1) as initial, case when body = '' then 'blank' when row_number() over (partition by conv_id, role, text order by i) > 1 then 'duplicate'
  when right(body, 1) not in ('.', '!', '?') then 'truncated' else '' end as fault,
  left(lag(role) over (partition by conv_id order by i), 1) || left(role, 1) as two, lag(i) over (partition by conv_id order by i) as before from o),
m as (select * from {edit_moves()}),
dp as (
  select conv_id, 0::bigint as i, '' as s, {{'c': 0::bigint, 'a': '', 't': []::varchar[]}} as b from f where i = 1
  union all
  select p.conv_id, f.i, m.s2, min({{'c': p.b.c + m.cost + case when fault = 'truncated' and m.step not like '%D' then 1 else 0 end, 'a': p.b.a || m.step,
    't': p.b.t || m.ins || case right(m.step, 1) when 'D' then []::varchar[] when 'K' then [f.role || ':' || f.text] else [m.name || ':' || f.text] end}})
  from dp p join f on f.conv_id is not distinct from p.conv_id and f.i = p.i + 1 join m on m.s = p.s
  where m.step like '%D' or fault not in ('blank', 'duplicate') and (m.step like '%K' and m.initial = f.initial or m.step like '%R' and m.initial <> f.initial)
  group by p.conv_id, f.i, m.s2),
n as (select conv_id, count(*) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (fault = 'blank') as blank,
  count(*) filter (fault = 'duplicate') as duplicate, count(*) filter (fault = 'truncated') as truncated,
  count(*) filter (before is not null and two not in ('su', 'ua', 'au')) as illegal from f group by conv_id),
best as (select p.conv_id, min({{'c': p.b.c + m.cost, 'a': p.b.a || m.step, 't': p.b.t || m.ins}}) as b
  from dp p join n on n.conv_id is not distinct from p.conv_id and n.n = p.i join m on m.s = p.s
  where m.initial = '' and m.step not like '%D' and m.s2 in ('', 'a') group by p.conv_id)
select c.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate, coalesce(truncated, 0)::bigint as truncated,
  coalesce(illegal, 0)::bigint as illegal, coalesce(best.b.c, 0)::bigint as cost, coalesce(best.b.a, '') as audit,
  sha256(coalesce(array_to_string(best.b.t, chr(10)), '')) as repaired_sha256
from (select distinct conv_id from conversations) c left join n on n.conv_id is not distinct from c.conv_id left join best on best.conv_id is not distinct from c.conv_id"""
