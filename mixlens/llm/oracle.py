"""SQL counterparts of the queries that SQL can express, for another engine.

Op 3, 5, 6, 9, 13 and the pipeline estimate, draw, encode, learn or iterate;
op 10 needs an edit distance over code points, which that engine counts over bytes. Tests
compare those with brute force.
"""

from __future__ import annotations

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP1 = rf"""
with d as (
    select doc_id, source, len({WORDS})::bigint as size,
        ('0x' || substr(md5('mix:' || coalesce(doc_id::varchar, '') || ':' || coalesce(text, '')), 1, 9))::bigint as draw
    from documents),
s as (select source, sum(size)::bigint as source_size from d group by source),
w as (
    select *, 2.0::double * source_size as everything,
        ([5, 2, 1])[((row_number() over (order by source nulls last) - 1) % 3 + 1)::int]::double as weight from s),
l as (
    select *, ((sum(source_size) over ())::double * 1.5::double
        - coalesce(sum(everything) over (order by source_size::double / weight, source nulls last
            rows between unbounded preceding and 1 preceding), 0))
        / sum(weight) over (order by source_size::double / weight, source nulls last
            rows between current row and unbounded following) as level from w),
c as (select *, level * weight >= everything as capped from l),
f as (
    select *, max(level) filter (where not capped) over () as shared from c),
t as (select *, case when capped then everything else shared * weight end as target from f),
p as (
    select source, source_size, target,
        case when source_size > 0 then floor(target / source_size) else 0 end as passes from t),
r as (select *, target - passes * source_size as rest from p),
sums as (select source, draw, sum(size)::double as words from d group by source, draw),
runs as (select *, sum(words) over (partition by source order by draw) as upto from sums),
ends as (
    select r.source, min(draw) as draw from runs join r on runs.source is not distinct from r.source
    where r.rest > 0 and upto >= r.rest group by r.source),
cuts as (
    select e.source, case when 2 * (r.rest - (runs.upto - runs.words)) >= runs.words then e.draw + 1 else e.draw end as below
    from ends e join runs on runs.source is not distinct from e.source and runs.draw = e.draw
        join r on r.source is not distinct from e.source)
select d.doc_id, d.size, r.source_size, r.target,
    (d.size * (r.passes + case when d.draw < coalesce(cuts.below, 0) then 1 else 0 end))::bigint as taken
from d join r on d.source is not distinct from r.source left join cuts on d.source is not distinct from cuts.source
"""

OP2 = r"""
with turns as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all values (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
marked as (
    select *, lag(role) over w as before, row_number() over w - 1 as pos, lead(role) over w is null as ends,
        length(regexp_replace(text,
            '([<\[])(\\*)(SYS\]|/SYS\]|INST\]|/INST\]|s>|/s>|ROLE\]|/TURN\]|TEXT\])', '\1\\\2\3', 'g'))
        + case role when 'system' then 11 when 'user' then 13 when 'assistant' then 7 else 19 + length(regexp_replace(role,
            '([<\[])(\\*)(SYS\]|/SYS\]|INST\]|/INST\]|s>|/s>|ROLE\]|/TURN\]|TEXT\])', '\1\\\2\3', 'g')) end as chars
    from turns window w as (partition by conv_id order by turn nulls first, role, text)),
judged as (
    select *, case when (before is null and role in ('system', 'user')) or (before in ('system', 'assistant') and role = 'user')
        or (before = 'user' and role = 'assistant') then null else pos end as fault from marked)
select conv_id, count(*) as n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' order by pos)) as turns_sha256,
    coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
    sha256(coalesce(string_agg(text, '' order by pos) filter (where role = 'assistant'), '')) as loss_sha256,
    sum(chars)::bigint as formatted_chars,
    coalesce(min(fault), max(case when ends and role <> 'assistant' then pos + 1 end))::int as first_fault
from judged group by conv_id
"""

OP4 = rf"""
with d as (select doc_id, {WORDS} as words from documents),
p as (select doc_id, words, unnest(range(1, len(words) - 11)) as i from d),
k as (select doc_id, i, array_to_string(words[i:i + 12], ' ') as passage from p),
o as (select passage, min(doc_id) as least from k group by passage),
c as (select distinct doc_id, unnest(range(i, i + 13)) as pos from k join o using (passage) where doc_id > least),
w as (select doc_id, unnest(words) as word, generate_subscripts(words, 1) as pos from d),
j as (select w.*, c.pos is null as kept from w left join c on w.doc_id = c.doc_id and w.pos = c.pos),
s as (
    select doc_id, count(*) filter (where not kept) as n_removed, string_agg(word, ' ' order by pos) filter (where kept) as text
    from j group by doc_id)
select d.doc_id, len(words)::bigint as n_words, coalesce(n_removed, 0)::bigint as n_removed,
    sha256(coalesce(s.text, '')) as kept_sha256
from d left join s using (doc_id)
"""


def _descent(regions: int, name: str) -> str:
    """SQL that walks the tree of op 7; the fifth region, if any, has a rack and a shard of its own."""

    def unit(child: str) -> str:
        return f"((('0x' || substr(md5(key || '|' || {child}), 1, 12))::bigint + 0.5) / 281474976710656.0::double)"

    return f"""
{name}_r as (
    select key, arg_min(r, -ln({unit("'region' || r")}) / (case when r < 4 then 4.0 else 1.0 end)::double) as region
    from (select distinct key from d), (select unnest(range({regions})) as r) group by key),
{name}_k as (
    select key, arg_min(k, -ln({unit("'rack' || k")}) / 2.0::double) as rack
    from {name}_r, (select unnest(range(9)) as k) where k // 2 = region group by key),
{name} as (
    select key, arg_min(s, -ln({unit("'shard' || s")}) / 1.0::double)::int as {name}
    from {name}_k, (select unnest(range(17)) as s) where s // 2 = rack group by key)"""


#: The 256 steps of CRC-32, as a list in a table of one row.
STEPS = """
steps as (
    select list_transform(range(256), lambda x: list_reduce(list_concat([x::bigint], [0, 0, 0, 0, 0, 0, 0, 0]),
        lambda c, z: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as t)"""

OP7 = f"""
with {STEPS},
d as (
    select doc_id, coalesce(doc_id::varchar, 'null') as key, octet_length(encode(coalesce(text, ''))) + 1 as size,
        xor(list_reduce(list_concat([4294967295::bigint], list_transform(range(octet_length(encode(coalesce(text, '')))),
            lambda i: ('0x' || substr(hex(encode(coalesce(text, ''))), 2 * i + 1, 2))::bigint)),
            lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) as text_crc32
    from documents, steps),
{_descent(4, "shard")},
{_descent(5, "grown_shard")},
p as (
    select doc_id, size::bigint as size, text_crc32, 'key' as law, shard, grown_shard
    from d join shard using (key) join grown_shard using (key))
select *, row_number() over (partition by shard order by
    substr(md5(concat_ws('|', doc_id, size, text_crc32, grown_shard, law)), 1, 3),
    doc_id nulls first, size, text_crc32, grown_shard, law) - 1 as slot
from p
"""

OP8 = r"""
with i as (
    select item_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') as w from benchmark),
d as (select doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') as w from documents),
si as (select distinct item_id, array_to_string(w[k:k + 4], ' ') as s from (select *, unnest(range(1, len(w) - 3)) as k from i)),
sd as (select distinct doc_id, array_to_string(w[k:k + 4], ' ') as s from (select *, unnest(range(1, len(w) - 3)) as k from d)),
n as (select item_id, count(*) as size from si group by item_id)
select doc_id, item_id, count(*) as shared, any_value(size) as size
from si join sd using (s) join n using (item_id) group by doc_id, item_id having count(*) >= 0.8 * any_value(size) - 1e-9
"""

OP11 = """
with v as (
    select row_number() over () as id, vec_id, [floor(64 * c::double) for c in embedding] as x from embeddings
    where embedding is not null and len([1 for c in embedding if c is not null and isfinite(c)]) = len(embedding)),
p as (
    select q.id, q.vec_id as query_id, v.vec_id, list_dot_product(q.x, v.x)::bigint as score
    from v q join v on q.id <> v.id where q.vec_id % 20 = 0),
r as (select *, row_number() over (partition by id order by score desc, vec_id nulls last) as place from p)
select query_id, place::int as rank, vec_id, score from r where place <= 20
"""


def _field(value: str) -> str:
    return f"coalesce(strlen(({value})::varchar) || ':' || ({value})::varchar, '-')"


def _tree(name: str, leaves: str) -> str:
    """SQL for all nodes of trees over leaves (g, n, pos, h), from the leaves up."""
    return f"""
{name} as (
    select g, n, 0 as lv, pos, h from {leaves}
    union all
    select g, n, lv + 1, pos // 2, sha256(string_agg(h, '' order by pos)) from {name} where n > (1::bigint << lv) group by g, n, lv, pos // 2)"""


def _leaf(n_chars: str) -> str:
    return f"sha256({' || '.join(_field(c) for c in ('doc_id', 'source', 'lang', n_chars, 'text'))})"


OP12 = f"""
with recursive {STEPS},
d as (
    select row_number() over () as id, doc_id, lang, {_leaf('n_chars')} as leaf, {_leaf('n_chars::hugeint + 1')} as tampered,
        xor(list_reduce(list_concat([4294967295::bigint], [ord(c)::bigint for c in string_split(doc_id::varchar, '')]),
            lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 7 = 0 as chosen
    from documents, steps),
langs as (select lang, count(*) as n, row_number() over (order by lang nulls first) - 1 as g from d group by lang),
leaves as (
    select id, doc_id, g, n, row_number() over (partition by g order by doc_id nulls first, leaf) - 1 as pos, leaf as h,
        case when chosen then tampered else leaf end as claimed
    from d join langs on d.lang is not distinct from langs.lang),
{_tree("nodes", "leaves")},
subroots as (select 0 as g, count(*) over () as n, g as pos, h from nodes where pos = 0 and n <= (1::bigint << lv)),
{_tree("tops", "subroots")},
roots as (select h as root from tops where pos = 0 and n <= (1::bigint << lv)),
steps_up as (
    select l.id, 0 as stage, x.lv, s.h as sibling, (l.pos >> x.lv) & 1 = 1 as is_left
    from leaves l, (select unnest(range(40)) as lv) x
        left join nodes s on s.g = l.g and s.lv = x.lv and s.pos = xor(l.pos >> x.lv, 1)
    where l.n > (1::bigint << x.lv)
    union all
    select l.id, 1, x.lv, s.h, (l.g >> x.lv) & 1 = 1
    from leaves l join (select max(n) as groups from subroots) on true, (select unnest(range(40)) as lv) x
        left join tops s on s.lv = x.lv and s.pos = xor(l.g >> x.lv, 1)
    where groups > (1::bigint << x.lv)),
path as (select *, row_number() over (partition by id order by stage, lv) as step from steps_up),
folded as (
    select id, 0::bigint as step, claimed as node from leaves
    union all
    select f.id, f.step + 1, sha256(case when is_left then coalesce(sibling, '') || node else node || coalesce(sibling, '') end)
    from folded f join path p on p.id = f.id and p.step = f.step + 1),
ends as (select id, arg_max(node, step) as folded_root from folded group by id),
proofs as (select id, string_agg(sibling, '' order by step) as siblings from path group by id)
select doc_id, l.h as leaf, s.h as subroot, root, sha256(coalesce(siblings, '')) as proof_sha256, folded_root,
    folded_root = root as verified
from leaves l join subroots s on s.pos = l.g join ends using (id) left join proofs using (id), roots
"""

ORACLE_SQL: dict[str, str] = {
    "op1_mix_sources": OP1,
    "op2_format_chats": OP2,
    "op4_substring_dedup": OP4,
    "op7_shard": OP7,
    "op8_decontaminate": OP8,
    "op11_top_products": OP11,
    "op12_merkle_manifest": OP12,
}
