"""DuckDB SQL for the operators that SQL can express."""

SQL = {}

SQL["op1_exact_dedup"] = r"""
with t as (
  select doc_id, length(coalesce(text, '')) as n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) as text_sha256
  from documents),
k as (
  select text_sha256, first(doc_id order by n desc, doc_id nulls last) as keep_id, count(*) as group_size
  from t group by text_sha256)
select doc_id, keep_id, group_size, doc_id is not distinct from keep_id as kept, text_sha256
from t join k using (text_sha256)
"""

# escapes: backslash, then the two signs of control strings
_ESC = r"replace(replace(replace({0}, '\', '\b'), '<', '\l'), '#', '\h')"
_ROLE = r"replace(replace(" + _ESC + r", ':', '\c'), chr(10), '\n')"

SQL["op3_chat_format"] = r"""
with c as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
n as (
  select *, row_number() over w as i, lag(role) over w as before from c
  window w as (partition by conv_id order by turn nulls last, role, text)),
p as (
  select *, length(""" + _ESC.format("text") + r""") as body,
         case when before = role then length('<and>')
              else length('### ' || """ + _ROLE.format("role") + r""" || ': ')
                   + case when i > 1 then length('</turn>' || chr(10)) else 0 end end as lead
  from n)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by i)) as turns_sha256,
       cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
       sha256(coalesce(string_agg(text, '' order by i) filter (role = 'assistant'), '')) as loss_sha256,
       cast(sum(lead + body) + length('</turn>' || chr(10)) as bigint) as formatted_chars
from p group by conv_id
"""

SQL["op7_mixing"] = r"""
with recursive
t as (
  select doc_id, source as given, coalesce('s:' || source, 'null') as source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as n_tokens,
         cast('0x' || substr(md5(coalesce(cast(doc_id as varchar), '')), 1, 15) as bigint) as key
  from documents),
s as (
  select source, sum(n_tokens)::double as tokens from t group by source having sum(n_tokens) > 0),
p as (
  select source, tokens, tokens / sum(tokens) over () as p, ln(tokens / max(tokens) over ()) as x from s),
goal as (
  select h1 + 0.5 * (h0 - h1) as wanted from (
    select ln(sum(exp(x))) - sum(exp(x) * x) / sum(exp(x)) as h1, ln(count(*)) as h0 from p)),
bis(step, lo, hi) as (
  select 0, 0.0::double, 1.0::double
  union all
  select step + 1, case when good then lo else mid end, case when good then mid else hi end
  from (select step, lo, hi, (lo + hi) / 2 as mid,
               (select ln(sum(exp(a * x))) - sum(exp(a * x) * a * x) / sum(exp(a * x)) <= (select wanted from goal) + 1e-12
                       and max(exp(a * x) / p) / sum(exp(a * x)) <= 4.0
                from (select x, p, (lo + hi) / 2 as a from p)) as good
        from bis where step < 45)),
alpha as (select ceil(hi * 1e6 - 1e-3) / 1e6 as a from bis where step = 45),
w as (
  select source, tokens, exp(a * x) / sum(exp(a * x)) over () as weight,
         round(exp(a * x) * (sum(tokens) over () / sum(exp(a * x)) over ()), 3) as quota
  from p, alpha),
q as (
  select source, weight, tokens, floor(quota / tokens)::bigint as epochs,
         quota - floor(quota / tokens) * tokens as rest from w),
b as (
  select source, key >> 52 as block, sum(n_tokens) as tokens from t group by all),
r as (
  select b.source, block, b.tokens, rest, md5(b.source || ':' || block) as rank,
         coalesce(sum(b.tokens) over (partition by b.source order by md5(b.source || ':' || block)
                                      rows between unbounded preceding and 1 preceding), 0) as before
  from b join q using (source)),
e as (
  select source, block, rank as edge_rank, rest - before as room from r
  where before <= rest and before + tokens > rest),
i as (
  select t.source, key, room, sum(sum(n_tokens)) over (partition by t.source order by key) as through
  from t join e on t.source = e.source and t.key >> 52 = e.block group by t.source, key, room),
k as (select source, max(key) as edge_key from i where through <= room group by source)
select doc_id, given as source, n_tokens, round(coalesce(weight, 0.0), 9) as source_weight,
       case when epochs is null then 1
            else epochs + case when md5(t.source || ':' || (t.key >> 52)) < edge_rank
                                 or (md5(t.source || ':' || (t.key >> 52)) = edge_rank and t.key <= coalesce(edge_key, -1))
                          then 1 else 0 end end as copies
from t left join q using (source) left join e using (source) left join k using (source)
"""

SQL["op10_line_dedup"] = r"""
with l as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
  from documents),
k as (
  select doc_id, line, pos,
         translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from l),
c as (
  select key from k where length(key) >= 1 group by key having count(distinct doc_id) >= 10)
select doc_id, count(*) as n_lines, count(c.key) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (c.key is null), '')) as kept_sha256
from k left join c on k.key = c.key group by doc_id
"""

# a field of a leaf; crc32 by its eight shifts a byte
_FIELD = "coalesce(cast(octet_length(encode(cast({0} as varchar))) as varchar) || ':' || cast({0} as varchar), '-')"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars", "{0}")) + ")"
_CRC = """xor(4294967295, list_reduce([4294967295] || [ascii(c) for c in string_split(cast(doc_id as varchar), '')],
    lambda acc, b: list_reduce([xor(acc, b), 0, 0, 0, 0, 0, 0, 0, 0],
                               lambda c, z: xor(c >> 1, (c & 1) * 3988292384))))"""
_UP = """
  union all
  select {0}, i // 3, any_value((n + 2) // 3), sha256(string_agg(d, '' order by i)), level + 1
  from {1} where n > 1 group by {0}, level, i // 3)"""

SQL["op12_merkle"] = r"""
with recursive
l as (
  select row_number() over () as row, doc_id, source, """ + _LEAF.format("text") + r""" as leaf,
         case when """ + _CRC + r""" % 2 = 0 then """ + _LEAF.format("replace(text, chr(10), '')") + r"""
              else """ + _LEAF.format("text") + r""" end as received
  from documents),
p as (
  select *, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as pos,
         count(*) over (partition by source) as size from l),
t(source, i, n, d, level) as (
  select source, pos, size, leaf, 0 from p""" + _UP.format("source", "t") + r""",
s as (
  select source, d as subroot, row_number() over (order by source nulls first) - 1 as pos, count(*) over () as size
  from t where n = 1),
u(i, n, d, level) as (
  select pos, size, subroot, 0 from s""" + _UP.format("source", "u").replace("source, ", "") + r""",
r as (select d as root from u where n = 1),
f(row, source, i, n, folded, proof, level) as (
  select row, source, pos, size, received, '', 0 from p
  union all
  select f.row, f.source, f.i // 3, (f.n + 2) // 3,
         sha256(string_agg(case when x.i = f.i then f.folded else x.d end, '' order by x.i)),
         any_value(f.proof) || coalesce(string_agg(x.d, '' order by x.i) filter (x.i <> f.i), ''), f.level + 1
  from f join t x on x.source is not distinct from f.source and x.level = f.level and x.i // 3 = f.i // 3
  where f.n > 1 group by f.row, f.source, f.level, f.i, f.n),
g(row, i, n, folded, proof, level) as (
  select f.row, s.pos, s.size, f.folded, f.proof, 0
  from f join s on s.source is not distinct from f.source where f.n = 1
  union all
  select g.row, g.i // 3, (g.n + 2) // 3,
         sha256(string_agg(case when x.i = g.i then g.folded else x.d end, '' order by x.i)),
         any_value(g.proof) || coalesce(string_agg(x.d, '' order by x.i) filter (x.i <> g.i), ''), g.level + 1
  from g join u x on x.level = g.level and x.i // 3 = g.i // 3
  where g.n > 1 group by g.row, g.level, g.i, g.n)
select doc_id, leaf, subroot, root, sha256(proof) as proof_sha256, folded as folded_root, folded = root as verified
from p join g on g.row = p.row and g.n = 1
     join s on s.source is not distinct from p.source, r
"""
