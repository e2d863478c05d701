"""SQL (DuckDB) for the filter audit, the exact search and the conversation trie."""

OP11_SQL = r"""
with doc as (
  select row_number() over () as rid, doc_id, coalesce(source, '') as part, coalesce(text, '') as t
  from documents),
cut as (
  select rid, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws from doc),
copies as (select t, min(doc_id) as first_id from doc group by t),
known as (
  select doc_id, max(coalesce(quality = 1, false)::int) as good, max(coalesce(toxic = 1, false)::int) as toxic
  from labels group by 1),
judged as (
  select part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic,
    (case when len(ws) < 200 then 1 else 0 end)
    + (case when 100 * len(list_distinct(ws)) < 50 * len(ws) then 2 else 0 end)
    + (case when 100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 2 * length(t) then 4 else 0 end)
    + (case when regexp_matches(t, '[#$%&*|]') then 8 else 0 end)
    + (case when coalesce(doc_id > first_id, false) then 16 else 0 end) as f
  from doc join cut using (rid) join copies using (t) left join known using (doc_id)),
cell as (
  select part, f, count(*) as n, sum(good) as good, sum(toxic) as toxic from judged group by 1, 2),
letter as (
  select unnest(['A', 'B', 'C', 'D', 'E']) as x, unnest([1, 2, 4, 8, 16]) as m),
orders as (
  select a.x || b.x || c.x || d.x || e.x as filter_order, [a.m, b.m, c.m, d.m, e.m] as ms
  from letter a, letter b, letter c, letter d, letter e
  where (a.m | b.m | c.m | d.m | e.m) = 31),
steps as (
  select filter_order, k as step, ms[k] as own, coalesce(list_sum(ms[1:k - 1]), 0)::int as before_
  from orders, range(1, 6) r(k)),
counted as (
  select part, filter_order, step, own,
    sum(case when (f & (own | before_)) = 0 then n else 0 end) as kept,
    sum(case when (f & own) <> 0 and (f & before_) = 0 then n else 0 end) as removed,
    sum(case when (f & own) <> 0 and (f & before_) <> 0 then n else 0 end) as redundant,
    sum(case when f = own then n else 0 end) as unique_fails,
    sum(case when (f & own) <> 0 and (f & before_) = 0 then good else 0 end) as good_lost,
    sum(case when (f & own) <> 0 and (f & before_) = 0 then toxic else 0 end) as toxic_lost
  from steps, cell group by 1, 2, 3, 4)
select part, filter_order, step::int as step, kept::bigint as kept, removed::bigint as removed,
  redundant::bigint as redundant, unique_fails::bigint as unique_fails,
  good_lost::bigint as good_lost, toxic_lost::bigint as toxic_lost,
  (sum(removed) over (partition by part, own))::bigint as shapley
from counted
"""


OP12_SQL = r"""
with code as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
score as (
  select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint as score
  from code q join code c on len(q.v) = len(c.v) and c.vec_id is distinct from q.vec_id
  where q.vec_id % 50 = 0),
ranked as (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from score)
select query_id, rank::int as rank, vec_id, score from ranked where rank <= 5
"""

OP13_SQL = r"""
with crc_table as (
  select list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
    lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as tab),
own as (
  select conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')}
    order by turn nulls first, role, text) as s
  from conversations where conv_id is not null group by 1),
named as (
  select conv_id, s, conv_id - conv_id % 20 as base,
    xor(list_reduce(list_prepend(4294967295::bigint,
        list_transform(string_split(conv_id::varchar, ''), lambda x: ord(x)::bigint)),
      lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1])), 4294967295) % 4 as h
  from own, crc_table),
seq as (
  select n.conv_id, list_concat(coalesce(b.s[1:n.h], []), n.s[n.h + 1:]) as s
  from named n left join own b on n.base = b.conv_id),
member as (
  select conv_id, d as depth, len(s) as of_, s[1:d] as prefix, s[d].text as last_text
  from (select conv_id, s, unnest(range(0, len(s) + 1)) as d from seq)),
node as (
  select prefix, depth, min(conv_id) as conv_id, count(*) as n_convs, any_value(last_text) as last_text,
    sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where of_ = depth), '')) as ends
  from member group by 1, 2),
worth as (
  select *, (n_convs - 1) * len(list_filter(
    string_split_regex(coalesce(last_text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) as saves
  from node),
kids as (select prefix[1:depth - 1] as prefix, count(*) as n from node where depth > 0 group by 1),
upward as (
  select prefix[1:d] as prefix, saves, coalesce(k, 0) = 0 as leaf
  from (select w.prefix, w.saves, kids.n as k, unnest(range(0, w.depth + 1)) as d
        from worth w left join kids on kids.prefix = w.prefix)),
below as (
  select prefix, sum(saves) as saved_tokens, count(*) filter (where leaf) as n_leaves from upward group by 1)
select w.conv_id, w.depth::bigint as depth, p.conv_id as parent_conv_id, w.n_convs,
  coalesce(kids.n, 0) as n_children, b.n_leaves, b.saved_tokens::bigint as saved_tokens, w.ends as ends_sha256
from worth w join below b on b.prefix = w.prefix
  left join kids on kids.prefix = w.prefix
  left join node p on w.depth > 0 and p.prefix = w.prefix[1:w.depth - 1] and p.depth = w.depth - 1
"""
