"""DuckDB SQL for the queries that SQL can express."""

LINE_DEDUP = r"""
with split as (
  select doc_id, str_split(coalesce(text, ''), chr(10)) as ls from documents
), lines as (
  select doc_id, unnest(ls) as line, unnest(range(len(ls))) as pos from split
), keyed as (
  select doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from lines
), shared as (
  select key, min(doc_id) as first_doc from keyed where length(key) >= 10
  group by key having count(distinct doc_id) >= 2
), marked as (
  select k.doc_id, k.pos, k.line, (s.key is not null and k.doc_id <> s.first_doc) as gone
  from keyed k left join shared s on k.key = s.key
)
select doc_id, count(*) as n_lines, cast(sum(case when gone then 1 else 0 end) as bigint) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) as kept_sha256
from marked group by doc_id
"""

DECONTAMINATION = r"""
with d as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[0-9a-z\x{80}-\x{10FFFF}]+') as w from documents
), b as (
  select item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[0-9a-z\x{80}-\x{10FFFF}]+') as w from benchmark where item_id is not null
), starts as (
  select item_id, w, least(10, len(w)) as k, unnest(range(1, greatest(1, len(w) - 9) + 1)) as i from b where len(w) > 0
), windows as (
  select distinct item_id, k, array_to_string(w[i : i + k - 1], ' ') as s from starts
), sizes as (
  select distinct k from windows
), places as (
  select doc_id, w, k, unnest(range(1, len(w) - k + 2)) as i from d, sizes where len(w) >= k
), spots as (
  select doc_id, i, k, array_to_string(w[i : i + k - 1], ' ') as s from places
), hits as (
  select p.doc_id, p.i, p.k, x.item_id from spots p join windows x on p.k = x.k and p.s = x.s
), words as (
  select doc_id, count(distinct j) as n_hit from (select doc_id, unnest(range(i, i + k)) as j from hits) group by doc_id
), items as (
  select doc_id, count(*) as n_items, string_agg(s, ',' order by s) as ids
  from (select distinct doc_id, cast(item_id as varchar) as s from hits) group by doc_id
)
select d.doc_id, cast(len(d.w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join words using (doc_id) left join items using (doc_id)
"""

CHAT = r"""
with turns as (
  select conv_id, turn, role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'
)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn)) as turns_sha256,
       cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint) as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn) filter (where role = 'assistant'), '')) as loss_sha256,
       cast(sum(length('### ' || role || ': ' || '</turn>' || chr(10)) + length(text)
         + length(regexp_replace(text, '[^\\#<]', '', 'g'))) as bigint) as formatted_chars
from turns group by conv_id
"""

TOP_K = r"""
with v as (
  select distinct vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as e
  from embeddings
  where vec_id is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding)
), scored as (
  select q.vec_id as query_id, c.vec_id,
         max(cast(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])) as bigint)) as score
  from v q join v c on q.vec_id <> c.vec_id and len(q.e) = len(c.e)
  where q.vec_id % 50 = 0 group by all
), ranked as (
  select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank,
         vec_id, score from scored
)
select * from ranked where rank <= 5
"""

JACCARD = r"""
with recursive d as (
  select doc_id, list_filter(str_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
    lambda x: x <> '') as w from documents
), places as (
  select doc_id, w, unnest(range(1, greatest(1, len(w) - 2) + 1)) as i from d where len(w) > 0
), s as (
  select distinct doc_id, array_to_string(w[i : i + 2], ' ') as sh from places
), sizes as (
  select doc_id, count(*) as n from s group by doc_id
), common as (
  select a.doc_id as x, b.doc_id as y, count(*) as n_both from s a join s b on a.sh = b.sh and a.doc_id < b.doc_id
  group by all
), links as (
  select x, y from common join sizes p on p.doc_id = x join sizes q on q.doc_id = y
  where 100 * n_both >= 90 * (p.n + q.n - n_both)
), near as (
  select x, y from links union all select y, x from links
), reach(doc_id, root) as (
  select doc_id, doc_id from d
  union
  select n.y, r.root from reach r join near n on r.doc_id = n.x
)
select d.doc_id, coalesce(any_value(n), 0) as n_shingles, min(root) as component_id
from d left join sizes using (doc_id) join reach using (doc_id) group by d.doc_id
"""

LEXICAL = r"""
with d as (
  select row_number() over () as r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[0-9a-z\x{80}-\x{10FFFF}]+') as w from documents
), b as (
  select distinct item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[0-9a-z\x{80}-\x{10FFFF}]+')) as term from benchmark
), s as (
  select count(*) as n_docs, sum(len(w))::bigint as n_all from d where len(w) > 0
), tf as (
  select r, term, count(*) as tf from (select r, unnest(w) as term from d) where term in (select term from b) group by all
), terms as (
  select term, cast(floor(1000 * ln((2 * n_docs + 2)::double / (2 * count(*) + 1))) as bigint) as weight
  from tf, s group by term, n_docs
), scored as (
  select b.item_id, d.doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * len(w) * n_docs) // n_all))))::bigint as score
  from b join tf using (term) join terms using (term) join d using (r), s group by b.item_id, r, d.doc_id
), ranked as (
  select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id) as integer) as rank, doc_id, score
  from scored where score > 0
)
select * from ranked where rank <= 10
"""
