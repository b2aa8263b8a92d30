"""DuckDB SQL for those queries of this subpackage that SQL can express on whole tables."""

from __future__ import annotations

WORDS = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: All pairs of a label by cosine in double precision, components by reachability.
FOREST = """
with recursive v as (
  select vec_id, label, list_transform(embedding, lambda x: x::double) as e from embeddings
), ok as (
  select vec_id, label, e from v
  where label is not null and e is not null and len(e) > 0 and len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(e, lambda x: x <> 0)) > 0
), links as materialized (
  select a.vec_id as a, b.vec_id as b from ok a join ok b on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e)
  where list_dot_product(a.e, b.e) / sqrt(list_dot_product(a.e, a.e)) / sqrt(list_dot_product(b.e, b.e)) >= 0.93
), reach as (
  select vec_id as id, vec_id as root from embeddings
  union
  select l.b, r.root from reach r join links l on l.a = r.id
), comp as (select id, min(root) as component_id from reach group by id),
deg as (select a as id, count(*) as n from links group by a)
select e.vec_id, coalesce(d.n, 0)::bigint as n_links, c.component_id, e.vec_id = c.component_id as kept
from embeddings e join comp c on c.id = e.vec_id left join deg d on d.id = e.vec_id
"""

#: Shingle sets as distinct texts, pairs that share one, components by reachability over distinct sets.
MINHASH = f"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORDS}') as w from documents
), s as materialized (
  select distinct doc_id, array_to_string(w[i : least(i + 4, len(w))], ' ') as g
  from w, unnest(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)) as r(i) where len(w) > 0
), n as materialized (
  select doc_id, count(*) as n, md5(string_agg(g, chr(10) order by g)) as same from s group by doc_id
), node as materialized (select same, min(doc_id) as id, any_value(n) as n from n group by same),
ns as materialized (select s.doc_id as id, s.g from s join node on node.id = s.doc_id),
common as (select a.id as a, b.id as b, count(*) as c from ns a join ns b on a.g = b.g and a.id < b.id group by all),
link as (select c.a, c.b from common c join node x on x.id = c.a join node y on y.id = c.b where 100 * c.c >= 85 * (x.n + y.n - c.c)),
both_ways as materialized (select a, b from link union all select b, a from link),
reach as (
  select id, id as root from node
  union
  select l.b, r.root from reach r join both_ways l on l.a = r.id
), comp as (select id, min(root) as root from reach group by id)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, coalesce(c.root, d.doc_id) as component_id, coalesce(c.root, d.doc_id) = d.doc_id as kept
from documents d left join n on n.doc_id = d.doc_id left join node on node.same = n.same left join comp c on c.id = node.id
"""

#: Every window of 100 bytes as hexadecimal text, first occurrences by (document, start), spans as gaps and islands.
SUFFIXES = """
with b as materialized (
  select doc_id, hex(encode(coalesce(text, ''))) as h from documents
), win as (
  select doc_id, i as s, md5_number(substring(h, 2 * i + 1, 200)) as k from b, unnest(range(0, greatest(len(h) // 2 - 99, 0))) as r(i)
), dup as (
  select doc_id, s from (select doc_id, s, row_number() over (partition by k order by doc_id, s) as r from win) where r > 1
), isle as (
  select doc_id, s, sum(case when s <= before + 100 then 0 else 1 end) over (partition by doc_id order by s) as g
  from (select doc_id, s, lag(s, 1, -1000) over (partition by doc_id order by s) as before from dup)
), span as materialized (select doc_id, min(s) as a, max(s) + 100 as z from isle group by doc_id, g),
piece as (
  select doc_id, a, z, lag(z, 1, 0) over (partition by doc_id order by a) as from_here, row_number() over (partition by doc_id order by a desc) as last from span
), kept as (
  select p.doc_id, string_agg(substring(b.h, 2 * from_here + 1, 2 * (a - from_here)), '' order by a) || any_value(substring(b.h, 2 * z + 1)) filter (where last = 1) as rest, sum(z - a) as gone, count(*) as n
  from piece p join b on b.doc_id = p.doc_id group by p.doc_id
)
select b.doc_id, (len(b.h) // 2)::bigint as n_bytes, coalesce(k.gone, 0)::bigint as n_removed, coalesce(k.n, 0)::bigint as n_spans, sha256(unhex(coalesce(k.rest, b.h))) as kept_sha256
from b left join kept k on k.doc_id = b.doc_id
"""
