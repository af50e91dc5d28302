"""SQL counterparts of the queries that SQL can express."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

ORACLE["op5_warc_transactions"] = """
with d as (
  select page_id, url, coalesce(html, '') as body, sha1(coalesce(html, '')) as h from pages
), m as (
  select *, max(page_id) over (partition by body) as top from d
)
select page_id, octet_length(encode(body))::bigint as payload_bytes,
  list_aggregate(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 +
    ((('0x' || substr(h, 1 + 10 * (k // 8)::bigint, 10))::bigint >> (35 - 5 * (k % 8))::bigint) & 31)::bigint, 1)), 'string_agg', '') as payload_digest,
  case when page_id = top then 'response' else 'revisit' end as record_type,
  case when page_id = top then null else top end as refers_to,
  case when page_id = top then true end as digest_ok, url as target_uri
from m
"""

ORACLE["op10_embedding_near_dedup"] = """
with recursive v as (
  select vec_id, label, embedding::double[] as e from embeddings where label is not null and embedding is not null
    and list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x))) and list_bool_or(list_transform(embedding, lambda x: x <> 0))
), u as (
  select vec_id, label, e, sqrt(list_dot_product(e, e)) as n from v
), l as (
  select a.vec_id as a, b.vec_id as b from u a join u b on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e)
  where list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.93
), r(node, reach) as (
  select vec_id, vec_id from embeddings union select l.b, r.reach from r join l on l.a = r.node where r.reach < l.b
), c as (
  select node, min(reach) as component_id from r group by node
), k as (
  select a, count(*) as n from l group by a
)
select e.vec_id, coalesce(k.n, 0)::bigint as n_links, c.component_id, e.vec_id = c.component_id as kept
from embeddings e join c on c.node = e.vec_id left join k on k.a = e.vec_id
"""

ORACLE["op8_repeated_passages"] = r"""
with w as (
  select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws from documents
), p as (
  select doc_id, unnest(range(0, greatest(len(ws) - 19, 0))) as i,
    unnest(list_transform(range(0, greatest(len(ws) - 19, 0)), lambda i: array_to_string(ws[i + 1:i + 20], ' '))) as words from w
), q as (
  select doc_id, i, row_number() over (partition by words order by doc_id, i) > 1 as again from p
), x as (
  select doc_id, unnest(range(0, len(ws))) as i, unnest(ws) as word from w
), c as (
  select x.doc_id, x.i, word, coalesce(bool_or(again) over (partition by x.doc_id order by x.i rows between 19 preceding and current row), false) as gone
  from x left join q on q.doc_id = x.doc_id and q.i = x.i
), k as (
  select doc_id, count(*) as n, count_if(gone) as g, coalesce(string_agg(word, ' ' order by i) filter (where not gone), '') as kept from c group by doc_id
)
select w.doc_id, coalesce(n, 0)::bigint as n_words, coalesce(g, 0)::bigint as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from w left join k using (doc_id)
"""
