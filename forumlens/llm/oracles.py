"""SQL counterparts of the queries that SQL can express."""

from __future__ import annotations

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

OP1 = f"""
with p as (
    select page_id, coalesce(html, '') as body from pages
), d as (
    select page_id, strlen(body) as payload_bytes, sha1(body) as hex,
        max(page_id) over (partition by sha1(body), strlen(body)) as response from p
), b as (
    select *, array_to_string(list_transform(string_split(hex, ''),
        lambda x: substr(lpad(bin(cast(strpos('0123456789abcdef', x) - 1 as integer)), 4, '0'), 1, 4)), '') as bits from d
)
select page_id, payload_bytes::bigint as payload_bytes,
    array_to_string(list_transform(range(0, 32),
        lambda i: substr('{ALPHABET}', 1 + cast(list_sum(list_transform(range(0, 5),
            lambda j: cast(substr(bits, cast(5 * i + j + 1 as integer), 1) as integer) * cast(power(2, 4 - j) as integer))) as integer), 1)), '') as payload_digest,
    case when page_id < response then 'revisit' else 'response' end as record_type,
    case when page_id < response then response end as refers_to
from b
"""

OP2 = """
with v as (
    select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as v from embeddings
    where embedding is not null and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
), s as (
    select q.vec_id as query_id, c.vec_id, list_dot_product(q.v, c.v)::bigint as score
    from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 50 = 0
), r as (
    select *, row_number() over (partition by query_id order by score desc, vec_id) as place from s
)
select query_id, place::integer as rank, vec_id, score from r where place <= 5
"""

WORDS = "regexp_extract_all(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

OP9 = f"""
with d as (
    select row_number() over () as row, doc_id, coalesce({WORDS.format('text')}, []) as words from documents
), i as (
    select item_id, {WORDS.format('text')} as words from benchmark where text is not null
), w as (
    select distinct item_id, least(13, len(words)) as n,
        array_to_string(list_slice(words, s, s + least(13, len(words)) - 1), ' ') as gram
    from (select *, unnest(range(1, len(words) - least(13, len(words)) + 2)) as s from i where len(words) > 0)
), h as (
    select distinct row, s, w.n, item_id
    from (select row, n, unnest(range(1, len(words) - n + 2)) as s, words from d, (select distinct n from w) where len(words) >= n) o
    join w on w.n = o.n and w.gram = array_to_string(list_slice(words, s, s + o.n - 1), ' ')
), c as (
    select row, count(distinct place) as n_hit from (select row, unnest(range(s, s + n)) as place from h) group by row
), k as (
    select row, count(*) as n_items, string_agg(item, ',' order by item) as items
    from (select distinct row, item_id::varchar as item from h where item_id is not null) group by row
)
select doc_id, len(words)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
    sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit > 0 and 20 * n_hit >= len(words), false) as contaminated
from d left join c using (row) left join k using (row)
"""

ORACLES = {"op1_warc": OP1, "op2_top_k": OP2, "op9_decontamination": OP9}
