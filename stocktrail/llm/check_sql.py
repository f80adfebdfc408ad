"""The operators' results as plain SQL, for those that SQL can express."""

from __future__ import annotations

# Words of the whole texts with their places; then windows of ten item words, shorter items whole.
OP8 = r"""
with doc_words as (
    select doc_id, unnest(words) as word, generate_subscripts(words, 1) as place
    from (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words from documents)
), item_lists as (
    select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words from benchmark
), item_windows as (
    select item_id, least(10, len(words)) as size,
           array_to_string(words[w : w + 9], ' ') as phrase
    from (select *, unnest(range(1, greatest(2, len(words) - 8))) as w from item_lists where len(words) > 0)
), sizes as (
    select distinct size from item_windows
), doc_windows as (
    select doc_id, place, size,
           array_to_string(list(word) over (partition by doc_id, size order by place
                           rows between current row and 9 following)[1 : size], ' ') as phrase,
           count(*) over (partition by doc_id, size order by place
                          rows between current row and 9 following) as there
    from doc_words, sizes
), found as (
    select distinct w.doc_id, w.place, w.size, i.item_id
    from doc_windows w join item_windows i on w.phrase = i.phrase and w.size = i.size
    where w.there >= w.size
), hit as (
    select doc_id, count(distinct place + k) as n_hit
    from (select doc_id, place, unnest(range(0, size)) as k from found)
    group by doc_id
), items as (
    select doc_id, count(*) as n_items, string_agg(id, ',' order by id) as ids
    from (select distinct doc_id, cast(item_id as varchar) as id from found where item_id is not null)
    group by doc_id
), counts as (
    select doc_id, count(*) as n_words from doc_words group by doc_id
)
select d.doc_id, coalesce(c.n_words, 0) as n_words, coalesce(h.n_hit, 0) as n_hit,
       coalesce(i.n_items, 0) as n_items, sha256(coalesce(i.ids, '')) as items_sha256,
       coalesce(h.n_hit, 0) > 0 as contaminated
from documents d
left join counts c on c.doc_id = d.doc_id
left join hit h on h.doc_id = d.doc_id
left join items i on i.doc_id = d.doc_id
"""

# Every query against every row, bit by bit.
OP1 = """
with codes as (
    select vec_id, list_transform(embedding, lambda x: x > 0) as bits from embeddings
), pairs as (
    select q.vec_id as query_id, b.vec_id,
           len(list_filter(list_zip(q.bits, b.bits), lambda p: p[1] <> p[2])) as distance
    from codes q, codes b
    where q.vec_id % 50 = 0
)
select query_id, cast(rank as int) as rank, vec_id, cast(distance as int) as distance
from (select *, row_number() over (partition by query_id order by distance, vec_id) as rank from pairs)
where rank <= 10
"""

# Words with their CRC-32, from its polynomial by bits; then counts by bucket, gains, scores and ranks.
OP12 = r"""
with crc_table as (
    select list_transform(range(256), lambda n: list_reduce(
               list_prepend(n, list_transform(range(8), lambda r: cast(0 as bigint))),
               lambda c, r: case when c & 1 = 1 then xor(3988292384, c >> 1) else c >> 1 end)) as t
), doc_words as (
    select doc_id, rowid_, unnest(words) as word
    from (select doc_id, row_number() over () as rowid_, regexp_extract_all(translate(coalesce(text, ''),
                 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words from documents)
), target_words as (
    select unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as word from benchmark
), doc_counts as (
    select doc_id, rowid_, word, count(*) as k from doc_words group by all
), target_counts as (
    select word, count(*) as k from target_words group by all
), spelled as (
    select word, hex(encode(word)) as h
    from (select word from doc_counts union select word from target_counts)
), buckets as (
    select word, xor(4294967295, list_reduce(
               list_prepend(cast(4294967295 as bigint), list_transform(range(length(h) // 2),
                   lambda i: cast('0x' || substr(h, cast(2 * i + 1 as int), 2) as bigint))),
               lambda c, b: xor(c >> 8, t[cast(xor(c, b) & 255 as int) + 1]))) % 10000 as bucket
    from spelled, crc_table
), of_docs as (
    select bucket, sum(k) as s from doc_counts join buckets using (word) group by bucket
), of_target as (
    select bucket, sum(k) as t from target_counts join buckets using (word) group by bucket
), gains as (
    select bucket, cast(floor(1000 * ln((coalesce(t, 0) + 1.0::double) * ((select coalesce(sum(s), 0) from of_docs) + 10000)
               / ((coalesce(s, 0) + 1.0::double) * ((select coalesce(sum(t), 0) from of_target) + 10000)))) as bigint) as gain
    from of_docs full join of_target using (bucket)
), weighed as (
    select rowid_, sum(k) as n_features, cast(floor(sum(k * gain) / sum(k)) as bigint) as weight
    from doc_counts join buckets using (word) join gains using (bucket)
    group by rowid_
), numbered as (
    select doc_id, row_number() over () as rowid_ from documents
), scored as (
    select doc_id, cast(coalesce(n_features, 0) as bigint) as n_features, coalesce(weight, 0) as weight,
           cast(coalesce(weight, 0) + floor(-1000 * ln(-ln((cast('0x' || substr(sha256('2024:' || coalesce(cast(doc_id as varchar), '')), 1, 8)
                as bigint) + 0.5::double) / 4294967296))) as bigint) as score
    from numbered left join weighed using (rowid_)
), able as (
    select *, row_number() over (partition by n_features >= 20 order by score desc, doc_id) as place,
           count(*) filter (n_features >= 20) over () as n
    from scored
)
select doc_id, n_features, weight, score,
       case when n_features >= 20 and place <= 10 * n // 100 then place end as rank
from able
"""

SQL = {"op1_topk_search": OP1, "op8_decontaminate": OP8, "op12_importance_sample": OP12}
