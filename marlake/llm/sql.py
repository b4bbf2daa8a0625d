"""Reference SQL (DuckDB) of the registered queries that SQL can state."""

BLANKS = r"[\x20\x09-\x0D]+"
WORDS = r"[^\x20\x09-\x0D]+"

SQL: dict[str, str] = {}

SQL["op1_line_frequency"] = rf"""
with docs as (
  select row_number() over () as r, doc_id, coalesce('h' || source, '-') as host, coalesce(text, '') as t from documents
),
cut as (select r, doc_id, host, t, regexp_extract_all(t, '{WORDS}') as w from docs),
wins as (
  select r, generate_subscripts(w, 1) as i, w from cut where len(w) >= 3
),
win as (select r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as g from wins where i <= len(w) - 2),
twice as (select r, i from (select r, i, count(*) over (partition by r, g) as n from win) where n > 1),
covered as (
  select r, count(distinct i + d) as n from twice, (values (0), (1), (2)) as s(d) group by r
),
line as (
  select r, doc_id, host, unnest(string_split(t, chr(10))) as l from docs
),
form as (
  select r, doc_id, host, l, len(regexp_extract_all(l, '{WORDS}')) as words, lower(trim(regexp_replace(l, '{BLANKS}', ' ', 'g'))) as f
  from line where regexp_matches(l, '{WORDS}')
),
lines as (
  select *, case when length(translate(f, '0123456789 ', '')) >= 4 * (length(f) - length(translate(f, '0123456789', '')))
    then translate(f, '123456789', '000000000') else f end as k
  from form
),
held as (select host, k, doc_id from lines where doc_id is not null group by host, k, doc_id having count(distinct f) = 1),
often as (select host, k from held group by host, k having count(*) > 20),
gone as (
  select r, count(*) as n, sum(words) as words from lines l semi join often o on o.host = l.host and o.k = l.k group by r
),
own as (select r, count(*) as n, count(*) - count(distinct l) as dup from lines group by r),
base as (
  select c.r, c.doc_id, len(c.w) as n_words, length(array_to_string(c.w, '')) as word_chars,
    len(regexp_extract_all(c.t, '[#*$%&|<>]')) as n_symbols, coalesce(o.dup, 0) as n_dup_lines,
    coalesce(v.n, 0) as n_repeat_words, coalesce(o.n, 0) as n_lines, coalesce(g.n, 0) as n_removed_lines, coalesce(g.words, 0) as n_removed_words
  from cut c left join own o on o.r = c.r left join covered v on v.r = c.r left join gone g on g.r = c.r
),
judged as (
  select *, (n_words < 50 or 100 * n_repeat_words > 50 * n_words) as base_failed,
    ((n_words - n_removed_words) * 100 < n_words * 50) as depleted
  from base
)
select doc_id, n_words, word_chars::bigint as word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, (not base_failed and not depleted) as kept,
  n_lines, n_removed_lines, n_removed_words::bigint as n_removed_words, depleted
from judged
"""

B32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(h, {5 * i + 1}, 5))::bigint >> {s}) & 31) + 1)::int, 1)"
    for i in range(8)
    for s in (15, 10, 5, 0)
)

SQL["op3_content_addressed_archive"] = f"""
with p as (select page_id, coalesce(html, '') as b from pages),
hashed as (select page_id, strlen(b) as payload_bytes, sha1(b) as h from p),
placed as (
  select *, row_number() over (partition by h order by page_id) as k, min(page_id) over (partition by h) as first from hashed
)
select page_id, payload_bytes, {B32} as payload_digest,
  case when k = 1 then 'response' else 'revisit' end as record_type,
  case when k > 1 then first end as refers_to
from placed
"""

SQL["op4_bottom_k_near_duplicates"] = rf"""
with recursive lowered as (
  select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents
),
cut as (select doc_id, regexp_extract_all(t, '{WORDS}') as w from lowered),
places as (select doc_id, w, generate_subscripts(w, 1) as i from cut),
shingle as (
  select distinct doc_id, case when len(w) >= 5 then array_to_string(w[i:i + 4], ' ') else array_to_string(w, ' ') end as g
  from places where i <= greatest(len(w) - 4, 1)
),
sizes as (select doc_id, count(*) as n from shingle group by doc_id),
both_have as (
  select a.doc_id as a, b.doc_id as b, count(*) as c from shingle a join shingle b on a.g = b.g and a.doc_id < b.doc_id group by all
),
link as (
  select h.a, h.b from both_have h join sizes x on x.doc_id = h.a join sizes y on y.doc_id = h.b
  where 100 * h.c >= 85 * (x.n + y.n - h.c)
),
edge as (select a, b from link union all select b, a from link),
reach as (
  select doc_id as a, doc_id as b from documents
  union
  select r.a, e.b from reach r join edge e on e.a = r.b
),
least as (select a as doc_id, min(b) as component_id from reach group by a)
select d.doc_id, coalesce(s.n, 0) as n_shingles, l.component_id, d.doc_id = l.component_id as kept
from documents d join least l on l.doc_id = d.doc_id left join sizes s on s.doc_id = d.doc_id
"""

SQL["op11_line_dedup"] = r"""
with line as (
  select doc_id, pos, l, translate(trim(l, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k
  from (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as l, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos from documents)
),
shared as (select k, max(doc_id) as keeper from line where length(k) >= 20 group by k having count(distinct doc_id) >= 3),
judged as (select line.*, s.k is not null and line.doc_id <> s.keeper as gone from line left join shared s on s.k = line.k)
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
  sha256(coalesce(string_agg(l, chr(10) order by pos) filter (not gone), '')) as kept_sha256
from judged group by doc_id
"""

SQL["op13_hard_negatives"] = """
with v as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings
  where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
s as (
  select a.vec_id as anchor_id, r.vec_id as id, a.label = r.label as same, list_inner_product(a.v, r.v)::bigint as score
  from v a join v r on a.vec_id <> r.vec_id where a.vec_id % 50 = 0
),
p as (
  select anchor_id, id as positive_id, score as positive_score from s where same
  qualify row_number() over (partition by anchor_id order by score desc, id) <= 5
)
select p.anchor_id, positive_id, row_number() over (partition by p.anchor_id, positive_id order by score desc, id)::int as rank,
  id as negative_id, positive_score, score as negative_score
from p join s on s.anchor_id = p.anchor_id and not same and 100 * score between 50 * positive_score and 95 * positive_score
qualify rank <= 3
"""
