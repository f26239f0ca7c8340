"""SQL that the queries are compared with (DuckDB)."""

from __future__ import annotations

from . import mixing, quality

WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"
SEPARATORS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

#: Columns of documents and the counts of op1, one row per row of @docs.
MEASURES = rf"""
m_rows as (select *, row_number() over () as rid, coalesce(text, '') as t, {WORDS} as w from @docs),
m_grams as (
  select rid, unnest(range(1, len(w) - 3)) as i, unnest(list_transform(range(1, len(w) - 3), lambda i: w[i:i + 4])) as g
  from m_rows where len(w) > 5
),
m_again as (select rid, i, count(*) over (partition by rid, g) as n from m_grams),
m_gaps as (
  select rid, least(5, coalesce(lead(i) over (partition by rid order by i) - i, 5)) as len from m_again where n > 1
),
m_repeat as (select rid, sum(len)::bigint as n_repeat_words from m_gaps group by rid),
m_lines as (
  select rid, t, list_filter(string_split(t, chr(10)), lambda x: translate(x, {SEPARATORS}, '') <> '') as l from m_rows
),
m_counts as (
  select r.*, len(w)::bigint as n_words, length(translate(r.t, {SEPARATORS}, ''))::bigint as word_chars,
    (length(r.t) - length(translate(r.t, '{quality.SYMBOLS}', '')))::bigint as n_symbols,
    (len(l) - len(list_distinct(l)))::bigint as n_dup_lines, len(l) as n_lines,
    coalesce(n_repeat_words, 0) as n_repeat_words, length(regexp_replace(r.t, '[^\p{{Lu}}]+', '', 'g'))::bigint as n_capitals
  from m_rows r join m_lines using (rid) left join m_repeat using (rid)
),
m_rates as (
  select *, n_words < {quality.MIN_WORDS} or 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words as base_failed,
    coalesce(floor(1000 * n_symbols / nullif(n_words, 0)), 0)::bigint as symbol_rate,
    coalesce(floor(1000 * n_dup_lines / nullif(n_lines, 0)), 0)::bigint as line_rate,
    coalesce(floor(1000 * n_repeat_words / nullif(n_words, 0)), 0)::bigint as repeat_rate,
    coalesce(floor(1000 * n_capitals / nullif(word_chars, 0)), 0)::bigint as capital_rate,
    coalesce(floor(1000 * word_chars / nullif(n_words, 0)), 0)::bigint as word_length
  from m_counts
),
m_long as (
  unpivot (select rid, lang, source, symbol_rate, line_rate, repeat_rate, capital_rate, word_length from m_rates)
  on symbol_rate, line_rate, repeat_rate, capital_rate, word_length into name measure value v
),
m_binned as (
  select lang, source, measure, v - v % (2 ** greatest(length(bin(v)) - {quality.BIN_BITS + 1}, 0))::bigint as bin, count(*) as n
  from m_long group by all
),
m_own as (
  select lang, source, measure, max(s) as n_rows, min(bin) filter (u >= 0.5 * s) as mid, min(bin) filter (u >= 0.75 * s) as high
  from (select *, sum(n) over (partition by lang, source, measure order by bin) as u,
               sum(n) over (partition by lang, source, measure) as s from m_binned)
  group by all
),
m_shared as (
  select lang, measure, min(bin) filter (u >= 0.5 * s) as mid, min(bin) filter (u >= 0.75 * s) as high
  from (select lang, measure, bin, sum(sum(n)) over (partition by lang, measure order by bin) as u,
               sum(sum(n)) over (partition by lang, measure) as s from m_binned group by lang, measure, bin)
  group by all
),
m_limits as (
  select o.lang, o.source, o.measure,
    case when n_rows >= {quality.MIN_ROWS} then o.high else c.high end + {quality.SPREAD} * greatest(
      case when n_rows >= {quality.MIN_ROWS} then o.high - o.mid else c.high - c.mid end,
      case o.measure {" ".join(f"when '{k}' then {v}" for k, v in quality.FLOORS.items())} end) as most
  from m_own o join m_shared c on o.lang is not distinct from c.lang and o.measure = c.measure
),
m_bad as (
  select distinct rid from m_long l join m_limits k
    on l.lang is not distinct from k.lang and l.source is not distinct from k.source and l.measure = k.measure
  where v > most
),
m_judged as (select r.*, not base_failed and b.rid is null as kept from m_rates r left join m_bad b using (rid))
"""

QUALITY_SQL = f"""with {MEASURES.replace("@docs", "documents")}
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept from m_judged"""

#: Rows of @docs with size, source_size, target, start, blocks, copies, turn and taken.
MIX = rf"""
x_rows as (select *, row_number() over () as xid, len({WORDS})::bigint as size from @docs),
x_totals as (select source, sum(size)::bigint as source_size from x_rows group by source),
x_weighed as (
  select *, {mixing.REPEATS} * source_size / weight as full_at from (
    select *, ([{", ".join(map(str, mixing.WEIGHTS))}])[(row_number() over (order by source nulls last) - 1) % {len(mixing.WEIGHTS)} + 1] as weight
    from x_totals)
),
x_run as (
  select *, row_number() over o as nth,
    (sum(source_size) over () - {mixing.REPEATS} * coalesce(sum(source_size) over (o rows between unbounded preceding and 1 preceding), 0))::bigint as left_words,
    (sum(weight) over () - coalesce(sum(weight) over (o rows between unbounded preceding and 1 preceding), 0))::bigint as left_weight
  from x_weighed window o as (order by full_at, source nulls last)
),
x_from as (select nth as f_nth, left_words as f_words, left_weight as f_weight from x_run where left_words / left_weight <= full_at order by nth limit 1),
x_targets as (
  select source, source_size,
    case when nth < coalesce(f_nth, nth + 1) then ({mixing.REPEATS} * source_size)::double
         else weight * f_words / f_weight::double end as target
  from x_run left join x_from on true
),
x_s as (
  select *, greatest(ceil(source_size / {mixing.SHARD_WORDS}), 1)::bigint as n_shards,
    floor(sum(source_size) over () / {mixing.BLOCK_WORDS} + 0.5) as seats, sum(target) over () as total, count(*) over () as parties
  from x_targets
),
x_s2 as (
  select *, case when target > 0 then greatest(coalesce(floor(target * greatest(seats - parties / 2 - 1, 0.0) / nullif(total, 0) + 0.5), 0), 0) else 0 end::bigint as low,
    coalesce(floor(target * (seats + parties / 2 + 1) / nullif(total, 0) + 0.5), 0)::bigint as high from x_s
),
x_s3 as (select source, target / (2 * k + 1) as q from (select source, target, unnest(range(low, high)) as k from x_s2)),
x_s4 as (select source, count(*) as won from (select source, row_number() over (order by q desc, source nulls last) as r from x_s3)
  where r <= (select greatest(max(seats) - sum(low), 0) from x_s2) group by source),
x_quota as (select s.*, low + coalesce(won, 0) as source_quota from x_s2 s left join x_s4 w on s.source is not distinct from w.source),
x_key as (
  select r.*, source_size, target, source_quota, md5('{mixing.KEY}/' || coalesce(doc_id::varchar, md5(text), '')) as digest,
    ('0x' || substr(md5('{mixing.KEY}/' || coalesce(doc_id::varchar, md5(text), '')), 1, 8))::bigint % n_shards as shard
  from x_rows r join x_quota q on r.source is not distinct from q.source
),
x_h as (
  select source, shard, sum(size)::double as claim, max(source_quota) as seats, ceil(sum(size) / {mixing.BLOCK_WORDS})::bigint as blocks
  from x_key group by source, shard
),
x_h1 as (select *, sum(claim) over (partition by source) as total, count(*) over (partition by source) as parties from x_h),
x_h2 as (
  select *, case when claim > 0 then greatest(coalesce(floor(claim * greatest(seats - parties / 2 - 1, 0.0) / nullif(total, 0) + 0.5), 0), 0) else 0 end::bigint as low,
    coalesce(floor(claim * (seats + parties / 2 + 1) / nullif(total, 0) + 0.5), 0)::bigint as high from x_h1
),
x_h3 as (
  select source, shard, row_number() over (partition by source order by claim / (2 * k + 1) desc, shard) as r
  from (select source, shard, claim, unnest(range(low, high)) as k from x_h2)
),
x_h4 as (select source, shard, count(*) filter (r <= open) as won from x_h3 join
  (select source as o_source, greatest(max(seats) - sum(low), 0) as open from x_h2 group by source) on source is not distinct from o_source group by source, shard),
x_h5 as (
  select h.source, h.shard, blocks, least(low + coalesce(won, 0), {mixing.REPEATS} * blocks)::bigint as copies,
    case when blocks > 0 then ('0x' || substr(md5('{mixing.KEY}/turn/' || coalesce(h.source, '') || '/' || h.shard), 1, 7))::bigint % blocks else 0 end as turn
  from x_h2 h left join x_h4 w on h.source is not distinct from w.source and h.shard = w.shard
),
x_line as (
  select *, (sum(size) over (partition by source, shard order by digest, doc_id, size rows between unbounded preceding and current row) - size)::bigint as start
  from x_key
),
x_place as (
  select p.*, blocks, copies, turn, start // {mixing.BLOCK_WORDS} as b0, (start + size) // {mixing.BLOCK_WORDS} as b1
  from x_line p join x_h5 h on p.source is not distinct from h.source and p.shard = h.shard
),
x_mix as (
  select *, case when size > 0 then
    {mixing.BLOCK_WORDS} * ((b1 + turn) * copies // blocks - (b0 + turn) * copies // blocks)
    + (start + size - b1 * {mixing.BLOCK_WORDS}) * ((b1 + 1 + turn) * copies // blocks - (b1 + turn) * copies // blocks)
    - (start - b0 * {mixing.BLOCK_WORDS}) * ((b0 + 1 + turn) * copies // blocks - (b0 + turn) * copies // blocks)
    else 0 end::bigint as taken
  from x_place
)
"""

MIXING_SQL = f"with {MIX.replace('@docs', 'documents')} select doc_id, size, source_size, target, taken from x_mix"

WARC_SQL = """with p as (select page_id, coalesce(html, '') as h from pages),
q as (select page_id, octet_length(encode(h))::bigint as payload_bytes, sha256(h) as payload_digest from p),
f as (select *, min(page_id) over (partition by payload_digest) as first from q)
select page_id, payload_bytes, payload_digest,
  case when payload_bytes >= 100 and page_id <> first then 'revisit' else 'response' end as record_type,
  case when payload_bytes >= 100 and page_id <> first then first end as refers_to
from f"""

URLFILTER_SQL = r"""with rules(rh, rp, rv) as (values ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
p as (select row_number() over () as rid, page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
s as (select rid, page_id, regexp_extract(coalesce(rest, ''), '^[^/?#]*') as host,
  regexp_extract(regexp_replace(coalesce(rest, ''), '^[^/?#]*', ''), '^[^?#]*') as path from p),
t as (select rid, page_id, translate(host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host, path from s),
m as (select rid, arg_max(rh || rp, length(rh || rp)) as rule, arg_max(rv, length(rh || rp)) as rv
  from t join rules on (host = rh or ends_with(host, '.' || rh)) and starts_with(path, rp) group by rid)
select page_id, host, path, rule, coalesce(rv, 'allow') as verdict from t left join m using (rid)"""

SUBSTRING_SQL = rf"""with d as (select doc_id, row_number() over (order by doc_id) as rid, {WORDS} as w from documents),
g as (select rid, unnest(range(1, len(w) - 18)) as i, unnest(list_transform(range(1, len(w) - 18), lambda i: w[i:i + 19])) as g from d where len(w) >= 20),
r as (select rid, i from (select rid, i, row_number() over (partition by g order by rid, i) as n from g) where n > 1),
c as (select distinct rid, unnest(range(i, i + 20)) as p from r),
k as (select rid, unnest(w) as x, unnest(range(1, len(w) + 1)) as p from d),
t as (select rid, string_agg(x, ' ' order by p) as t, count(*) as n from k anti join c using (rid, p) group by rid)
select doc_id, len(w)::bigint as n_words, (len(w) - coalesce(n, 0))::bigint as n_removed, sha256(coalesce(t, '')) as kept_sha256
from d left join t using (rid)"""

#: op11: checksums by a table made from the polynomial, near words by what deleting one code point leaves.
SPELLING_SQL = r"""
with recursive crc_table as (
  select list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end, i)) as t
),
runs as (
  select coalesce(cast(doc_id as varchar), '') as id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run, count(*) as n
  from (select doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')) as run from documents) as r
  group by all
),
sums as (
  select run, n, xor(4294967295, list_reduce(
    flatten(list_transform(string_split(id || ':' || run, ''), lambda x: case when ord(x) < 128 then [ord(x)::bigint] else [195, ord(x)::bigint - 64] end)),
    lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1]), 4294967295::bigint)) as h
  from runs, crc_table
),
words as (
  select word, sum(n)::bigint as n
  from (select case when h % 97 = 0 then left(run, (h % length(run))::int) || substr(run, (h % length(run))::int + 2) else run end as word, n from sums) as s
  where length(word) >= 5 group by word having sum(n) >= 3
),
shorter as (
  select word, n, i, left(word, i::int) || substr(word, i::int + 2) as rest from (select word, n, unnest(range(length(word))) as i from words) as w
),
near as (
  select distinct * from (
    select a.word, b.word as near, b.n as near_n from shorter a join shorter b on a.rest = b.rest and a.i = b.i and a.word <> b.word
    union all select s.word, w.word, w.n from shorter s join words w on s.rest = w.word
    union all select w.word, s.word, s.n from shorter s join words w on s.rest = w.word
  ) as p
),
best as (
  select word, count(*) as n_near, first(near order by near_n desc, near) as near, max(near_n) as near_n from near group by word
),
forms as (
  select word, n, coalesce(n_near, 0)::bigint as n_near, case when near_n >= 2 * n then near end as form, case when near_n >= 2 * n then near_n end as form_n
  from words left join best using (word)
),
chain as (
  select word, word as root, form as next from forms
  union all select c.word, c.next, f.form from chain c join forms f on c.next = f.word
)
select f.word, f.form, c.root, f.n, f.n_near, f.form_n from forms f join chain c on c.word = f.word and c.next is null
"""

#: op12: all products.
KNN_SQL = """
with ints as (
  select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
scored as (
  select q.vec_id as query_id, r.vec_id, list_inner_product(q.v, r.v)::bigint as score
  from ints q join ints r on r.vec_id <> q.vec_id where q.vec_id % 100 = 0
)
select query_id, rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from scored) as s where rank <= 10
"""
