"""DuckDB SQL of the queries that SQL can express."""

SUBSTRINGS = r"""
with d as (select row_number() over () as rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
p as (select rid, w, unnest(generate_series(1, len(w) - 34)) as i from d where len(w) >= 35),
s as (select rid, i, array_to_string(w[i:i + 34], ' ') as t from p),
r as (select t from s group by t having count(*) > 1),
c as (select distinct rid, i + o as k from s join r using (t), (select unnest(generate_series(0, 34)) as o)),
u as (select rid, unnest(w) as word, unnest(generate_series(1, len(w))) as k from d),
x as (select u.rid, u.k, u.word, c.k is not null as gone from u left join c on c.rid = u.rid and c.k = u.k),
g as (select rid, count(*) filter (gone) as n, string_agg(word, ' ' order by k) filter (not gone) as kept from x group by rid)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n, 0) as n_removed, sha256(coalesce(kept, '')) as kept_sha256 from d left join g using (rid)
"""

SUFFIXES = r"""
with d as (select row_number() over () as rid, doc_id, hex(encode(coalesce(text, ''))) as h from documents),
p as (select rid, doc_id, h, unnest(generate_series(1, len(h) // 2 - 49)) as i from d where len(h) >= 100),
s as (select rid, doc_id, i, substr(h, 2 * i - 1, 100) as t from p),
m as (select t, min(doc_id) as least from s group by t),
c as (select rid, i from s join m using (t) where least < doc_id),
e as (select rid, i, i - lag(i) over (partition by rid order by i) as step from c),
f as (select rid, i, sum(case when step is null or step > 50 then 1 else 0 end) over (partition by rid order by i) as run from e),
u as (select rid, run, min(i) as a, max(i) + 50 as b from f group by rid, run),
g as (select rid, sum(b - a) as n, count(*) as spans, list(a order by a) as starts, list(b order by a) as ends from u group by rid),
y as (select rid, h, unnest(list_prepend(cast(1 as bigint), ends)) as a, unnest(list_append(starts, cast(len(h) // 2 + 1 as bigint))) as b from d join g using (rid)),
k as (select rid, string_agg(substr(h, 2 * a - 1, 2 * (b - a)), '' order by a) as kept from y group by rid)
select doc_id, cast(len(h) // 2 as bigint) as n_bytes, cast(coalesce(n, 0) as bigint) as n_removed, coalesce(spans, 0) as n_spans, sha256(unhex(coalesce(kept, h))) as kept_sha256 from d left join g using (rid) left join k using (rid)
"""

CONTAMINATION = r"""
with lo as (select 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' as a, 'abcdefghijklmnopqrstuvwxyz' as b),
d as (select row_number() over () as rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), a, b), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents, lo),
q as (select coalesce(cast(item_id as varchar), '') as item, regexp_extract_all(translate(coalesce(text, ''), a, b), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark, lo),
v as (select item, array_to_string(w[i:i + 12], ' ') as t, 13 as n from (select item, w, unnest(generate_series(1, len(w) - 12)) as i from q where len(w) >= 13)
  union select item, array_to_string(w, ' '), len(w) from q where len(w) between 1 and 12),
p as (select rid, w, n, unnest(generate_series(1, len(w) - n + 1)) as i from d, (select distinct n from v) where len(w) >= n),
h as (select rid, i, p.n, item from p join v on v.n = p.n and v.t = array_to_string(w[i:i + p.n - 1], ' ')),
c as (select rid, count(distinct k) as n_hit from (select rid, unnest(generate_series(i, i + n - 1)) as k from h) group by rid),
g as (select rid, count(*) as n_items, string_agg(item, ',' order by item) as items from (select distinct rid, item from h) group by rid)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from d left join c using (rid) left join g using (rid)
"""

MIXTURE = r"""
with d as (select doc_id, source, coalesce(text, '') as t, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size from documents),
s as (select source, cast(sum(size) as hugeint) as n, [1, 2, 3][cast((row_number() over (order by source nulls last) - 1) % 3 + 1 as int)] as w from d group by source),
o as (select *, sum(n) over () as total, coalesce(sum(3 * n) over (order by 3 * n / w::double, source rows between unbounded preceding and 1 preceding), 0) as gone, sum(w) over (order by 3 * n / w::double, source rows between current row and unbounded following) as rest from s),
e as (select total - gone as over_, rest from o where 3 * n * rest >= (total - gone) * w order by 3 * n / w::double, source limit 1),
g as (select source, n, case when 3 * n * rest < over_ * w then cast(3 * n as double) else cast(over_ as double) / cast(rest as double) * w end as target from s, e),
r as (select d.*, n, target, case when n = 0 then 0.0::double else target / cast(n as double) end as rate, cast('0x' || substr(md5(concat('11:', coalesce(cast(doc_id as varchar), ''), ':', t)), 1, 13) as bigint) / 4503599627370496.0::double as draw from d join g on d.source is not distinct from g.source)
select doc_id, size, cast(n as bigint) as source_size, target, size * (cast(floor(rate) as bigint) + case when draw < rate - floor(rate) then 1 else 0 end) as taken from r
"""
