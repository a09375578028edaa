"""SQL of the operators that SQL can express, written independently of the Spark code."""

QUALITY = r"""
with d as (select doc_id, source, coalesce(text, '') as t from documents),
w as (select doc_id, source, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as w,
      list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l from d),
tri as (select doc_id, i, w[i] || ' ' || w[i+1] || ' ' || w[i+2] as g from
        (select doc_id, w, unnest(range(1, greatest(len(w) - 1, 1))) as i from w)),
rep as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, g) as n from tri) where n > 1),
cov as (select doc_id, count(distinct j) as n from (select doc_id, unnest([i, i+1, i+2]) as j from rep) group by 1),
base as (select w.doc_id, source, t, len(w)::bigint as n_words, length(array_to_string(w, ''))::bigint as word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
         (len(l) - len(list_distinct(l)))::bigint as n_dup_lines, coalesce(cov.n, 0)::bigint as n_repeat_words
         from w left join cov on w.doc_id = cov.doc_id),
line as (select doc_id, source, t, lower(trim(regexp_replace(x, '[\x20\x09-\x0D]+', ' ', 'g'))) as line,
         len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) as n from (select doc_id, source, t, unnest(l) as x from w)),
freq as (select source, line, count(distinct t) as n, min(doc_id) as first from line group by all),
host as (select source, count(distinct t) as texts from d group by 1),
above as (select f.source, line, first from freq f join host h on f.source is not distinct from h.source
          where n >= 20 and n * 100 > 5 * texts),
lost as (select l.doc_id, sum(l.n) as n from line l join above a on l.source is not distinct from a.source and l.line = a.line
         and l.doc_id is distinct from a.first group by 1)
select base.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < 50 or 100 * n_repeat_words > 50 * n_words) as base_failed, coalesce(lost.n, 0)::bigint as n_lost_words,
  not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and n_words - coalesce(lost.n, 0) >= 50
  and 2 * (n_words - coalesce(lost.n, 0)) > n_words as kept
from base left join lost on base.doc_id = lost.doc_id
"""

DECONTAMINATION = r"""
with d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
b as (select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
win as (select distinct item_id, least(10, len(w)) as k, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') as win
        from (select item_id, w, unnest(range(1, greatest(len(w) - least(10, len(w)) + 2, 1))) as i from b where len(w) > 0)),
dw as (select doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') as win from
       (select doc_id, w, k, unnest(range(1, greatest(len(w) - k + 2, 1))) as i from d, (select distinct k from win))),
occ as (select dw.doc_id, dw.i, dw.k, win.item_id from dw join win on dw.k = win.k and dw.win = win.win),
hit as (select doc_id, count(distinct p) as n from (select doc_id, unnest(range(i, i + k)) as p from occ) group by 1),
it as (select doc_id, list_sort(list(distinct item_id::varchar)) as items from occ group by 1)
select d.doc_id, len(w)::bigint as n_words, coalesce(hit.n, 0)::bigint as n_hit, coalesce(len(items), 0)::bigint as n_items,
  sha256(coalesce(array_to_string(items, ','), '')) as items_sha256, coalesce(hit.n, 0) > 0 as contaminated
from d left join hit using (doc_id) left join it using (doc_id)
"""

NEAR_DUPLICATES = r"""
with recursive d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                     '[^\x20\x09-\x0D]+') as w from documents),
s as (select distinct doc_id, g from (select doc_id, unnest(case when len(w) = 0 then [] when len(w) = 1 then [w[1]]
      else list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i+1]) end) as g from d)),
n as (select doc_id, count(*) as n from s group by 1),
pair as (select a.doc_id as a, b.doc_id as b, count(*) as common from s a join s b on a.g = b.g and a.doc_id <> b.doc_id group by 1, 2),
link as (select a, b from pair join n x on a = x.doc_id join n y on b = y.doc_id where 100 * common >= 80 * (x.n + y.n - common)),
reach(a, b) as (select a, b from link union select reach.a, link.b from reach join link on reach.b = link.a),
comp as (select a, min(b) as b from reach group by 1)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, least(d.doc_id, coalesce(comp.b, d.doc_id)) as component_id,
  d.doc_id = least(d.doc_id, coalesce(comp.b, d.doc_id)) as kept
from d left join n using (doc_id) left join comp on comp.a = d.doc_id
"""

REPEATED_PASSAGES = r"""
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
win as (select doc_id, i, array_to_string(w[i:i+19], ' ') as g from
        (select doc_id, w, unnest(range(1, greatest(len(w) - 18, 1))) as i from d)),
ranked as (select doc_id, i, row_number() over (partition by g order by doc_id, i) as r from win),
gone as (select doc_id, list(distinct p) as p from (select doc_id, unnest(range(i, i + 20)) as p from ranked where r > 1) group by 1),
kept as (select d.doc_id, w, coalesce(p, []) as p from d left join gone using (doc_id)),
pos as (select doc_id, i, w[i] as x from (select doc_id, w, unnest(range(1, len(w) + 1)) as i from kept)),
rest as (select pos.doc_id, string_agg(x, ' ' order by i) as t from pos
         left join (select doc_id, unnest(p) as i, true as g from gone) q using (doc_id, i) where g is null group by 1)
select kept.doc_id, len(w)::bigint as n_words, len(p)::bigint as n_removed, sha256(coalesce(rest.t, '')) as kept_sha256
from kept left join rest using (doc_id)
"""

WARC = r"""
with p as (select page_id, coalesce(html, '') as h from pages),
g as (select h, min(page_id) as first from p group by 1),
x as (select page_id, h, first, upper(sha1(h)) as hex from p join g using (h))
select page_id, octet_length(encode(h))::bigint as payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(hex, 1 + 5 * (i // 4), 5))::bigint >> (15 - 5 * (i % 4))) & 31)::int, 1)), '') as payload_digest,
  case when page_id = first then 'response' else 'revisit' end as record_type,
  case when page_id = first then null else first end as refers_to
from x
"""

_ROUNDS, _CLUSTERS = 10, 8


def _assign(r: int) -> str:
    return f"""a{r} as materialized (select k, vec_id, v, c, d from (select k, vec_id, kept.v, c,
  list_sum(list_transform(range(1, 65), lambda i: (kept.v[i] - m.v[i]) * (kept.v[i] - m.v[i])))::bigint as d
  from kept, m{r} m) qualify row_number() over (partition by k order by d, c) = 1)"""


def _means(r: int) -> str:
    return f"""s{r} as (select c, i, sum(x) as s, count(*) as n from (select c, unnest(range(1, 65)) as i, unnest(v) as x from a{r - 1}) group by all),
u{r} as (select c, list((s - ((s % n) + n) % n) // n order by i)::bigint[] as v from s{r} group by 1),
m{r} as materialized (select c, coalesce(u{r}.v, m{r - 1}.v) as v from m{r - 1} left join u{r} using (c))"""


CENTROIDS = f"""
with kept as materialized (select row_number() over () as k, vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as v from embeddings
  where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = 64),
m0 as materialized (select row_number() over (order by sha256('3:' || vec_id), v) - 1 as c, v from kept qualify c < {_CLUSTERS}),
{_assign(0)},
{",".join(f"""
{_means(r)},
{_assign(r)}""" for r in range(1, _ROUNDS + 1))}
select vec_id, c::integer as cluster, d as distance, sum(d) over (partition by c)::bigint as cluster_inertia, sum(d) over ()::bigint as inertia,
  sha256(array_to_string(m.v, ',')) as centroid_sha256
from a{_ROUNDS} a join m{_ROUNDS} m using (c)
"""

#: The checksum is folded over the digits of the id: a byte is added, then eight steps.
PREFIX_TRIE = r"""
with t as (select conv_id, row_number() over (partition by conv_id order by turn nulls first) as i,
  coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null),
c as (select conv_id, conv_id - conv_id % 20 as family, list_reduce(
  list_prepend(4294967295, flatten(list_transform(range(1, length(conv_id::varchar) + 1), lambda p: list_concat([ascii(substr(conv_id::varchar, p, 1))], [-1, -1, -1, -1, -1, -1, -1, -1])))),
  lambda a, x: case when x >= 0 then xor(a, x) else xor(a >> 1, 3988292384 * (a & 1)) end) as folded from (select distinct conv_id from t)),
h as (select conv_id, family, xor(folded, 4294967295) % 4 as h from c),
r as (select h.conv_id, t.i, role, text from h join t on t.conv_id = h.family and t.i <= h.h
      union all select h.conv_id, t.i, role, text from h join t on t.conv_id = h.conv_id and t.i > h.h),
p as (select conv_id, row_number() over w as d, array_to_string(list(sha256(length(role) || ':' || role || text)) over w, '') as prefix,
  len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) as words from r window w as (partition by conv_id order by i)),
m as (select conv_id, d, prefix, words from p union all select conv_id, 0, '', 0 from h),
last as (select conv_id, max(d) as d from m group by 1),
n as (select m.d, prefix, min(conv_id) as conv_id, count(*) as n, any_value(words) as words,
  sha256(coalesce(string_agg(case when m.d = last.d then conv_id::varchar end, ',' order by conv_id), '')) as ends
  from m join last using (conv_id) group by m.d, prefix),
k as (select n.d, n.prefix, count(x.d) as kids from n left join n x on x.d = n.d + 1 and x.prefix[:64 * n.d] = n.prefix group by all),
sub as (select a.d, a.prefix, sum((x.n - 1) * x.words) as saved, count(*) filter (k.kids = 0) as leaves
  from n x join k on k.d = x.d and k.prefix = x.prefix join n a on a.d <= x.d and a.prefix = x.prefix[:64 * a.d] group by all)
select n.conv_id, n.d::bigint as depth, up.conv_id as parent_conv_id, n.n::bigint as n_convs, k.kids::bigint as n_children,
  leaves::bigint as n_leaves, saved::bigint as saved_tokens, n.ends as ends_sha256
from n join k on k.d = n.d and k.prefix = n.prefix join sub on sub.d = n.d and sub.prefix = n.prefix
left join n up on up.d = n.d - 1 and up.prefix = n.prefix[:64 * (n.d - 1)] and n.d > 0
"""
