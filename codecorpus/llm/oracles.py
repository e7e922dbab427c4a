"""DuckDB SQL for the queries that SQL can express."""

SQL: dict[str, str] = {
    # all 1- to 3-word phrases of each piece counted, cuts by the lowest exact score, hidden pairs dropped
    "op12_collocations": r"""
with d as (
  select coalesce(lang, 'und') as lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t
  from documents
), p as (select lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) as piece from d
), w as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as ws from p
), pos as (select lang, ws, unnest(range(1, len(ws) + 1)) as i from w where len(ws) > 0
), g as (
  select lang, 1 as n_words, ws[i] as phrase from pos
  union all select lang, 2, ws[i] || ' ' || ws[i + 1] from pos where i + 1 <= len(ws)
  union all select lang, 3, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] from pos where i + 2 <= len(ws)
), cnt as (select lang, n_words, phrase, count(*) as f from g group by all
), nn as (select lang, sum(f) as n from cnt where n_words = 1 group by lang
), cand as (select lang, phrase, n_words, f as a, string_split(phrase, ' ') as w from cnt where n_words >= 2 and f >= 10
), cuts as (
  select c.lang, c.phrase, c.a, k.k, array_to_string(c.w[1:k.k], ' ') as lp, array_to_string(c.w[k.k + 1:], ' ') as rp
  from cand c, (values (1), (2)) k(k) where k.k < c.n_words
), sc as (
  select cuts.lang, cuts.phrase, cuts.a, cuts.k, l.f as l, r.f as r,
    cast((cast(cuts.a as hugeint) * cuts.a * 1000000) // (cast(l.f as hugeint) * r.f) as bigint) as score
  from cuts join cnt l on l.lang = cuts.lang and l.phrase = cuts.lp join cnt r on r.lang = cuts.lang and r.phrase = cuts.rp
), best as (select * from sc qualify row_number() over (partition by lang, phrase order by score, k) = 1
), hold as (
  select lang, array_to_string(w[1:2], ' ') as phrase, a from cand where n_words = 3
  union all select lang, array_to_string(w[2:3], ' '), a from cand where n_words = 3
), kept as (
  select * from best b where not exists (select 1 from hold h where h.lang = b.lang and h.phrase = b.phrase and 100 * h.a >= 50 * b.a)
), ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
select ranked.lang, cast(rank as bigint) as rank, phrase, cast(a as bigint) as a, cast(l as bigint) as l, cast(r as bigint) as r,
  cast(n as bigint) as n, score
from ranked join nn on nn.lang = ranked.lang where rank <= 2000
""",
    # windows of ten words as lists, joined by value; a short item is one window
    "op8_decontamination": r"""
with words as (
  select doc_id, row_number() over () as row_id, text,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents
), items as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark
), sized as (select item_id, w, least(10, len(w)) as n from items where len(w) > 0
), wanted as (
  select distinct item_id, n, array_to_string(w[i:i + n - 1], ' ') as win
  from (select item_id, w, n, unnest(range(1, len(w) - n + 2)) as i from sized)
), lengths as (select distinct n from wanted
), spans as (
  select row_id, w, n, unnest(range(1, len(w) - n + 2)) as i from words, lengths where len(w) >= n
), found as (
  select s.row_id, s.i, s.n, k.item_id
  from (select row_id, i, n, array_to_string(w[i:i + n - 1], ' ') as win from spans) s join wanted k on s.win = k.win and s.n = k.n
), hit as (
  select row_id, count(distinct p) as n_hit from (select row_id, unnest(range(i, i + n)) as p from found) group by row_id
), named as (
  select row_id, count(*) as n_items, string_agg(item, ',' order by item) as ids
  from (select distinct row_id, coalesce(cast(item_id as varchar), '') as item from found) group by row_id
)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from words left join hit using (row_id) left join named using (row_id)
""",
    # all combinations of up to three tokens of the labelled pages, counted
    "op6_url_rules": r"""
with parts as (
  select page_id, url, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path from pages
), rules(kind, dom, start) as (
  values ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), fits as (
  select row_number() over () as row_id, * from parts
), best as (
  select row_id, arg_max(dom || start, length(dom || start)) as rule, arg_max(kind, length(dom || start)) as written
  from fits, rules where (host = dom or ends_with(host, '.' || dom)) and starts_with(path, start) group by row_id
), rows as (
  select f.*, rule, written, list_sort(list_distinct(list_concat(
    list_transform(list_filter(string_split(host, '.'), lambda x: x != ''), lambda x: 'h:' || x),
    list_transform(list_filter(string_split(path, '/'), lambda x: x != ''), lambda x: 'p:' || regexp_replace(translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9]+', '#', 'g')),
    list_transform(list_filter(string_split(coalesce(regexp_extract(url, '^[^?#]*\?([^#]*)', 1), ''), '&'), lambda x: x != ''), lambda x: 'q:' || regexp_extract(x, '^([^=]*)', 1))
  ))) as tokens
  from fits f left join best using (row_id)
), tok as (select row_id, written, unnest(tokens) as t from rows
), sets as (
  select row_id, written, [t] as s from tok
  union all select a.row_id, a.written, [a.t, b.t] from tok a join tok b on a.row_id = b.row_id and a.t < b.t
  union all select a.row_id, a.written, [a.t, b.t, c.t] from tok a join tok b on a.row_id = b.row_id and a.t < b.t join tok c on a.row_id = c.row_id and b.t < c.t
), total as (select count(*) as n from rows where written is not null and (len(tokens) > 0 or written = 'block')
), mined as (
  select s, count(*) as n, count(*) filter (where written = 'block') as blocked from sets where written is not null group by s
), good as (
  select s from mined, total where blocked >= ceil(0.01 * total.n) and blocked::double / mined.n >= 0.9
), minimal as (
  select array_to_string(s, ' ') as name, s from good g
  where not exists (select 1 from good h where len(h.s) < len(g.s) and list_has_all(g.s, h.s))
), found as (
  select row_id, min(name) as mined_rule from sets join minimal using (s) where written is null group by row_id
)
select page_id, host, path, rule, coalesce(written, case when mined_rule is not null then 'block' else 'allow' end) as verdict, mined_rule
from rows left join found using (row_id)
""",
    # CRC-32 by its bytewise table; cuts at equal targets of one running sum
    "op4_sharding": r"""
with steps as (
  select list(v order by i) as t from (select i, list_reduce(range(8),
    lambda c, k: case when c % 2 = 1 then xor(c >> 1, 3988292384::bigint) else c >> 1 end, i::bigint) as v from range(256) r(i))
), bytes as (
  select doc_id, coalesce(text, '') as text,
    list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::bigint) as b from documents
), base as (
  select doc_id, (strlen(text) + 16)::bigint as size, ('0x' || left(sha256(text), 15))::bigint as digest,
    xor(list_reduce(b, lambda c, x: xor(c >> 8, t[xor(c & 255, x) + 1]), 4294967295::bigint), 4294967295::bigint) as crc from bytes, steps
), placed as (
  select *, (sum(size) over o - size)::bigint as start, row_number() over o - 1 as rank, (sum(size) over ())::bigint as total from base
  window o as (order by digest, doc_id nulls first, size, crc rows between unbounded preceding and current row)
), crossed as (
  select digest, start, rank, size, total, unnest(range(start * 40 // total + 1, (start + size) * 40 // total + 1)) as shard from placed
), same as (
  select digest, min(start) as g_start, min(rank) as g_rank, sum(size)::bigint as g_size, count(*) as g_rows from placed group by digest
), chosen as (
  select shard, total, g_size * 40 <= 0.02::double * total as whole, case when whole then g_start else start end as s,
    case when whole then g_rank else rank end as r, case when whole then g_size else size end as n, case when whole then g_rows else 1 end as k
  from crossed join same using (digest) where shard < 40
), cuts as (
  select case when 2 * (shard * total - s * 40) >= n * 40 then s + n else s end as cut,
    case when 2 * (shard * total - s * 40) >= n * 40 then r + k else r end as cut_rank from chosen
), found as (
  select doc_id, size, crc, rank, (select count(*) from cuts where cut <= start) as shard, (select coalesce(max(cut_rank), 0) from cuts where cut <= start) as first from placed
)
select doc_id, size, crc as text_crc32, 'bytes' as law, shard::int as shard, (rank - first)::bigint as slot, null::int as grown_shard from found
""",
}
