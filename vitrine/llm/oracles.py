"""SQL for the operators that SQL can express, over the same tables."""

from __future__ import annotations

#: Words of a text column, as the decontamination counts them; `lower` there would touch more than A-Z.
_WORDS = r"regexp_extract_all(translate({t}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLES: dict[str, str] = {}

ORACLES["op2_benchmark_decontamination"] = rf"""
with items as (
  select cast(item_id as varchar) as item, {_WORDS.format(t="text")} as w from benchmark where item_id is not null),
windows as (
  select distinct item, least(len(w), 10) as size,
    unnest(list_transform(range(0, len(w) - least(len(w), 10) + 1), lambda i: array_to_string(w[i + 1:i + least(len(w), 10)], ' '))) as phrase
  from items where len(w) > 0),
docs as (select doc_id, coalesce({_WORDS.format(t="text")}, []) as w from documents),
grams as (
  select doc_id, size, unnest(range(0, len(w) - size + 1)) as pos,
    unnest(list_transform(range(0, len(w) - size + 1), lambda i: array_to_string(w[i + 1:i + size], ' '))) as phrase
  from docs, (select distinct size from windows) where len(w) >= size),
hits as (select doc_id, pos, g.size, item from grams g join windows x on g.phrase = x.phrase and g.size = x.size),
per_word as (select distinct doc_id, unnest(range(pos, pos + size)) as word from hits),
n_hit as (select doc_id, count(*) as n from per_word group by doc_id),
n_items as (select doc_id, count(distinct item) as n, string_agg(distinct item, ',' order by item) as ids from hits group by doc_id)
select d.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(h.n, 0) as bigint) as n_hit,
  cast(coalesce(i.n, 0) as bigint) as n_items, sha256(coalesce(i.ids, '')) as items_sha256, coalesce(h.n, 0) > 0 as contaminated
from docs d left join n_hit h using (doc_id) left join n_items i using (doc_id)
"""

#: Shares fill up to a level: a source is full when three times its size is less than its share of what is left.
_MIX = r"""
with recursive docs as (
  select *, cast(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as bigint) as size,
    cast(('0x' || substr(md5('mix-1|' || coalesce(cast(doc_id as varchar), 'null') || '|' || md5(coalesce(text, ''))), 1, 13)) as bigint)
      / 4503599627370496.0::double as draw
  from documents),
sources as (select source, cast(sum(size) as bigint) as source_size from docs group by source),
weighed as (select *, 1 + (row_number() over (order by source is null, source) - 1) % 3 as weight from sources),
filled as (
  select 0 as step, cast(sum(source_size) as bigint) as rest, cast(sum(weight) as bigint) as open, [] :: varchar[] as full_ from weighed
  union all
  select step + 1, rest - cast(coalesce(s, 0) as bigint), open - cast(coalesce(w, 0) as bigint), list_concat(full_, ids)
  from (select f.step, f.rest, f.open, f.full_,
      (select sum(3 * source_size) from weighed where not list_contains(f.full_, coalesce(source, '<null>')) and 3 * source_size * f.open <= f.rest * weight) as s,
      (select sum(weight) from weighed where not list_contains(f.full_, coalesce(source, '<null>')) and 3 * source_size * f.open <= f.rest * weight) as w,
      (select list(coalesce(source, '<null>')) from weighed where not list_contains(f.full_, coalesce(source, '<null>')) and 3 * source_size * f.open <= f.rest * weight) as ids
    from filled f) where ids is not null),
level as (select * from filled order by step desc limit 1),
shares as (
  select source, source_size, case when list_contains(full_, coalesce(source, '<null>')) then cast(3 * source_size as double)
    else cast(rest * weight as double) / open end as target
  from weighed, level),
planned as (
  select d.*, s.source_size, s.target, case when s.source_size > 0 then s.target / s.source_size else 0.0 end as rate
  from docs d join shares s on d.source is not distinct from s.source),
mixed as (select *, cast(floor(rate) as bigint) + case when draw < rate - floor(rate) then 1 else 0 end as times from planned)
"""

ORACLES["op8_source_mixing"] = _MIX + "select doc_id, size, source_size, target, size * times as taken from mixed"

#: Base32 has 5 bits a letter: 5 hexadecimal digits make 4 letters.
_BASE32 = ("array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + cast("
           "(cast('0x' || substr({h}, 1 + 5 * cast(floor(i / 4) as integer), 5) as bigint) >> (15 - 5 * (i % 4))) & 31 as integer), 1)), '')")

ORACLES["op1_warc_transactions"] = f"""
with p as (select distinct page_id, url, coalesce(html, '') as body from pages),
d as (select *, sha1(body) as h, min(page_id) over (partition by body) as first from p)
select page_id, strlen(body) as payload_bytes, {_BASE32.format(h="h")} as payload_digest,
  case when page_id is not distinct from first then 'response' else 'revisit' end as record_type,
  case when page_id is distinct from first then first end as refers_to
from d
"""

#: CRC-32 of a text's bytes by its table of 256 remainders; near words share a deletion: at one place (a letter replaced), or
#: one is the other's deletion (a letter inserted).
ORACLES["op12_spelling_variants"] = r"""
with recursive remainders as (
  select list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda c, k: case when c % 2 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as t),
runs as (
  select coalesce(cast(doc_id as varchar), 'null') as id,
    translate(unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run
  from documents),
occurring as (select id, run, count(*) as times, hex(id || ':' || run) as digits from runs group by all),
hashed as (
  select run, times, xor(4294967295, list_reduce(list_prepend(4294967295,
    list_transform(range(1, len(digits), 2), lambda i: cast('0x' || substr(digits, i, 2) as bigint))),
    lambda c, b: xor(c >> 8, t[xor(c, b) % 256 + 1]))) as h
  from occurring, remainders),
words as (
  select case when h % 199 = 0 then substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) else run end as word,
    cast(sum(times) as bigint) as n
  from hashed group by 1 having sum(times) >= 5 and length(word) >= 6),
without as (select word, n, unnest(range(1, length(word) + 1)) as i, substr(word, 1, i - 1) || substr(word, i + 1) as rest from words),
near as (
  select a.word, b.word as other, b.n from without a join without b on a.rest = b.rest and a.i = b.i and a.word <> b.word
  union select a.word, b.word, b.n from without a join words b on a.rest = b.word
  union select b.word, a.word, a.n from without a join words b on a.rest = b.word),
best as (select word, count(*) as n_near, first(other order by n desc, other) as form, max(n) as form_n from near group by word),
forms as (
  select w.word, w.n, cast(coalesce(n_near, 0) as bigint) as n_near, case when form_n >= 5 * w.n then form end as form,
    case when form_n >= 5 * w.n then form_n end as form_n
  from words w left join best b on w.word = b.word),
paths as (
  select word, word as root, form as ahead from forms
  union all select p.word, p.ahead, f.form from paths p join forms f on f.word = p.ahead)
select f.word, f.form, p.root, f.n, f.n_near, f.form_n from forms f join paths p on p.word = f.word and p.ahead is null
"""
