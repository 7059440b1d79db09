"""The same questions in DuckDB's SQL, where SQL can express them."""

_WARC = """
with p as (
  select page_id, coalesce(html, '') as html, cast(strlen(coalesce(html, '')) as bigint) as n
  from pages
), latest as (
  select html, max(page_id) as response, count(*) as copies from p where n >= 1000 group by html
)
select p.page_id, p.n as payload_bytes, sha1(p.html) as payload_digest,
  case when copies > 1 and response is distinct from p.page_id then 'revisit'
    else 'response' end as record_type,
  case when copies > 1 and response is distinct from p.page_id then response end as refers_to
from p left join latest on latest.html = p.html and p.n >= 1000
"""

# The windows of an item are those of ten words, or all of its words if it has fewer.
_DECONTAMINATE = """
with d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from documents
), b as (
  select cast(item_id as varchar) as item, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from benchmark
), g as (
  select distinct item, least(len(w), 10) as size,
    array_to_string(w[i : i + least(len(w), 10) - 1], ' ') as gram
  from (select *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i from b where len(w) > 0)
), sizes as (
  select distinct size from g
), dg as (
  select doc_id, size, i, array_to_string(w[i : i + size - 1], ' ') as gram
  from (select doc_id, w, size, unnest(range(1, len(w) - size + 2)) as i from d, sizes
    where len(w) >= size)
), hits as (
  select doc_id, i, g.size, item from dg join g on g.gram = dg.gram and g.size = dg.size
), hit_words as (
  select doc_id, count(distinct p) as n_hit from (
    select doc_id, unnest(range(i, i + size)) as p from hits) group by doc_id
), named as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as ids
  from (select distinct doc_id, item from hits) group by doc_id
)
select d.doc_id, cast(len(w) as bigint) as n_words,
  cast(coalesce(n_hit, 0) as bigint) as n_hit, cast(coalesce(n_items, 0) as bigint) as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join hit_words using (doc_id) left join named using (doc_id)
"""

_SUBSTRINGS = """
with d as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w
  from documents
), windows as (
  select doc_id, i, md5(array_to_string(w[i : i + 49], ' ')) as gram
  from (select doc_id, w, unnest(range(1, len(w) - 48)) as i from d where len(w) >= 50)
), firsts as (
  select gram, min(coalesce(doc_id, 9223372036854775807)) as first from windows group by gram
), gone as (
  select distinct doc_id, unnest(range(i, i + 50)) as p
  from windows join firsts using (gram) where coalesce(doc_id, 9223372036854775807) > first
), kept as (
  select d.doc_id, string_agg(word, ' ' order by p) as kept, count(*) as n
  from (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as p from d) d
  anti join gone on gone.doc_id = d.doc_id and gone.p = d.p group by d.doc_id
)
select d.doc_id, cast(len(w) as bigint) as n_words,
  cast(len(w) - coalesce(n, 0) as bigint) as n_removed,
  sha256(coalesce(kept, '')) as kept_sha256
from d left join kept using (doc_id)
"""

_CHAT = """
with t as (
  select conv_id, cast(floor(turn / 256.0) as bigint) as part, turn,
    coalesce(role, 'unknown') as role, coalesce(text, '') as text from conversations
), s as (
  select distinct conv_id, role as view from t where role <> 'system'
), r as (
  select t.conv_id, view, part, turn, role, text,
    case when role = 'system' then '<|system|>' when role = view then '<|assistant|>'
      else '<|user ' || role || '|>' end || chr(10) as head, text || '<|end|>' as body
  from t join s on s.conv_id is not distinct from t.conv_id
), e as (
  select *, sum(length(head) + length(body) + 1) over (partition by conv_id, view, part
      order by turn nulls first, role, text rows unbounded preceding) - 1 as done
  from r
), p as (
  select conv_id, view, part, count(*) as n_turns,
    sum(length(head) + length(body) + 1) as size,
    string_agg(head || body || chr(10), '' order by turn nulls first, role, text) as text,
    coalesce(string_agg(case when role = view then
      cast(done - length(body) as bigint) || '-' || cast(done as bigint) end, ','
      order by turn nulls first, role, text), '') as masks
  from e group by conv_id, view, part
)
select conv_id, view, part, n_turns, cast(coalesce(sum(size) over (
  partition by conv_id, view order by part nulls first
  rows between unbounded preceding and 1 preceding), 0) as bigint) as start, text, masks
from p
"""

_COLLOCATIONS = """
with p as (
  select coalesce(lang, 'und') as lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\\x0A-\\x0D]')) as piece from documents
), w as materialized (
  select lang, regexp_extract_all(piece, '[^\\x20\\x09]+') as w from p
), f as materialized (
  select lang, size, phrase, count(*) as a from (
    select lang, 1 as size, unnest(w) as phrase from w
    union all
    select lang, 2, array_to_string(w[i : i + 1], ' ')
    from (select lang, w, unnest(range(1, len(w))) as i from w)
    union all
    select lang, 3, array_to_string(w[i : i + 2], ' ')
    from (select lang, w, unnest(range(1, len(w) - 1)) as i from w))
  group by all
), totals as (
  select lang, sum(a) as n from f where size = 1 group by lang
), c as materialized (
  select lang, size, phrase, a, string_split(phrase, ' ') as w from f where size > 1 and a >= 10
), cuts as materialized (
  select *, lang || chr(0) || array_to_string(w[:k], ' ') as first,
    lang || chr(0) || array_to_string(w[k + 1 :], ' ') as rest
  from (select *, unnest(range(1, size)) as k from c)
), sides as materialized (
  select lang || chr(0) || phrase as key, a from f where a >= 10
), split as (
  select lang, phrase, cuts.a, k, x.a as l, y.a as r,
    (cast(1000000 as hugeint) * cuts.a * cuts.a) // (cast(x.a as hugeint) * y.a) as score
  from cuts join sides x on x.key = first join sides y on y.key = rest
), scored as (
  select * from split qualify row_number() over (partition by lang, phrase order by score, k) = 1
), longer as (
  select lang, phrase, max(a) as a from (
    select lang, a, unnest([array_to_string(w[:2], ' '), array_to_string(w[2:], ' ')]) as phrase
    from c where size = 3) group by all
), ranked as (
  select scored.*, row_number() over (
    partition by scored.lang order by score desc, scored.a desc, scored.phrase) as rank
  from scored left join longer on longer.lang = scored.lang and longer.phrase = scored.phrase
  where longer.a is null or 100 * longer.a < 50 * scored.a
)
select lang, rank, phrase, a, l, r, cast(n as bigint) as n, cast(score as bigint) as score
from ranked join totals using (lang) where rank <= 2000
"""

SQL = {
    "op12_collocations": _COLLOCATIONS,
    "op2_warc": _WARC,
    "op3_substring_dedup": _SUBSTRINGS,
    "op5_chat_views": _CHAT,
    "op4_benchmark_decontamination": _DECONTAMINATE,
}
