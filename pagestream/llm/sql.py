"""DuckDB SQL of the operators that SQL can express, written apart from their Spark code."""

from __future__ import annotations

from . import linededup, mix, quality

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACED = r"[^\x20\x09-\x0D]+"
ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

MIX = rf"""
with sized as (select doc_id, source, coalesce(len(regexp_extract_all(text, '{SPACED}')), 0)::bigint as size from documents),
stats as (select source, sum(size)::bigint as source_size, [5.0, 2.0, 1.0][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int]::double as weight from sized group by source),
capped as (select *, {mix.MAX_REPEATS} * source_size::double as cap from stats),
levels as (select *, (sum(source_size) over () * {mix.SHARE} - (sum(cap) over (order by cap / weight, source nulls last rows unbounded preceding) - cap)) / sum(weight) over (order by cap / weight, source nulls last rows between current row and unbounded following) as level from capped),
chosen as (select level as water from levels where level <= cap / weight order by cap / weight, level limit 1),
targets as (select source, source_size, least(cap, coalesce((select water from chosen) * weight, cap)) as target from levels),
keyed as (select s.*, t.source_size, t.target, round(t.target)::bigint as budget, substr(md5('{mix.SEED}|' || coalesce(doc_id::varchar, 'null') || '|' || size::varchar), 1, 13) as k from sized s join targets t on s.source is not distinct from t.source),
placed as (select *, sum(size) over (partition by source order by k, doc_id, size rows unbounded preceding)::bigint - size as before, case when source_size > 0 then budget // source_size else 0 end as whole from keyed)
select doc_id, size, source_size, round(target, 6) as target, (whole * size + greatest(0, least(size, budget - whole * source_size - before)))::bigint as taken from placed
"""

CONTAMINATION = rf"""
with b as (select item_id::varchar as item, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{ALNUM}') as w from benchmark where text is not null),
windows as (select distinct item, least(10, len(w)) as n, array_to_string(w[p:p + least(10, len(w)) - 1], ' ') as win from (select item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as p from b where len(w) > 0)),
d as (select doc_id, row_number() over () as rid, coalesce(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{ALNUM}'), []) as w from documents),
places as (select rid, w, n, unnest(range(1, len(w) - n + 2)) as p from d, (select distinct n from windows) where len(w) >= n),
found as (select rid, p, k.n, item from places q join windows k on q.n = k.n and array_to_string(q.w[q.p:q.p + q.n - 1], ' ') = k.win),
words as (select rid, count(distinct x) as n_hit from (select rid, unnest(range(p, p + n)) as x from found) group by rid),
items as (select rid, count(distinct item) as n_items, string_agg(distinct item, ',' order by item) as ids from found group by rid)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join words using (rid) left join items using (rid)
"""

JACCARD = rf"""
with recursive w as (select doc_id, coalesce(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{SPACED}'), []) as w from documents),
sets as (select doc_id, case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')] else list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) end as s from w),
sized as (select doc_id, s, len(s) as n from sets),
one as (select doc_id, n, unnest(s) as g from sized),
shared as (select a.doc_id as a, b.doc_id as b, any_value(a.n) as na, any_value(b.n) as nb, count(*) as c from one a join one b on a.g = b.g and a.doc_id < b.doc_id and 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n) group by 1, 2),
links as (select a, b from shared where 100 * c >= 90 * (na + nb - c)),
both_ways as (select a, b from links union all select b, a from links),
reach(v, r) as (select doc_id, doc_id from sized union select reach.v, e.b from reach join both_ways e on e.a = reach.r)
select s.doc_id, s.n::bigint as n_shingles, m.component_id from sized s join (select v, min(r) as component_id from reach group by v) m on m.v = s.doc_id
"""

_RATIO_SQL = {
    "symbol_ratio": ("n_symbols", "n_words"),
    "mark_ratio": ("n_marks", "n_words"),
    "upper_ratio": ("n_upper", "n_letters"),
    "repeat_ratio": ("n_repeat_words", "n_words"),
    "dup_line_ratio": ("n_dup_lines", "n_lines"),
    "word_length": ("word_chars", "n_words"),
}
_LONG = " union all ".join(f"select rid, lang, source, '{r}' as ratio, case when {b} > 0 then {a}::double / {b} else 0.0 end as value, {quality.SLACK[r]} as slack from counts" for r, (a, b) in _RATIO_SQL.items())


def _fence(by: str) -> str:
    keys = f"{by}, " if by else ""
    return f"""(select {keys}ratio, q3 + {quality.SPREAD} * (q3 - q1) + slack as fence, docs from (select {keys}ratio, any_value(slack) as slack, min(case when upto >= 0.25 * docs then v end) as q1, min(case when upto >= 0.75 * docs then v end) as q3, any_value(docs) as docs
 from (select {keys}ratio, slack, case when bucket > -1000000 then pow({quality.GAMMA}, bucket) * {2 / (1 + quality.GAMMA)!r} else 0.0 end as v, sum(n) over (partition by {keys}ratio order by bucket rows unbounded preceding) as upto, sum(n) over (partition by {keys}ratio) as docs
 from (select {keys}ratio, slack, bucket, count(*) as n from sketched group by all)) group by {keys}ratio))"""


QUALITY = rf"""
with t as (select row_number() over () as rid, doc_id, lang, source, coalesce(text, '') as text from documents),
w as (select *, regexp_extract_all(text, '{SPACED}') as w, string_split(text, chr(10)) as ls from t),
win as (select rid, p, array_to_string(w[p:p + 4], ' ') as g from (select rid, w, unnest(range(1, len(w) - 3)) as p from w where len(w) >= 5)),
twice as (select rid, g from win group by all having count(*) > 1),
rep as (select rid, count(distinct x) as n_repeat_words from (select rid, unnest(range(p, p + 5)) as x from win join twice using (rid, g)) group by rid),
lines as (select rid, count(*) as n_lines, count(*) - count(distinct l) as n_dup_lines from (select rid, unnest(ls) as l from w) where regexp_matches(l, '{SPACED}') group by rid),
counts as (select w.*, len(w)::bigint as n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint as word_chars, (length(text) - length(translate(text, '#*$%&|<>', '')))::bigint as n_symbols,
  coalesce(n_dup_lines, 0)::bigint as n_dup_lines, coalesce(n_repeat_words, 0)::bigint as n_repeat_words, coalesce(n_lines, 0) as n_lines,
  length(text) - length(translate(text, '!?#*$%&|<>=+~^_{{}}[]\/@', '')) as n_marks, length(text) - length(translate(text, '{UPPER}', '')) as n_upper, length(text) - length(translate(text, '{UPPER}{LOWER}', '')) as n_letters
  from w left join rep using (rid) left join lines using (rid)),
long as ({_LONG}),
sketched as (select *, case when value > 1e-6 then ceil(ln(value) / ln({quality.GAMMA}::double))::int else -1000000 end as bucket from long),
own as {_fence("lang, source")}, by_lang as {_fence("lang")}, whole as {_fence("")},
limits as (select o.lang, o.source, o.ratio, case when o.docs >= {quality.LEAST} then o.fence when l.docs >= {quality.LEAST} then l.fence else a.fence end as fence from own o join by_lang l on o.lang is not distinct from l.lang and o.ratio = l.ratio join whole a on a.ratio = o.ratio),
passed as (select x.rid, bool_and(x.value <= f.fence) as ok from long x join limits f on x.lang is not distinct from f.lang and x.source is not distinct from f.source and x.ratio = f.ratio group by x.rid)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed, not (n_words < 10 or 100 * n_repeat_words > 20 * n_words) and ok as kept
from counts join passed using (rid)
"""

ALL = {"op1_mix_sources": MIX, "op2_decontaminate": CONTAMINATION, "op6_jaccard": JACCARD, "op7_line_dedup": linededup.LINES_SQL, "op9_quality": QUALITY}
