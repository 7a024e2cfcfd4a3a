"""The quality rules in plain SQL, step by step, as a check."""

from premisa.llm.quality_rules import FEATURES, LEAST_DOCUMENTS, RULES, SYMBOLS

_SPLIT = r"[\x20\x09-\x0D]+"
_SHARES = {
    "symbols": ("n_symbols", "n_words"), "word_length": ("word_chars", "n_words"), "dup_lines": ("n_dup_lines", "n_lines"),
    "repeats": ("n_repeat_words", "n_words"), "capitals": ("n_capitals", "word_chars"), "shouts": ("n_shouts", "n_words"),
}
_FEATURES = ", ".join(f"{a} * 1000 // greatest({b}, 1) as {f}" for f, (a, b) in _SHARES.items())
_LONG = " union all ".join(f"select lang, source, '{f}' as feature, {f} as v from passed" for f in FEATURES)
_CUTS = ", ".join(
    f"max(case when feature = '{f}' then " + (f"q3 + 3 * greatest(q3 - q1, {t})" if side > 0 else f"q1 - 3 * greatest(q3 - q1, {t})") + f" end) as cut{k}"
    for k, (f, side, t) in enumerate(RULES)
)
_TESTS = " and ".join(f"coalesce({f} {'<=' if side > 0 else '>='} cut{k}, true)" for k, (f, side, _) in enumerate(RULES))

QUALITY = rf"""
with d as (select row_number() over () as rid, doc_id, lang, source, coalesce(text, '') as t from documents),
w as (select rid, list_filter(string_split_regex(t, '{_SPLIT}'), lambda x: x <> '') as w from d),
grams as (
    select rid, p, w[p] || ' ' || w[p + 1] || ' ' || w[p + 2] as g
    from (select rid, w, unnest(range(1, len(w) - 1)) as p from w)
),
again as (select rid, p from (select *, count(*) over (partition by rid, g) as c from grams) where c > 1),
repeated as (select rid, count(distinct q) as n from (select rid, unnest([p, p + 1, p + 2]) as q from again) group by rid),
lines as (
    select rid, count(*) as n, count(*) - count(distinct line) as dup
    from (select rid, unnest(string_split(t, chr(10))) as line from d) where regexp_matches(line, '[^\x20\x09-\x0D]') group by rid
),
counts as (
    select d.*, len(w.w) as n_words, length(regexp_replace(t, '{_SPLIT}', '', 'g')) as word_chars,
        length(regexp_replace(t, '[^{SYMBOLS}]', '', 'g')) as n_symbols, coalesce(lines.dup, 0) as n_dup_lines,
        coalesce(repeated.n, 0) as n_repeat_words, coalesce(lines.n, 0) as n_lines,
        length(regexp_replace(t, '[^\p{{Lu}}]', '', 'g')) as n_capitals, length(regexp_replace(t, '[^!?]', '', 'g')) as n_shouts
    from d join w using (rid) left join repeated using (rid) left join lines using (rid)
),
judged as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed, {_FEATURES} from counts),
passed as (select * from judged where not base_failed),
long as ({_LONG}),
exponents as (select *, length(bin(v)) - 6 as e from long),
buckets as (select lang, source, feature, case when v < 64 then v else (v >> e) << e end as value from exponents),
sketch as (select lang, source, feature, value, count(*) as n from buckets group by all),
totals as (select lang, source, sum(n) as docs from sketch where feature = 'symbols' group by all),
levels as (
    select lang, source, case when docs >= {LEAST_DOCUMENTS} then 0
        when sum(docs) over (partition by lang) >= {LEAST_DOCUMENTS} then 1 else 2 end as level from totals
),
merged as (
    select level, case when level < 2 then lang end as lang, case when level < 1 then source end as source, feature, value, sum(n) as n
    from sketch cross join (select unnest([0, 1, 2]) as level) group by all
),
ranked as (
    select *, sum(n) over (partition by level, lang, source, feature order by value) as upto,
        sum(n) over (partition by level, lang, source, feature) as total from merged
),
quartiles as (
    select level, lang, source, feature, min(value) filter (upto * 4 >= total) as q1, min(value) filter (upto * 4 >= total * 3) as q3
    from ranked group by all
),
fences as (select level, lang, source, {_CUTS} from quartiles group by all),
cuts as (
    select l.lang as l, l.source as s, f.* exclude (level, lang, source) from levels l join fences f
    on f.level = l.level and f.lang is not distinct from (case when l.level < 2 then l.lang end)
        and f.source is not distinct from (case when l.level < 1 then l.source end)
)
select doc_id, cast(n_words as bigint) as n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    not base_failed and {_TESTS} as kept
from judged left join cuts on judged.lang is not distinct from cuts.l and judged.source is not distinct from cuts.s
"""
