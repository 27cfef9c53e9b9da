"""What the queries must equal, in DuckDB's SQL, where SQL can express it."""

from __future__ import annotations

from . import licenses, quality_rules

CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ALPHABET_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPACED_WORD = r"[^\x20\x09-\x0D]+"


def words(column: str, pattern: str, lower: bool) -> str:
    text = f"coalesce({column}, '')"
    if lower:
        text = f"translate({text}, '{CAPITALS}', '{CAPITALS.lower()}')"
    return f"regexp_extract_all({text}, '{pattern}')"


SUBSTRING_DEDUP = f"""
with d as (select doc_id, {words("text", SPACED_WORD, False)} as w from documents),
starts as (select doc_id, w, unnest(range(1, len(w) - 18)) as i from d where len(w) >= 20),
windows as (
  select doc_id, i,
         row_number() over (partition by array_to_string(w[i:i + 19], ' ') order by doc_id, i) as n
  from starts
),
gone as (
  select distinct doc_id, unnest(range(i, i + 20)) as i from windows where n > 1
),
word as (select doc_id, unnest(range(1, len(w) + 1)) as i, unnest(w) as word from d),
kept as (
  select doc_id, count(gone.i) as n_removed,
         string_agg(word, ' ' order by i) filter (where gone.i is null) as kept
  from word left join gone using (doc_id, i) group by doc_id
)
select doc_id, cast(len(w) as bigint) as n_words,
       cast(coalesce(n_removed, 0) as bigint) as n_removed,
       sha256(coalesce(kept, '')) as kept_sha256
from d left join kept using (doc_id)"""

DECONTAMINATE = f"""
with d as (select doc_id, {words("text", ALPHABET_WORD, True)} as w from documents),
item as (
  select item_id, {words("text", ALPHABET_WORD, True)} as w from benchmark
),
tests as (
  select distinct item_id, n, array_to_string(w[i:i + n - 1], ' ') as words
  from (
    select item_id, w, least(10, len(w)) as n, unnest(range(1, len(w) - least(10, len(w)) + 2)) as i
    from item where len(w) > 0
  )
),
places as (
  select doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') as words
  from (
    select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i
    from d, (select distinct n from tests) where len(w) >= n
  )
),
found as (select doc_id, i, n, item_id from places join tests using (n, words)),
hit as (
  select doc_id, count(distinct k) as n_hit
  from (select doc_id, unnest(range(i, i + n)) as k from found) group by doc_id
),
items as (
  select doc_id, count(*) as n_items, string_agg(name, ',' order by name) as names
  from (select distinct doc_id, cast(item_id as varchar) as name from found) group by doc_id
)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
       cast(coalesce(n_items, 0) as bigint) as n_items,
       sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join hit using (doc_id) left join items using (doc_id)"""


def license_scan() -> str:
    templates = ", ".join(
        f"({k}, {x.base}, '{x.label}', {x.words!r}, {x.tokens!r}, {x.needed})"
        for k, x in enumerate(licenses.TEMPLATES)
    )
    return f"""
with t(template, base, label, phrase, tokens, needed) as (values {templates}),
d as (select doc_id, {words("text", ALPHABET_WORD, True)} as w from documents),
starts as (
  select doc_id, label, i - 1 as place
  from (select doc_id, w, label, phrase, unnest(range(1, len(w) - len(phrase) + 2)) as i
        from d, t where base and len(w) >= len(phrase))
  where w[i:i + len(phrase) - 1] = phrase
),
hits as (
  select doc_id, template, label, needed, len(tokens) as size, i, word
  from (select doc_id, unnest(range(len(w))) as i, unnest(w) as word from d)
  join (select template, label, needed, tokens, unnest(tokens) as word from t where not base) using (word)
),
enough as (
  select doc_id, template from hits group by doc_id, template, needed having count(distinct word) >= needed
),
shared as (
  select doc_id, label, needed, size,
         count(distinct word) over (
           partition by doc_id, template order by i
           range between current row and {licenses.WINDOW - 1} following
         ) as n
  from hits join enough using (doc_id, template)
),
found as (
  select doc_id, label, 1.0 as share, place from starts
  union all
  select doc_id, label, cast(n as double) / size, null from shared where n >= needed
),
by_doc as (
  select doc_id, count(place) as n_base, min(place) as first_word, max(place) as last_word,
         array_to_string(list_sort(list_distinct(list(label) filter (where place is not null))), ',') as base_labels,
         array_to_string(list_sort(list_distinct(list(label))), ',') as labels, max(share) as score
  from found group by doc_id
)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_base, 0) as bigint) as n_base,
       cast(first_word as bigint) as first_word, cast(last_word as bigint) as last_word,
       coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels,
       cast(coalesce(score, 0) as double) as score
from d left join by_doc using (doc_id)"""


def quality() -> str:
    rules = quality_rules.Rules()
    n_rules, grid = len(quality_rules.RATIOS), quality_rules.GRID
    risk = rules.risk / n_rules
    capitals = quality_rules.CAPITALS
    return f"""
with d as (
  select doc_id, lang as stratum, coalesce(text, '') as text, {words("text", SPACED_WORD, False)} as w
  from documents
),
windows as (
  select doc_id, i, count(*) over (partition by doc_id, words) as n
  from (select doc_id, i, array_to_string(w[i:i + 7], ' ') as words
        from (select doc_id, w, unnest(range(1, len(w) - 6)) as i from d where len(w) >= 8))
),
repeats as (
  select doc_id, count(distinct k) as n_repeat_words
  from (select doc_id, unnest(range(i, i + 8)) as k from windows where n > 1) group by doc_id
),
line as (
  select doc_id, line from (select doc_id, unnest(string_split(text, chr(10))) as line from d)
  where len(regexp_extract_all(line, '{SPACED_WORD}')) > 0
),
by_line as (
  select doc_id, count(*) - count(distinct line) as n_dup_lines, count(distinct line) as n_single_lines
  from line group by doc_id
),
stutter as (
  select doc_id, count(*) as n_stutters
  from (select doc_id, w, unnest(range(2, len(w) + 1)) as i from d) where w[i] = w[i - 1]
  group by doc_id
),
m as (
  select doc_id, stratum, len(w) as n_words, length(array_to_string(w, '')) as word_chars,
         length(text) - length(translate(text, '{quality_rules.SYMBOLS}', '')) as n_symbols,
         coalesce(n_dup_lines, 0) as n_dup_lines, coalesce(n_single_lines, 0) as n_single_lines,
         coalesce(n_repeat_words, 0) as n_repeat_words,
         length(text) - length(translate(text, '{capitals}', '')) as n_capitals,
         length(text) - length(translate(text, '!', '')) as n_exclamations,
         coalesce(n_stutters, 0) as n_stutters
  from d left join repeats using (doc_id) left join by_line using (doc_id)
         left join stutter using (doc_id)
),
judged as (
  select *, n_words < {rules.min_words} or 100 * n_repeat_words > {rules.max_repeat_percent} * n_words
              as base_failed
  from m
),
ratio as (
  select doc_id, stratum, base_failed, rule,
         cast(coalesce(floor(cast(a as double) / nullif(b, 0) * {grid}), 0) as integer) as step
  from (
    select doc_id, stratum, base_failed, 'symbols' as rule, n_symbols as a, n_symbols + n_words as b from judged
    union all
    select doc_id, stratum, base_failed, 'lines', n_dup_lines, n_dup_lines + n_single_lines from judged
    union all
    select doc_id, stratum, base_failed, 'repeats', n_repeat_words, n_words from judged
    union all
    select doc_id, stratum, base_failed, 'capitals', n_capitals, word_chars from judged
    union all
    select doc_id, stratum, base_failed, 'exclamations', n_exclamations, n_exclamations + n_words from judged
    union all
    select doc_id, stratum, base_failed, 'stutters', n_stutters, n_words from judged
  )
),
known as (
  select doc_id, min(quality) = 1 as is_good from labels
  where doc_id is not null and quality is not null group by doc_id
),
held as (
  select stratum, rule, step, count(*) filter (where is_good) as good,
         count(*) filter (where not is_good) as bad
  from ratio join known using (doc_id) where not base_failed group by stratum, rule, step
),
sequences as (
  select stratum, rule, cast(sum(good) as bigint) as n, cast(sum(bad) as bigint) as n_bad
  from held group by stratum, rule
),
tested as (
  select s.stratum, s.rule, s.n, s.n_bad, c.step, cast(coalesce(sum(h.good), 0) as bigint) as k,
         cast(coalesce(sum(h.bad), 0) as bigint) as k_bad
  from sequences s cross join (select unnest(range(1, {grid + 1})) as step) c
  left join held h on h.stratum is not distinct from s.stratum and h.rule = s.rule and h.step >= c.step
  group by s.stratum, s.rule, s.n, s.n_bad, c.step
),
passed as (
  select *, case when k > {risk!r} * n then false else
    list_sum(list_transform(range(0, k + 1), lambda i: exp(
      lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({risk!r}) + (n - i) * ln(1 - {risk!r})
    ))) <= {rules.delta!r} / (select count(*) from sequences where n > 0) end as ok
  from tested
),
cutoffs as (
  select stratum, rule,
         max({{'benefit': cast(k_bad as double) / n_bad - cast(k as double) / n, 'step': step}}).step as cutoff
  from (select *, bool_and(ok) over (partition by stratum, rule order by step desc
          rows between unbounded preceding and current row) as so_far from passed)
  where so_far and k_bad > 0 and n > 0 group by stratum, rule
),
rejected as (
  select distinct doc_id from ratio r join cutoffs c
    on r.stratum is not distinct from c.stratum and r.rule = c.rule and r.step >= c.cutoff
)
select doc_id, cast(n_words as bigint) as n_words, cast(word_chars as bigint) as word_chars,
       cast(n_symbols as bigint) as n_symbols, cast(n_dup_lines as bigint) as n_dup_lines,
       cast(n_repeat_words as bigint) as n_repeat_words, base_failed,
       not base_failed and doc_id not in (select doc_id from rejected) as kept
from judged"""


FILTER_AUDIT = f"""
with d as (
  select doc_id, coalesce(source, '') as part, coalesce(text, '') as text,
         {words("text", SPACED_WORD, False)} as w
  from documents
),
flag as (
  select doc_id, max(case when quality = 1 then 1 else 0 end) as good,
         max(case when toxic = 1 then 1 else 0 end) as toxic
  from labels where doc_id is not null group by doc_id
),
failing as (
  select d.doc_id, part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic,
         case when len(w) < 50 then 'A' else '' end
         || case when 100 * len(list_distinct(w)) < 65 * len(w) then 'B' else '' end
         || case when 100 * len(regexp_extract_all(text, '[A-Z]')) > 5 * length(text) then 'C' else '' end
         || case when regexp_matches(text, '[#$%&*|]') then 'D' else '' end
         || case when doc_id > min(doc_id) over (partition by text) then 'E' else '' end as fails
  from d left join flag using (doc_id)
),
counted as (
  select part, fails, sum(good) as good, sum(toxic) as toxic, count(*) as n from failing group by part, fails
),
letter as (select unnest(['A', 'B', 'C', 'D', 'E']) as x),
orders as (
  select a.x || b.x || c.x || d.x || e.x as filter_order
  from letter a, letter b, letter c, letter d, letter e
  where len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
),
place as (
  select part, fails, good, toxic, n, filter_order, step, filter_order[step] as own,
         fails <> '' and contains(fails, filter_order[step]) as fails_own,
         len(regexp_extract_all(fails, '[' || filter_order[1:step] || ']')) > 0 as gone_after,
         step > 1 and len(regexp_extract_all(fails, '[' || filter_order[1:greatest(step - 1, 1)] || ']')) > 0
           as gone_before
  from counted, orders, (select unnest(range(1, 6)) as step)
),
report as (
  select part, filter_order, step, own,
         coalesce(sum(n) filter (where not gone_after), 0) as kept,
         coalesce(sum(n) filter (where gone_after and not gone_before), 0) as removed,
         coalesce(sum(n) filter (where fails_own and gone_before), 0) as redundant,
         coalesce(sum(n) filter (where fails = own), 0) as unique_fails,
         coalesce(sum(good) filter (where gone_after and not gone_before), 0) as good_lost,
         coalesce(sum(toxic) filter (where gone_after and not gone_before), 0) as toxic_lost
  from place group by part, filter_order, step, own
)
select part, filter_order, cast(step as integer) as step, cast(kept as bigint) as kept,
       cast(removed as bigint) as removed, cast(redundant as bigint) as redundant,
       cast(unique_fails as bigint) as unique_fails, cast(good_lost as bigint) as good_lost,
       cast(toxic_lost as bigint) as toxic_lost,
       cast(sum(removed) over (partition by part, own) as bigint) as shapley
from report"""


SQL: dict[str, str] = {
    "op1_license_scan": license_scan(),
    "op4_quality_rules": quality(),
    "op6_substring_dedup": SUBSTRING_DEDUP,
    "op8_decontaminate": DECONTAMINATE,
    "op12_filter_audit": FILTER_AUDIT,
}
