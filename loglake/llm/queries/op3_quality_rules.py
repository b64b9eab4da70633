"""op3: quality rules with adaptive thresholds on every document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loglake.llm import quality_rules as rules


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.judge(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return judged.select("doc_id", *rules.COUNTS, "base_failed", "kept")


_RATES = {
    "symbols": "10000 * n_symbols // greatest(word_chars, 1)",
    "dup_lines": "10000 * n_dup_lines // greatest(n_words, 1)",
    "repeats": "10000 * n_repeat_words // greatest(n_words, 1)",
    "word_length": "100 * word_chars // greatest(n_words, 1)",
}


def _quartile_sql(name: str, keys: str) -> str:
    by = f"partition by {keys}, rate" if keys else "partition by rate"
    group = f"{keys}, " if keys else ""
    return f"""{name} as (
  select {group}rate, min(bucket) filter (upto * 4 >= total) as q1, min(bucket) filter (upto * 4 >= total * 3) as q3,
    max(total) as docs
  from (select *, sum(n) over ({by} order by bucket) as upto, sum(n) over ({by}) as total
    from (select {group}rate, bucket, sum(n) as n from sketch group by all))
  group by all)"""


_SLACK = "case c.rate " + " ".join(f"when '{n}' then {v}" for n, v in rules.SLACK.items()) + " end"
SQL = f"""
with split as (
  select doc_id, lang, source, coalesce(text, '') as text,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as lines
  from documents),
windows as (
  select doc_id, i, w[i] || chr(10) || w[i + 1] || chr(10) || w[i + 2] as key
  from (select doc_id, w, unnest(range(1, len(w) - 1)) as i from split)),
repeated as (
  select doc_id, i from (select *, count(*) over (partition by doc_id, key) as n from windows) where n > 1),
covered as (
  select doc_id, count(distinct i + k) as n from repeated, (select unnest([0, 1, 2]) as k) group by 1),
counts as (
  select s.doc_id, lang, source, cast(len(w) as bigint) as n_words,
    cast(length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g')) as bigint) as word_chars,
    cast(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
    cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines,
    cast(coalesce(c.n, 0) as bigint) as n_repeat_words
  from split s left join covered c on s.doc_id = c.doc_id),
rated as (
  select *, n_words < {rules.MIN_WORDS} or 100 * n_repeat_words > {rules.MAX_REPEAT_PERCENT} * n_words as base_failed,
    {", ".join(f"{sql} as {name}" for name, sql in _RATES.items())}
  from counts),
points as (
  {" union all ".join(f"select doc_id, lang, source, base_failed, '{n}' as rate, {n} as value from rated" for n in _RATES)}),
sketch as (
  select lang, source, rate,
    value - value % (1::bigint << greatest(cast(floor(log2(greatest(value, 1))) as int) - 6, 0)) as bucket, count(*) as n
  from points where not base_failed group by all),
{_quartile_sql("by_group", "lang, source")},
{_quartile_sql("by_lang", "lang")},
{_quartile_sql("overall", "")},
chosen as (
  select g.lang, g.source, g.rate,
    case when g.docs >= {rules.MIN_GROUP} then g.q1 when l.docs >= {rules.MIN_GROUP} then l.q1 else o.q1 end as q1,
    case when g.docs >= {rules.MIN_GROUP} then g.q3 when l.docs >= {rules.MIN_GROUP} then l.q3 else o.q3 end as q3
  from by_group g join by_lang l on g.lang is not distinct from l.lang and g.rate = l.rate
  join overall o on g.rate = o.rate),
verdict as (
  select p.doc_id, bool_and(p.value <= q3 + {rules.RANGES} * (q3 - q1) + {_SLACK}
    and (p.rate <> 'word_length' or p.value >= q1 - {rules.RANGES} * (q3 - q1) - {_SLACK})) as inside
  from points p join chosen c
    on p.lang is not distinct from c.lang and p.source is not distinct from c.source and p.rate = c.rate
  group by 1)
select r.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and coalesce(inside, false) as kept
from rated r left join verdict v on r.doc_id = v.doc_id
"""

QUERIES = {"op3_quality_rules": op3_quality_rules}
ORACLES = {"op3_quality_rules": SQL}
