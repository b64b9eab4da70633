"""op11: the strongest phrases of each language."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loglake.llm import phrases


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.phrases(spark.read.parquet(f"{sf_dir}/documents.parquet"))


_LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _grams(n: int) -> str:
    part = " || ' ' || ".join(f"w[i + {k}]" for k in range(n))
    return f"select lang, {part} as phrase, {n} as size from (select lang, w, unnest(range(1, len(w) - {n - 2})) as i from pieces)"


def _cut(n: int, k: int) -> str:
    return f"select lang, phrase, a, {k} as k, array_to_string(w[1:{k}], ' ') as first, array_to_string(w[{k + 1}:{n}], ' ') as rest from standing where size = {n}"


def _part(n: int, size: int, at: int) -> str:
    return f"select lang, array_to_string(w[{at}:{at + size - 1}], ' ') as phrase, a from often where size = {n}"


SQL = f"""
with pieces as materialized (
  select lang, regexp_extract_all(piece, '[^\\x20\\x09]+') as w
  from (select coalesce(lang, 'und') as lang,
      unnest(regexp_split_to_array(translate(coalesce(text, ''), {_LETTERS}), '[.,;:!?\\x0A-\\x0D]')) as piece from documents)),
often as materialized (
  select lang, phrase, size, count(*) as a, string_split(phrase, ' ') as w
  from ({" union all ".join(_grams(n) for n in range(1, 5))}) group by 1, 2, 3 having count(*) >= 30),
totals as (select lang, cast(sum(len(w)) as bigint) as n from pieces group by 1),
around as (
  select lang, phrase, max(a) as most
  from ({" union all ".join(_part(n, s, at) for n in (3, 4) for s in range(2, n) for at in range(1, n - s + 2))}) group by 1, 2),
standing as (
  select o.* from often o left join around using (lang, phrase)
  where size > 1 and not coalesce(100::hugeint * most >= 80::hugeint * o.a, false)),
cuts as ({" union all ".join(_cut(n, k) for n in (2, 3, 4) for k in range(1, n))}),
scores as (
  select c.lang, c.phrase, c.a, k, f.a as l, r.a as r, cast((2000000::hugeint * c.a) // (f.a + r.a) as bigint) as score
  from cuts c join often f on c.lang = f.lang and c.first = f.phrase join often r on c.lang = r.lang and c.rest = r.phrase),
weakest as (
  select * from (select *, row_number() over (partition by lang, phrase order by score, k) as place from scores) where place = 1),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from weakest)
select lang, rank, phrase, a, l, r, n, score from ranked join totals using (lang) where rank <= 2000
"""

QUERIES = {"op11_phrases": op11_phrases}
ORACLES = {"op11_phrases": SQL}
