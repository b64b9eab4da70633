"""op13: documents drawn by their likeness to the benchmark texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loglake.llm import importance


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return importance.resample(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


_LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), {_LETTERS}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
_DIGIT = "(instr('0123456789ABCDEF', substr(h, {at}, 1)) - 1)"
_BYTES = f"list_transform(range(1, length(h), 2), lambda i: 16 * {_DIGIT.format(at='i')} + {_DIGIT.format(at='i + 1')})"
_ROUND = "list_reduce(list_prepend(xor(c, b), range(8)), lambda a, k: xor(a >> 1, (a & 1) * 3988292384))"
SQL = f"""
with docs as (select doc_id, {_WORDS} as w from documents),
wanted as (select {_WORDS} as w from benchmark),
words as (select distinct unnest(w) as word from (select w from docs union all select w from wanted)),
hashed as (
  select word, xor(list_reduce(list_prepend(4294967295::bigint, bytes),
    lambda c, b: xor(c >> 8, {_ROUND.replace("xor(c, b)", "xor(c, b) & 255")})), 4294967295) % 10000 as bucket
  from (select word, {_BYTES} as bytes from (select word, hex(encode(word)) as h from words))),
here as (select bucket, count(*) as s from (select unnest(w) as word from docs) join hashed using (word) group by 1),
there as (select bucket, count(*) as t from (select unnest(w) as word from wanted) join hashed using (word) group by 1),
sums as (select (select coalesce(sum(s), 0) from here)::double + 10000 as big_s, (select coalesce(sum(t), 0) from there)::double + 10000 as big_t),
gains as (
  select bucket, cast(floor(1000 * ln((coalesce(t, 0) + 1)::double * big_s / ((coalesce(s, 0) + 1)::double * big_t))) as bigint) as gain
  from (select range as bucket from range(10000)) left join here using (bucket) left join there using (bucket), sums),
weighed as (
  select doc_id, cast(len(w) as bigint) as n_features, cast(coalesce(floor(total / len(w)), 0) as bigint) as weight
  from docs left join (
    select doc_id as id, sum(gain)::double as total from (select doc_id, unnest(w) as word from docs)
    join hashed using (word) join gains using (bucket) group by 1) on doc_id = id),
scored as (
  select *, weight + cast(floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::bigint + 0.5::double) / 4294967296::double))) as bigint) as score
  from weighed),
ranked as (
  select doc_id, row_number() over (order by score desc, doc_id) as rank, count(*) over () as docs from scored where n_features >= 20)
select s.doc_id, n_features, weight, score, case when rank <= 10 * docs // 100 then rank end as rank
from scored s left join ranked r on s.doc_id = r.doc_id
"""

QUERIES = {"op13_importance": op13_importance}
ORACLES = {"op13_importance": SQL}
