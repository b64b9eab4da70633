"""Registered queries: tokens, keywords, n-grams, severity words."""

from __future__ import annotations

from pyspark.sql import functions as F

from loglake import fixed_values as fv
from loglake.functions.text_columns import clean_text
from loglake.operators import text
from loglake.registry import sql_views as v
from loglake.sources import test_tables as t


def _texts(spark, sf_dir):
    return t.texts(spark, sf_dir)


def cleaned(spark, sf_dir):
    return _texts(spark, sf_dir).select("row_id", clean_text(F.col("message")).alias("clean_text"))


def token_rows(spark, sf_dir):
    return text.token_table(_texts(spark, sf_dir)).select("row_id", "position", "token")


def _lemmas(tokens):
    """A lemma table taken from the data: words that end in s next to the word without it."""
    words = tokens.select("token").distinct()
    plural = words.where(F.col("token").endswith("s")).withColumn("lemma", F.expr("left(token, length(token) - 1)"))
    return plural.join(words.withColumnRenamed("token", "lemma"), "lemma", "left_semi").select("token", "lemma")


def lemmas(spark, sf_dir):
    tokens = text.token_table(_texts(spark, sf_dir))
    changed = text.lemmatize(tokens, _lemmas(tokens))
    return changed.groupBy("token").agg(F.count("*").alias("count"))


def _grams(source, sizes):
    return lambda spark, sf_dir: text.gram_counts(source(spark, sf_dir), sizes)


def _with_grams(operator, sizes, *args, source=t.texts):
    return lambda spark, sf_dir: operator(text.gram_counts(source(spark, sf_dir), sizes), *args)


def _top(n, k):
    return lambda s, d: text.top_grams(text.gram_counts(t.texts(s, d), (n,)), n, k)


def insights(spark, sf_dir):
    messages = t.messages(spark, sf_dir)
    return text.insights(text.gram_counts(messages, (1,)), text.severity_counts(messages))


def analysis(spark, sf_dir):
    """Every table of the analysis in one long form."""
    tables = text.analyze(t.messages(spark, sf_dir))
    out = None
    for name, table in tables.items():
        rows = table.select(F.lit(name).alias("section"), F.to_json(F.struct("*")).alias("row"))
        out = rows if out is None else out.unionByName(rows)
    return out


QUERIES = {
    "clean_text": cleaned,
    "tokens": token_rows,
    "lemmatize": lemmas,
    "top_keywords": _with_grams(text.top_keywords, (1,)),
    "word_frequencies": _with_grams(text.word_frequencies, (1,)),
    "ngrams": _grams(t.texts, (2, 3)),
    "top_bigrams": _top(2, 20),
    "top_trigrams": _top(3, 15),
    "severity_keywords": lambda s, d: text.top_severity_keywords(text.severity_hits(t.messages(s, d))),
    "severity_counts": lambda s, d: text.severity_counts(t.messages(s, d)),
    "nlp_insights": insights,
    "term_weights": _with_grams(text.term_weights, (1,)),
    "nlp_analysis": analysis,
}


def _grams_sql(n: int) -> str:
    items = ", ' ', ".join(f"words[i + {j}]" for j in range(1, n + 1))
    return (
        f"select {n} as n, unnest(list_transform(range(0, greatest(len(words) - {n - 1}, 0)), "
        f"lambda i: concat({items}))) as gram from words"
    )


def _top_sql(n: int, k: int) -> str:
    body = f"select gram, count(*) as count from ({_grams_sql(n)}) group by gram order by count desc, gram limit {k}"
    return v.with_views(body, "words")


_KEYWORD_ROWS = ", ".join(f"('{s}', '{w}')" for s, words in fv.SEVERITY_KEYWORDS.items() for w in words)
_HITS = f"""select k.severity, k.keyword, count(l.row_id) as hits from (values {_KEYWORD_ROWS}) k(severity, keyword)
  left join logs l on contains(lower(l.message), k.keyword) group by k.severity, k.keyword"""
_ANY = " union all ".join(
    f"select '{s}' as severity, count(*) filter (where {' or '.join(f'contains(lower(message), {w!r})' for w in words)}) as messages from logs"
    for s, words in fv.SEVERITY_KEYWORDS.items()
)

ORACLES = {
    "clean_text": v.with_views(f"select row_id, {v.CLEAN_TEXT} as clean_text from texts", "texts"),
    "tokens": v.with_views(
        "select row_id, cast(unnest(range(0, len(words))) as int) as position, unnest(words) as token from words", "words"
    ),
    "lemmatize": v.with_views(
        """select coalesce(l.lemma, t.token) as token, count(*) as count from tokens t left join (
             select a.token, left(a.token, length(a.token) - 1) as lemma from token_counts a
             where a.token like '%s' and left(a.token, length(a.token) - 1) in (select token from token_counts)) l
           on t.token = l.token group by 1""",
        "tokens", "token_counts",
    ),
    "top_keywords": v.with_views(
        """select token as keyword, count, round(count / (select sum(count) from token_counts) * 100, 3) as frequency
           from token_counts order by count desc, token limit 50""",
        "token_counts",
    ),
    "word_frequencies": v.with_views(
        """select cast(sum(count) as bigint) as total_tokens, count(*) as unique_tokens,
             round(count(*) / greatest(sum(count), 1), 4) as vocabulary_richness from token_counts""",
        "token_counts",
    ),
    "ngrams": v.with_views(
        f"select n, gram, count(*) as count from ({_grams_sql(2)} union all {_grams_sql(3)}) group by n, gram", "words"
    ),
    "top_bigrams": _top_sql(2, 20),
    "top_trigrams": _top_sql(3, 15),
    "severity_keywords": v.with_views(
        f"""select severity, keyword, hits from (select *, row_number() over (partition by severity order by hits desc, keyword) as place
            from ({_HITS}) where hits > 0) where place <= 5""",
        "logs",
    ),
    "severity_counts": v.with_views(
        f"""select h.severity, cast(sum(h.hits) as bigint) as hits, any_value(a.messages) as messages
            from ({_HITS}) h join ({_ANY}) a on h.severity = a.severity group by h.severity""",
        "logs",
    ),
    "nlp_insights": v.with_views(
        f"""select line, insight from (
              select 0 as line, case when sum(hits) > 0 then printf('[!] %d messages contain CRITICAL severity indicators', sum(hits)::bigint) end as insight
              from ({_HITS}) where severity = 'critical'
              union all select 1, case when sum(hits) > 0 then printf('[!] %d messages contain HIGH severity indicators', sum(hits)::bigint) end
              from ({_HITS}) where severity = 'high'
              union all select 2, 'Most frequent terms: ' || string_agg(token, ', ' order by count desc, token)
              from (select * from log_token_counts order by count desc, token limit 5)
              union all select 3, printf('Vocabulary richness: %.1f%%', round(count(*) / sum(count), 4) * 100) from log_token_counts)
            where insight is not null""",
        "logs", "log_token_counts",
    ),
    "term_weights": v.with_views(
        """select token as term, count, round(count / (select max(count) from token_counts), 6) as weight
           from token_counts order by count desc, token limit 100""",
        "token_counts",
    ),
}
