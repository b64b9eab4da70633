"""Text mining of messages: keywords, frequencies, n-grams, severity words.

The messages are tokenised in a single scan that counts words, pairs and triples
together. Only counts are shuffled, after a partial sum in every task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglake import fixed_values as fv
from loglake.functions.columns import percent
from loglake.functions.text_columns import ngrams, once, tokens
from loglake.operators.lookup import lookup_join
from loglake.session import written

KEYWORDS = [(level, word) for level, words in fv.SEVERITY_KEYWORDS.items() for word in words]

#: Bytes of messages whose pairs and triples one task counts.
BYTES_A_TASK = 16 << 20


def with_text(df: DataFrame) -> DataFrame:
    """Rows that have a message."""
    return df.where(F.length("message") > 0)


def token_table(df: DataFrame, stop_words: Sequence[str] = fv.LOG_STOP_WORDS) -> DataFrame:
    """One row per token with its place in the message."""
    words = tokens(F.col("message"), stop_words)
    return with_text(df).select("row_id", F.posexplode(words).alias("position", "token"))


def lemmatize(token_rows: DataFrame, lemmas: DataFrame) -> DataFrame:
    """Tokens replaced by their lemma where ``lemmas(token, lemma)`` has one."""
    joined = lookup_join(token_rows, lemmas, "token", "left")
    return joined.withColumn("token", F.coalesce("lemma", "token")).drop("lemma")


def dealt(texts: DataFrame) -> DataFrame:
    """Messages dealt out in tasks of about ``BYTES_A_TASK``, and at least a task a core.

    Nearly every pair or triple of a text is a new one, so a task's counts grow with its text; a scan
    may also have all rows in one of its splits, which its number of partitions does not show.
    """
    size = texts.agg(F.sum(F.octet_length("message").cast("bigint"))).first()[0] or 0
    return texts.repartition(max(texts.sparkSession.sparkContext.defaultParallelism, -(-size // BYTES_A_TASK)))


def gram_counts(
    df: DataFrame, sizes: Sequence[int] = (1, 2, 3), stop_words: Sequence[str] = fv.LOG_STOP_WORDS
) -> DataFrame:
    """Occurrences of every word, pair and triple as (n, gram, count), from one scan.

    N-grams are built on the filtered tokens and never cross messages.
    """
    texts = with_text(df).select("message")
    if max(sizes) > 1:
        texts = dealt(texts)
    words = texts.select(once(tokens(F.col("message"), stop_words)).alias("words"))
    grams = F.array(
        *(F.struct(F.lit(n).alias("n"), ngrams(F.col("words"), n).alias("grams")) for n in sizes)
    )
    rows = words.select(F.inline(grams)).select("n", F.explode("grams").alias("gram"))
    return rows.groupBy("n", "gram").agg(F.count("*").alias("count"))


def ngram_counts(grams: DataFrame, n: int) -> DataFrame:
    return grams.where(F.col("n") == n).select("gram", "count")


def top_grams(grams: DataFrame, n: int, k: int) -> DataFrame:
    return ngram_counts(grams, n).orderBy(F.desc("count"), "gram").limit(k)


def top_keywords(grams: DataFrame, k: int = 50) -> DataFrame:
    """Most frequent words with their share of all tokens in percent."""
    words = ngram_counts(grams, 1)
    total = words.agg(F.sum("count")).scalar()
    return top_grams(grams, 1, k).select(
        F.col("gram").alias("keyword"), "count", percent(F.col("count"), total, 3).alias("frequency")
    )


def word_frequencies(grams: DataFrame) -> DataFrame:
    """Tokens, distinct tokens and their ratio."""
    total = F.coalesce(F.sum("count"), F.lit(0))
    return ngram_counts(grams, 1).agg(
        total.alias("total_tokens"),
        F.count("*").alias("unique_tokens"),
        F.round(F.count("*") / F.greatest(total, F.lit(1)), 4).alias("vocabulary_richness"),
    )


def term_weights(grams: DataFrame, k: int = 100) -> DataFrame:
    """Heaviest words and their weight relative to the heaviest."""
    heaviest = ngram_counts(grams, 1).agg(F.max("count")).scalar()
    return top_grams(grams, 1, k).select(
        F.col("gram").alias("term"), "count", F.round(F.col("count") / heaviest, 6).alias("weight")
    )


def severity_hits(df: DataFrame) -> DataFrame:
    """Messages that contain each of the severity words, zero counts included.

    A substring test per word, all in one pass: each task sends a single row.
    """
    lower = with_text(df).select(F.lower("message").alias("text"))
    counts = lower.agg(
        *(F.count_if(F.col("text").contains(word)).alias(f"k{i}") for i, (_, word) in enumerate(KEYWORDS))
    )
    rows = F.array(
        *(
            F.struct(F.lit(level).alias("severity"), F.lit(word).alias("keyword"), F.col(f"k{i}").alias("hits"))
            for i, (level, word) in enumerate(KEYWORDS)
        )
    )
    return counts.select(F.inline(rows))


def top_severity_keywords(hits: DataFrame, k: int = 5) -> DataFrame:
    """Most frequent words per severity level; levels without a hit do not appear."""
    ranked = F.sort_array(
        F.collect_list(F.struct((-F.col("hits")).alias("order"), "keyword", "hits"))
    )
    top = hits.where(F.col("hits") > 0).groupBy("severity").agg(F.slice(ranked, 1, k).alias("top"))
    return top.select("severity", F.explode("top").alias("t")).select("severity", "t.keyword", "t.hits")


def severity_counts(df: DataFrame) -> DataFrame:
    """Word hits per severity level, and the messages with at least one, zeros included."""
    text = F.col("text")

    def found(words: Sequence[str]) -> list[Column]:
        return [text.contains(w) for w in words]

    def total(words: Sequence[str]) -> Column:
        hits = sum((f.cast("bigint") for f in found(words)), F.lit(0).cast("bigint"))
        return F.coalesce(F.sum(hits), F.lit(0))

    def any_of(words: Sequence[str]) -> Column:
        chain = F.lit(False)
        for f in found(words):
            chain = chain | f
        return F.count_if(chain)

    lower = with_text(df).select(F.lower("message").alias("text"))
    stats = []
    for level, words in fv.SEVERITY_KEYWORDS.items():
        stats.append(
            F.struct(
                F.lit(level).alias("severity"), total(words).alias("hits"), any_of(words).alias("messages")
            ).alias(level)
        )
    return lower.agg(*stats).select(F.inline(F.array(*fv.SEVERITY_KEYWORDS)))


def insights(grams: DataFrame, severities: DataFrame) -> DataFrame:
    """The summary lines, numbered; lines without content are left out."""
    hits = severities.agg(
        F.sum(F.when(F.col("severity") == "critical", F.col("hits"))).alias("critical"),
        F.sum(F.when(F.col("severity") == "high", F.col("hits"))).alias("high"),
    )
    numbered = F.struct((-F.col("count")).alias("order"), "gram")
    terms = top_grams(grams, 1, 5).agg(F.sort_array(F.collect_list(numbered)).alias("terms"))
    richness = word_frequencies(grams).select("vocabulary_richness").scalar()
    found = terms.select(F.col("terms.gram").alias("terms")).scalar()
    lines = F.array(
        F.when(
            F.col("critical") > 0,
            F.format_string(fv.INSIGHT_CRITICAL, "critical"),
        ),
        F.when(
            F.col("high") > 0, F.format_string(fv.INSIGHT_HIGH, "high")
        ),
        F.when(F.size(found) > 0, F.format_string(fv.INSIGHT_TERMS, F.array_join(found, ", "))),
        F.format_string(fv.INSIGHT_RICHNESS, richness * 100),
    )
    rows = hits.select(F.posexplode(lines).alias("line", "insight"))
    return rows.where(F.col("insight").isNotNull())


def analyze(df: DataFrame, keywords: int = 50, sizes: Sequence[int] = (1, 2, 3)) -> dict[str, DataFrame]:
    """The whole analysis. The counts are written once; every table below reads them."""
    grams = written(gram_counts(df, sizes), "grams")
    severities = severity_counts(df)
    return {
        "keywords": top_keywords(grams, keywords),
        "word_frequencies": word_frequencies(grams),
        "top_words": top_grams(grams, 1, 20),
        "top_bigrams": top_grams(grams, 2, 20),
        "top_trigrams": top_grams(grams, 3, 15),
        "severity_counts": severities,
        "keyword_matches": top_severity_keywords(severity_hits(df)),
        "total_messages": with_text(df).agg(F.count("*").alias("total_messages")),
        "insights": insights(grams, severities),
    }
