"""Text expressions: cleaning, tokens, n-grams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from loglake import fixed_values as fv


def _without_noise(text: Column) -> Column:
    """Addresses, times, hex values and paths replaced by blanks, in this order."""
    for pattern in (fv.TEXT_IPV4, fv.TEXT_TIME, fv.TEXT_HEX, fv.TEXT_PATH):
        text = F.regexp_replace(text, pattern, " ")
    return text


def clean_text(text: Column) -> Column:
    """Lower-case ASCII letters and white space only."""
    return F.lower(F.regexp_replace(_without_noise(text), f"[^a-zA-Z{fv.WHITESPACE_CLASS}]", " "))


def tokens(text: Column, stop_words: Sequence[str] = fv.LOG_STOP_WORDS) -> Column:
    """Words of more than two letters that are not stop words, in order."""
    words = F.split(F.lower(F.regexp_replace(_without_noise(text), "[^a-zA-Z]+", " ")), " ")
    return F.filter(words, lambda w: (F.length(w) > 2) & ~w.isin(*stop_words))


def ngrams(words: Column, n: int) -> Column:
    """Runs of ``n`` consecutive items joined by a blank; empty when there are too few.

    Built by pairing the list with its own tail, so the work is linear in its length.
    """
    runs = words
    for behind in range(1, n):
        count = F.greatest(F.size(words) - behind, F.lit(0))
        tail = F.slice(words, F.lit(behind + 1), count)
        runs = F.zip_with(F.slice(runs, F.lit(1), count), tail, lambda a, b: F.concat(a, F.lit(" "), b))
    return runs


def once(column: Column) -> Column:
    """The same value as a generator output, which the optimizer does not inline.

    For lists that several expressions use: written plainly, each use would tokenise
    the text again.
    """
    return F.explode(F.array(column))


def identifiers(text: Column, stop_words: Sequence[str]) -> Column:
    """Lower-case identifiers without stop words, in order."""
    # (?U): word boundaries also see letters and digits beyond ASCII
    words = F.regexp_extract_all(F.lower(text), F.lit("(?U)" + fv.TERM_PATTERN), F.lit(0))
    return F.filter(words, lambda w: ~w.isin(*stop_words))
