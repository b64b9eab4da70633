"""Quality rules with thresholds that adapt to each language and source.

Every text is measured once. Four rates per document go into mergeable quantile sketches,
one per language, source and rate: counts of log-linear buckets (64 per power of two), so
a quantile is off by 1/64 of its value at most, merging is adding counts, and the result does not
depend on order. The fences of a group replace fixed cutoffs; measured documents are
joined with the fences of their group and filtered.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglake.llm.words import IS_SPACE, Hasher, mix, runs, shingles, slices, words
from loglake.session import written

SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: A group needs so many documents for fences of its own; else its language's, else all documents' hold.
MIN_GROUP = 30
#: Fences lie so many interquartile ranges, plus a slack, beyond the quartiles.
RANGES = 3
SLACK = {"symbols": 300, "dup_lines": 500, "repeats": 2500, "word_length": 100}
TWO_SIDED = ("word_length",)

_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS)] = True
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _again(text: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For items of texts: which equal an earlier one of their text; which have an equal one at all."""
    key = values ^ mix(text.astype(np.uint64) + np.uint64(1))
    order = np.argsort(key, kind="stable")
    same = np.zeros(len(key) + 1, bool)
    same[1:-1] = key[order][1:] == key[order][:-1]
    later, any_equal = np.zeros(len(key), bool), np.zeros(len(key), bool)
    later[order] = same[:-1]
    any_equal[order] = same[:-1] | same[1:]
    return later, any_equal


def _counts(column: pa.Array) -> list[np.ndarray]:
    parts: list[list[np.ndarray]] = []
    for piece in slices(column):
        data, size = piece.data, piece.size
        found = words(piece)
        letters = ~IS_SPACE[data] & ((data & 0xC0) != 0x80)
        start, end = runs(data != 10, piece.offsets)
        spoken = np.concatenate(([0], np.cumsum(~IS_SPACE[data], dtype=np.int64)))
        full = spoken[end] > spoken[start]
        start, end = start[full], end[full]
        line_text = piece.text_of(start)
        later, _ = _again(line_text, Hasher(data).ranges(start, end))
        values, at = shingles(found, 3)
        _, repeated = _again(found.text[at], values)
        covered = np.zeros(len(found.hash), bool)
        for k in range(3):
            covered[at[repeated] + k] = True
        parts.append(
            [
                found.counts,
                piece.per_text(letters),
                piece.per_text(_IS_SYMBOL[data]),
                np.bincount(line_text[later], minlength=size),
                np.bincount(found.text[covered], minlength=size),
            ]
        )
    return [np.concatenate(p).astype(np.int64) for p in zip(*parts)] if parts else [np.zeros(0, np.int64)] * len(COUNTS)


def measure(docs: DataFrame, keep: tuple[str, ...] = ("doc_id", "lang", "source")) -> DataFrame:
    """``keep`` and the counts of every text: words, code points in words, symbols, lines
    with a word that equal an earlier line, words in repeated three-word windows.

    Null and empty texts count 0 everywhere; repeated rows are measured each. Columns
    other than ``keep`` and ``text`` are not read, whatever their names.
    """
    slim = docs.select(*keep, F.col("text").cast("string").alias("_text"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in slim.select(*keep).schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [pa.array(c) for c in _counts(batch.column("_text"))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *counts], [*keep, *COUNTS])

    return slim.mapInArrow(run, ", ".join([*fields, *(f"{c} bigint" for c in COUNTS)]))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _share(part: str, whole: str, scale: int = 10_000) -> Column:
    return F.expr(f"{scale} * {part} div greatest({whole}, 1)")


def rates() -> dict[str, Column]:
    """Whole numbers: per ten thousand, mean word length in hundredths of a character."""
    return {
        "symbols": _share("n_symbols", "word_chars"),
        "dup_lines": _share("n_dup_lines", "n_words"),
        "repeats": _share("n_repeat_words", "n_words"),
        "word_length": _share("word_chars", "n_words", 100),
    }


def bucket(value: str) -> Column:
    """Lower end of the sketch bucket of a whole number >= 0: exact below 128, then 64 per power of two."""
    width = f"shiftleft(1L, greatest(cast(floor(log2(greatest({value}, 1))) as int) - 6, 0))"
    return F.expr(f"{value} - {value} % {width}")


def sketches(rated: DataFrame) -> DataFrame:
    """Bucket counts per language, source and rate, reduced in the map tasks."""
    each = F.array(*(F.struct(F.lit(n).alias("rate"), F.col(n).alias("value")) for n in rates()))
    values = rated.select("lang", "source", F.inline(each))
    return values.groupBy("lang", "source", "rate", bucket("value").alias("bucket")).agg(F.count("*").alias("n"))


def _quartiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Quartiles of each rate from merged sketches, as one struct per rate and key."""
    from pyspark.sql import Window

    merged = sketch.groupBy(*keys, "rate", "bucket").agg(F.sum("n").alias("n"))
    by = Window.partitionBy(*keys, "rate")
    ranked = merged.withColumns(
        {"upto": F.sum("n").over(by.orderBy("bucket")), "total": F.sum("n").over(by)}
    )
    at = {q: F.min(F.when(F.col("upto") * 4 >= F.col("total") * q, F.col("bucket"))) for q in (1, 3)}
    quartiles = ranked.groupBy(*keys, "rate").agg(
        at[1].alias("q1"), at[3].alias("q3"), F.max("total").alias("total")
    )
    fences = F.struct("q1", "q3")
    return quartiles.groupBy(*keys).agg(
        F.max("total").alias("docs"), *(F.max(F.when(F.col("rate") == n, fences)).alias(n) for n in rates())
    )


def thresholds(sketch: DataFrame) -> DataFrame:
    """Fences per language and source: ``<rate>_max`` and, where two-sided, ``<rate>_min``.

    Groups of fewer than ``MIN_GROUP`` documents take the merged sketch of their
    language, and small languages that of all documents.
    """
    group = _quartiles(sketch, ["lang", "source"]).withColumn("everything", F.lit(0))
    language = _quartiles(sketch, ["lang"]).withColumnRenamed("lang", "of_lang")
    everything = _quartiles(sketch.withColumn("everything", F.lit(0)), ["everything"])
    joined = (
        group.alias("g")
        .join(language.alias("l"), F.col("g.lang").eqNullSafe(F.col("l.of_lang")))
        .join(everything.alias("e"), "everything")
    )
    columns = []
    for name in rates():
        chosen = (
            F.when(F.col("g.docs") >= MIN_GROUP, F.col(f"g.{name}"))
            .when(F.col("l.docs") >= MIN_GROUP, F.col(f"l.{name}"))
            .otherwise(F.col(f"e.{name}"))
        )
        q1, q3 = chosen["q1"], chosen["q3"]
        reach = (q3 - q1) * RANGES + SLACK[name]
        columns.append((q3 + reach).alias(f"{name}_max"))
        if name in TWO_SIDED:
            columns.append((q1 - reach).alias(f"{name}_min"))
    return joined.select(F.col("g.lang").alias("for_lang"), F.col("g.source").alias("for_source"), *columns)


def judge(docs: DataFrame) -> DataFrame:
    """Counts and verdict of every document: ``base_failed`` and ``kept``.

    Documents that fail the base rules are never kept and shape no fence. With no document
    left for the sketches, none is kept. A null language or source is a group of its own.
    """
    rated = written(measure(docs).withColumns({"base_failed": base_failed(), **rates()}), "rates")
    fences = thresholds(sketches(rated.where(~F.col("base_failed"))))
    inside = F.lit(True)
    for name in rates():
        inside = inside & (F.col(name) <= F.col(f"{name}_max"))
        if name in TWO_SIDED:
            inside = inside & (F.col(name) >= F.col(f"{name}_min"))
    same = F.col("lang").eqNullSafe(F.col("for_lang")) & F.col("source").eqNullSafe(F.col("for_source"))
    kept = ~F.col("base_failed") & F.coalesce(inside, F.lit(False))
    return rated.join(fences, same, "left").withColumn("kept", kept)
