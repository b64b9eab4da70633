"""Toxicity by multiple-instance learning: sentences are instances, documents are bags.

A sentence's score is the logistic of its words' weights plus a bias, and a document's is
the noisy-or of its sentences: one minus the product of the complements. Only documents
carry labels; the gradient of the noisy-or tells the sentences apart. The model is fitted
on a bounded sample of labelled texts, and every whole text is scored in one map.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from loglake.llm.words import LOWER, Hasher, Slice, runs, slices
from loglake.session import released

#: Bounds of the training sample: texts per label, and their characters in total (the text that crosses it is still taken).
SAMPLE = 3000
SAMPLE_CHARS = 20_000_000
#: A word needs so many distinct training texts to get a weight.
MIN_TEXTS = 5
EPOCHS = 300
RATE = 0.1
#: Pull of a word's weight towards zero, as a share of the sample; words below it get none.
PENALTY = 3e-4
#: The noisy-or's leak while fitting: so many documents are labelled 1 for no sentence of theirs.
LEAK = 0.02
OFFENDING = 0.5

#: Bytes of a word's beginning.
STEM = 5
_STEM_MARK = np.uint64(0x5DEECE66D)

_IS_LETTER = np.zeros(256, bool)
_IS_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_ENDS = np.zeros(256, bool)
_ENDS[list(b".!?\n")] = True


@dataclass
class Instances:
    """Sentences of a slice and the hashes of the words in them."""

    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    word: np.ndarray
    sentence: np.ndarray


def instances(piece: Slice) -> Instances:
    """Sentences end at a full stop, mark or line end; words are runs of letters, A-Z folded.

    A word longer than ``STEM`` bytes also counts by its beginning, which its inflected forms share.
    """
    start, end = runs(~_ENDS[piece.data], piece.offsets)
    low, high = runs(_IS_LETTER[piece.data], piece.offsets)
    sentence = np.searchsorted(start, low, side="right") - 1
    hasher = Hasher(LOWER[piece.data])
    long = high - low > STEM
    stems = hasher.ranges(low[long], low[long] + STEM) ^ _STEM_MARK
    word = np.concatenate((hasher.ranges(low, high), stems))
    return Instances(start, end, piece.text_of(start), word, np.concatenate((sentence, sentence[long])))


@dataclass
class NoisyOr:
    words: np.ndarray
    weights: np.ndarray
    bias: float

    def sentences(self, found: Instances) -> np.ndarray:
        """Log-odds of every sentence; a word counts once per occurrence."""
        logits = np.full(len(found.start), self.bias)
        if len(self.words) and len(found.word):
            at = np.minimum(np.searchsorted(self.words, found.word), len(self.words) - 1)
            known = self.words[at] == found.word
            logits += np.bincount(found.sentence[known], self.weights[at[known]], minlength=len(logits))
        return logits


def _softplus(x: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, x)


def _logistic(x: np.ndarray) -> np.ndarray:
    return np.exp(-np.logaddexp(0.0, -x))


def noisy_or(logits: np.ndarray, bag: np.ndarray, bags: int) -> np.ndarray:
    """Probability of every bag; a bag without instances has 0."""
    return -np.expm1(-np.bincount(bag, _softplus(logits), minlength=bags))


def _frequent(texts: pa.Array) -> np.ndarray:
    """Sorted hashes of the words that ``MIN_TEXTS`` texts hold, counted slice by slice."""
    words, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for piece in slices(texts):
        found = instances(piece)
        if not len(found.word):
            continue
        own, index = np.unique(found.word, return_inverse=True)
        pairs = np.unique(index.astype(np.int64) * piece.size + found.text[found.sentence])
        held = np.bincount(pairs // piece.size, minlength=len(own))
        words, index = np.unique(np.concatenate((words, own)), return_inverse=True)
        counts = np.bincount(index, np.concatenate((counts, held)), minlength=len(words))
    return words[counts >= MIN_TEXTS]


def fit(texts: list[str], labels: np.ndarray, weights: np.ndarray | None = None) -> NoisyOr:
    """Gradient steps on the likelihood of document labels, small weights held at zero.

    ``weights`` tells how many labelled documents each text stands for. Equal texts
    count once. Without both labels the model is its bias alone.
    """
    _, once = np.unique(pd.util.hash_array(np.array(texts, object)), return_index=True) if texts else (0, [])
    texts, y = [texts[i] for i in once], np.asarray(labels, float)[once]
    share = np.ones(len(y)) if weights is None else np.asarray(weights, float)[once]
    share = share / share.sum()
    if not len(y) or y.min() == y.max():
        return NoisyOr(np.zeros(0, np.uint64), np.zeros(0), 2.0 if len(y) and y.min() > 0 else -8.0)
    column = pa.array(texts, pa.string())
    vocabulary = _frequent(column)
    feature, sentence, bag, done, bags = [], [], [], 0, 0
    for piece in slices(column):
        found = instances(piece)
        place = np.searchsorted(vocabulary, found.word)
        known = np.flatnonzero(place < len(vocabulary))
        known = known[vocabulary[place[known]] == found.word[known]]
        feature.append(place[known].astype(np.int32))
        sentence.append((found.sentence[known] + done).astype(np.int32))
        bag.append(found.text + bags)
        done, bags = done + len(found.start), bags + piece.size
    bag = np.concatenate(bag)

    bag_of = bag

    def descend(feature: list[np.ndarray], count: int, penalty: float) -> tuple[np.ndarray, float]:
        weights, bias = np.zeros(count), -6.0
        m, v = np.zeros(count + 1), np.zeros(count + 1)
        for step in range(1, EPOCHS + 1):
            logits = np.full(done, bias)
            for f, s in zip(feature, sentence):
                if len(s):
                    low, high = s.min(), s.max() + 1
                    logits[low:high] += np.bincount(s - low, weights[f], minlength=high - low)
            lit = noisy_or(logits, bag_of, bags)
            # d(loss)/d(-log(1 - P)): 1 for label 0, -(1 - P)/(leak + P) for label 1
            slope = np.where(y > 0, -(1 - lit) / (LEAK / (1 - LEAK) + lit), 1.0) * share
            by_sentence = slope[bag_of] * _logistic(logits)
            by_word = np.zeros(count)
            for f, s in zip(feature, sentence):
                by_word += np.bincount(f, by_sentence[s], minlength=count)
            gradient = np.append(by_word, by_sentence.sum())
            m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient**2
            pace = RATE / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
            move = pace * m / (1 - 0.9**step)
            weights, bias = weights - move[:-1], bias - move[-1]
            weights = np.sign(weights) * np.maximum(np.abs(weights) - pace[:-1] * penalty, 0)
        return weights, float(bias)

    weights, _ = descend(feature, len(vocabulary), PENALTY)
    # the words that stay are fitted again without the penalty, which has shrunk them
    used = weights != 0
    place = np.cumsum(used, dtype=np.int32) - 1
    sentence = [s[used[f]] for f, s in zip(feature, sentence)]
    weights, bias = descend([place[f[used[f]]] for f in feature], int(used.sum()), 0.0)
    return NoisyOr(vocabulary[used], weights, bias)


def sample(
    docs: DataFrame, labels: DataFrame, column: str, allowed: Column, size: int = SAMPLE, chars: int = SAMPLE_CHARS
) -> pd.DataFrame:
    """``text``, ``label`` and ``weight`` of up to ``size`` ids and about ``chars`` characters of
    either label, chosen by hash among labelled ids that ``allowed`` lets through.

    Texts of any length are taken. A text's weight is the number of labelled ids for each
    one that was drawn, so that both labels weigh what they do among all labelled ids.
    Null labels and ids are no labels; an id with both labels counts as 1; ids without a document fall out.
    """
    spark = docs.sparkSession
    wanted = labels.where(F.col(column).isin(0, 1) & F.col("doc_id").isNotNull() & allowed)
    wanted = wanted.groupBy("doc_id").agg(F.max(column).alias("label"))
    known = {r.label: r.n for r in wanted.groupBy("label").agg(F.count("*").alias("n")).collect()}
    order = [F.xxhash64("doc_id", F.lit(column)), F.col("doc_id")]
    drawn = []
    for value in known:
        ids = wanted.where(F.col("label") == value).orderBy(*order).limit(size).select("doc_id").collect()
        drawn += [(r.doc_id, value, place) for place, r in enumerate(ids)]
    kind = labels.select("doc_id").schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).where(F.col("text").isNotNull())
    texts = texts.withColumn("key", F.xxhash64("text"))
    # at most 2 * size ids: a broadcast of proven size; first the lengths alone, so that the bound on
    # characters holds before a text is fetched
    ids = spark.createDataFrame(drawn, f"doc_id {kind}, label int, place int")
    found = texts.join(F.broadcast(ids), "doc_id").groupBy("place", "label", "doc_id", "key")
    lengths = found.agg(F.max(F.length("text")).alias("chars")).orderBy("place", "label", "key").limit(2 * size).collect()
    taken = []
    for value, total in known.items():
        own = [r for r in lengths if r.label == value]
        before = np.cumsum([0, *(r.chars for r in own)])[: len(own)]
        within = [r for r, sum_before in zip(own, before) if sum_before < chars]
        whole = len(within) == len(own) and len(lengths) < 2 * size
        reached = min(total, size) if whole or not within else within[-1].place + 1
        taken += [(r.doc_id, r.key, r.label, r.place, total / reached) for r in within]
    fields = f"doc_id {kind}, key bigint, label int, place int, weight double"
    rows = texts.join(F.broadcast(spark.createDataFrame(taken, fields)), ["doc_id", "key"])
    rows = rows.groupBy("place", "label", "key", "weight").agg(F.first("text").alias("text")).toPandas()
    return rows.sort_values(["place", "label", "key"])[["text", "label", "weight"]]


def score(docs: DataFrame, model: NoisyOr, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, the document's ``score`` and its ``offending`` sentences with a score of
    ``OFFENDING`` or more: start, end (code points, end exclusive) and score.

    Null and empty texts score 0. Every row is scored by itself, so repeated rows score
    alike. Only ``keep`` and ``text`` are read.
    """
    # a text that is kept goes to the tasks once
    raw = "text" if "text" in keep and isinstance(docs.schema["text"].dataType, StringType) else "_text"
    slim = docs.select(*keep, *([F.col("text").cast("string").alias(raw)] if raw not in keep else []))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in slim.select(*keep).schema.fields]
    kind = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch.column(raw)):
                found = instances(piece)
                logits = model.sentences(found)
                scores = noisy_or(logits, found.text, piece.size)
                each = _logistic(logits)
                bad = np.flatnonzero(each >= OFFENDING)
                char = np.concatenate(([0], np.cumsum((piece.data & 0xC0) != 0x80, dtype=np.int64)))
                base = char[piece.offsets[found.text[bad]]]
                spans = pa.StructArray.from_arrays(
                    [char[found.start[bad]] - base, char[found.end[bad]] - base, each[bad]], fields=list(kind)
                )
                ends = np.searchsorted(found.text[bad], np.arange(piece.size + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), spans)
                rows = batch.slice(piece.low, piece.size)
                yield pa.RecordBatch.from_arrays(
                    [*(rows.column(c) for c in keep), pa.array(scores), lists], [*keep, "score", "offending"]
                )

    spans = "array<struct<start: bigint, end: bigint, score: double>>"
    return slim.mapInArrow(released(run), ", ".join([*fields, "score double", f"offending {spans}"]))


def train(docs: DataFrame, labels: DataFrame, allowed: Column) -> NoisyOr:
    rows = sample(docs, labels, "toxic", allowed)
    return fit(rows["text"].tolist(), rows["label"].to_numpy(), rows["weight"].to_numpy())
