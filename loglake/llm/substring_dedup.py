"""Duplicate word spans against all earlier text, by grouping content-defined blocks.

Every text is cut into overlapping blocks whose borders its own words decide, so equal
passages are cut alike wherever they stand: all windows of ``WINDOW`` words that share
their least ``GRAM``-word hash (the anchor) form a block. Blocks are grouped by
hash, and those with an earlier place are duplicates. This stands in the place of a relative
Lempel-Ziv parse: no longest match is searched and no factor is built, since only which words
repeat is wanted. At the borders of passages a copy and its source continue differently, so their blocks differ
although some windows in them agree: first places of blocks that share an anchor are checked window by window.
The result is exact up to collisions of 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglake.llm.words import _BASE, _INVERSE, Slice, Words, _power, mix, shingles, slices, words
from loglake.session import written

WINDOW = 20
GRAM = 5
_LAST = (1 << 63) - 1


class _Ranges:
    """Hashes of word ranges of a slice."""

    def __init__(self, found: Words):
        count = len(found.hash)
        self.prefix = np.zeros(count + 1, np.uint64)
        np.cumsum(found.hash * _power(_BASE, count), out=self.prefix[1:])
        self.back = _power(_INVERSE, count + 1)

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        value = (self.prefix[end] - self.prefix[start]) * self.back[start]
        return mix(value + (end - start).astype(np.uint64)).view(np.int64)


def _blocks(found: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, first window and number of windows of every block of a slice."""
    none = np.zeros(0, np.int64)
    count = len(found.hash) - WINDOW + 1
    if count <= 0:
        return none, none, none
    inside = np.flatnonzero(found.text[:count] == found.text[WINDOW - 1 :])
    if not len(inside):
        return none, none, none
    grams = np.zeros(len(found.hash) - GRAM + 1, np.uint64)
    for k in range(GRAM):
        grams += found.hash[k : k + len(grams)] * np.uint64(pow(_BASE, k + 1, 1 << 64))
    grams = mix(grams)
    # leftmost least gram of every window, by doubling: a window holds 16 grams
    least, step = np.arange(len(grams)), 1
    while step < WINDOW - GRAM + 1:
        left, right = least[: len(least) - step], least[step:]
        least = np.where(grams[right] < grams[left], right, left)
        step *= 2
    anchor = least[inside]
    begins = np.flatnonzero(np.diff(anchor, prepend=-1))
    return grams[anchor[begins]].view(np.int64), inside[begins], np.diff(np.append(begins, len(inside)))


def _slim(docs: DataFrame) -> DataFrame:
    """``_doc`` orders documents: null ids come last."""
    key = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_LAST)).alias("_doc")
    return docs.select(key, F.col("text").cast("string").alias("_text"))


def blocks(docs: DataFrame, anchors_only: bool = False) -> DataFrame:
    """Rows of anchor, hash of the whole block, document, first word and number of windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs_ = batch.column("_doc").to_numpy(zero_copy_only=False)
            for piece in slices(batch.column("_text")):
                found = words(piece)
                anchor, first, size = _blocks(found)
                if anchors_only:
                    yield pa.RecordBatch.from_arrays([pa.array(anchor)], ["anchor"])
                    continue
                text = found.text[first]
                hashes = _Ranges(found)(first, first + size + WINDOW - 1)
                columns = [anchor, hashes, docs_[piece.low + text], (first - found.first[text]).astype(np.int32), size.astype(np.int16)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["anchor", "block", "doc", "start", "size"])

    if anchors_only:
        return _slim(docs).mapInArrow(run, "anchor bigint")
    return _slim(docs).mapInArrow(run, "anchor bigint, block bigint, doc bigint, start int, size smallint")


def _with_spans(docs: DataFrame, spans: DataFrame, how: str) -> DataFrame:
    """Each text with the spans (start, size, block) noted for its id."""
    by_doc = spans.groupBy("doc").agg(F.collect_list(F.struct("start", "size", "block")).alias("_spans"))
    return docs.join(by_doc, F.col("_doc") == F.col("doc"), how).drop("doc")


def _checked(piece: Slice, found: Words, spans: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """First and number of windows of the spans that agree with the words of their text."""
    none = np.zeros(0, np.int64)
    flat = spans.flatten()
    if not len(flat):
        return none, none
    lengths = np.diff(spans.offsets.to_numpy())
    text = np.repeat(np.arange(len(spans)), lengths)
    start, size, block = (flat.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(3))
    fits = start + size + WINDOW - 1 <= found.counts[text]
    text, start, size, block = text[fits], start[fits] + found.first[text[fits]], size[fits], block[fits]
    same = _Ranges(found)(start, start + size + WINDOW - 1) == block
    return start[same], size[same]


def _border_windows(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """Every single window of the given spans, as rows of doc, start and block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs_ = batch.column("_doc").to_numpy(zero_copy_only=False)
            for piece in slices(batch.column("_text")):
                found = words(piece)
                start, size = _checked(piece, found, batch.column("_spans").slice(piece.low, piece.size))
                shift = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                at = np.unique(np.repeat(start, size) + shift)
                hashes = _Ranges(found)(at, at + WINDOW)
                text = found.text[at]
                columns = [docs_[piece.low + text], (at - found.first[text]).astype(np.int32), hashes]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["doc", "start", "block"])

    return _with_spans(docs, spans, "inner").mapInArrow(run, "doc bigint, start int, block bigint")


def _later(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """First place of every block, and the rows at later places. Copies meet in partial sums first."""
    place = F.struct("doc", "start")
    first = rows.groupBy("block").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    again = first.where(F.col("first") < F.col("last")).select("block", "first")
    return first, rows.join(again, "block").where(place > F.col("first"))


def factors(docs: DataFrame) -> DataFrame:
    """Duplicate windows as rows of doc, start (word), size (windows from there) and block (their hash).

    A window is a duplicate if its words also start earlier: in a document with a smaller
    id, or before it in the same one. Null ids come last and count as one id, as rows that
    repeat an id do. Texts of fewer than ``WINDOW`` words, null and empty ones have no windows.
    """
    repeated = blocks(docs, anchors_only=True).groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor")
    shared = written(blocks(docs).join(repeated, "anchor"), "blocks")
    _, later = _later(shared)
    first = shared.groupBy("anchor", "block").agg(F.min(F.struct("doc", "start", "size")).alias("first"))
    first = written(first.select("anchor", "block", "first.*"), "first-blocks")
    differing = first.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor")
    borders = first.join(differing, "anchor").select("doc", "start", "size", "block")
    windows = written(_border_windows(_slim(docs), borders), "windows")
    _, later_windows = _later(windows)
    columns = ["doc", "start", "size", "block"]
    return later.select(*columns).unionByName(
        later_windows.withColumn("size", F.lit(1).cast("smallint")).select(*columns)
    )


def remove(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_removed and ``kept``, the words outside of all
    duplicate windows joined by one space. Windows are judged on the input, not on what is left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch.column("_text")):
                found = words(piece)
                start, size = _checked(piece, found, batch.column("_spans").slice(piece.low, piece.size))
                edge = np.zeros(len(found.hash) + 1, np.int64)
                np.add.at(edge, start, 1)
                np.add.at(edge, start + size + WINDOW - 1, -1)
                stays = np.cumsum(edge)[:-1] == 0
                data, kept = piece.data.tobytes(), []
                for low, high in zip(found.first[:-1].tolist(), found.first[1:].tolist()):
                    if stays[low:high].all():
                        own = data[found.start[low] : found.end[high - 1]].split() if high > low else []
                    else:
                        here = np.flatnonzero(stays[low:high]) + low
                        own = [data[a:b] for a, b in zip(found.start[here].tolist(), found.end[here].tolist())]
                    kept.append(b" ".join(own))
                left = np.bincount(found.text[stays], minlength=piece.size)
                rows = batch.slice(piece.low, piece.size)
                columns = [
                    rows.column("doc_id"), pa.array(found.counts.astype(np.int64)), pa.array(found.counts - left),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_removed", "kept"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    back = F.when(F.col("_doc") < _LAST, F.col("_doc")).cast(kind).alias("doc_id")
    empty = F.array().cast("array<struct<start: int, size: smallint, block: bigint>>")
    ready = _with_spans(_slim(docs), spans, "left").select(back, "_text", F.coalesce("_spans", empty).alias("_spans"))
    return ready.mapInArrow(run, f"doc_id {kind}, n_words bigint, n_removed bigint, kept string")
