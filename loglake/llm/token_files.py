"""Token ids as ORC files that training jobs read by stripes and look up by document.

A file is one shard: its documents stand in ascending order, their ids as a list of
integers, which ORC run-length encodes. Row indexes hold the least and greatest doc_id of
every few hundred rows and a Bloom filter of them, so a reader skips stripes and row
groups by their metadata; stripes are read in parallel. ``before`` counts the ids of a
document's predecessors in its shard; adding the ids of all earlier shards gives its place in the
whole corpus, from two narrow columns.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

END_ID = 2
STRIPE_BYTES = 16 << 20
#: Rows between two entries of a row index, and with it the rows that a Bloom filter covers.
STRIDE = 1000
BLOOM_FPP = 0.01
#: Texts that are encoded together hold about so many bytes.
SLICE_BYTES = 1 << 21
#: Words whose ids a task remembers before it starts afresh; bounds memory, not results.
REMEMBERED = 500_000
#: Control characters that count as blanks for ``str.split`` but not for the tokenizer.
NO_BLANKS = re.compile("[\x1c-\x1f]")
#: Marks that end a run of letters; an apostrophe may begin a piece of its own.
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


class Encoder:
    """The tokenizer of a file, asked once for each word between blanks.

    Its tokens never hold white space and blanks are dropped, so the ids of a text are
    those of its words, one after the other; a run of letters and the marks behind it are
    two pieces for it. Texts where a word's surroundings could matter
    (control characters, strings that look like a special token) are encoded as they are.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = sorted(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.known: dict[str, bytes] = {}

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, "<i4").tobytes() for x in found]

    def _runs(self, words: list[str]) -> list[bytes]:
        """Ids of runs of letters, of many at once: each ends with its only word-end token."""
        data = self._ids([" ".join(words)])[0]
        ends = 4 * np.flatnonzero(self.last[np.frombuffer(data, "<i4")]) + 4
        if len(ends) != len(words):
            return self._ids(words)
        cut = [0, *ends.tolist()]
        return [data[a:b] for a, b in zip(cut, cut[1:])]

    def _learn(self, words: set[str]) -> None:
        known, alone, marked, runs = self.known, [], [], set()
        for word in words:
            run = word.rstrip(MARKS)
            if run.isalpha():
                runs.add(run)
                if len(run) < len(word):
                    marked.append((word, run, word[len(run) :]))
            else:
                alone.append(word)
        alone += {marks for _, _, marks in marked}.difference(known)
        new = list(runs.difference(known))
        for low in range(0, len(new), 100):
            known.update(zip(new[low : low + 100], self._runs(new[low : low + 100])))
        # some at a time: the library keeps more about each word than its ids
        for low in range(0, len(alone), 10_000):
            known.update(zip(alone[low : low + 10_000], self._ids(alone[low : low + 10_000])))
        for word, run, marks in marked:
            known[word] = known[run] + known[marks]

    def encode(self, texts: Sequence[str | None], end: bytes = b"") -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers, then ``end``; null is empty."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        whole = [t for t in texts if t and (NO_BLANKS.search(t) or any(s in t for s in self.special))]
        whole_ids = dict(zip(whole, self._ids(whole)))
        words = [() if not t or t in whole_ids else _folded(t).split() for t in texts]
        self._learn(set().union(*words).difference(self.known))
        get = self.known.__getitem__
        return [whole_ids[t] + end if t in whole_ids else b"".join(map(get, own)) + end for t, own in zip(texts, words)]


def _folded(text: str) -> str:
    """The text in the tokenizer's lower case where Python's is sure to be the same."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return text
    return text.lower()


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.Array]]:
    """Keys and texts of the batches, some at a time, by size."""
    for batch in batches:
        sizes = pa.compute.binary_length(batch.column("_text")).fill_null(0).to_numpy(zero_copy_only=False)
        total = np.concatenate(([0], np.cumsum(sizes)))
        low = 0
        while low < batch.num_rows:
            high = max(low + 1, int(np.searchsorted(total, total[low] + SLICE_BYTES, side="right")) - 1)
            yield batch.column("doc_id").slice(low, high - low), batch.column("_text").slice(low, high - low)
            low = high


def encode_sorted(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """doc_id, shard, before, n_tokens and token_ids, in ascending order of doc_id.

    Texts are dealt out by ranges of doc_id; nulls come first, and rows of one id are ordered (and
    may be dealt out) by a hash of their text. A task is a shard and counts ids as it goes.
    """
    text = F.col("text").cast("string")
    rows = docs.select("doc_id", text.alias("_text"), F.xxhash64(text).alias("_tie"))
    rows = rows.repartitionByRange("doc_id", "_tie").sortWithinPartitions("doc_id", "_tie").drop("_tie")
    end = np.array([end_id], "<i4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, before = TaskContext.get().partitionId(), 0
        for keys, texts in _pieces(batches):
            ids = encoder(tokenizer).encode(texts.to_pylist(), end)
            cut = np.concatenate(([0], np.cumsum([len(i) // 4 for i in ids], dtype=np.int64)))
            flat = pa.Array.from_buffers(pa.int32(), int(cut[-1]), [None, pa.py_buffer(b"".join(ids))])
            lists = pa.ListArray.from_arrays(pa.array(cut, pa.int32()), flat)
            shards = pa.array(np.full(len(ids), shard, np.int32))
            yield pa.RecordBatch.from_arrays(
                [keys, shards, pa.array(before + cut[:-1]), pa.array(np.diff(cut)), lists],
                ["doc_id", "shard", "before", "n_tokens", "token_ids"],
            )
            before += int(cut[-1])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, shard int, before bigint, n_tokens bigint, token_ids array<int>")


def write(
    docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, stripe_bytes: int = STRIPE_BYTES, stride: int = STRIDE
) -> None:
    """Encodes every text of ``docs`` into the ORC files of a new folder, ``end_id`` behind each.

    Only ``doc_id`` and ``text`` are read, so further columns can have any name. A null or
    empty text is its end id alone. Rows are neither merged nor dropped; equal ids stand side by
    side. An empty table gives a folder without rows.
    """
    options = {
        "orc.compress": "ZSTD",
        "orc.stripe.size": str(stripe_bytes),
        # a stripe's size is looked at every so many rows, which may all be long
        "orc.rows.between.memory.checks": "100",
        "orc.create.index": "true",
        "orc.row.index.stride": str(stride),
        "orc.bloom.filter.columns": "doc_id",
        "orc.bloom.filter.fpp": str(BLOOM_FPP),
    }
    encode_sorted(docs, tokenizer, end_id).write.options(**options).orc(path)


def read(spark: SparkSession, path: str, ids: Sequence | None = None, low=None, high=None) -> DataFrame:
    """Documents of a folder of token files, all or some.

    ``ids`` (a few single documents) and ``low`` to ``high`` (a range, ends included) are pushed down to the
    files, whose indexes and Bloom filters decide which row groups are read at all.
    """
    rows = spark.read.orc(path)
    if ids is not None:
        rows = rows.where(F.col("doc_id").isin(list(ids)))
    if low is not None:
        rows = rows.where(F.col("doc_id") >= low)
    if high is not None:
        rows = rows.where(F.col("doc_id") <= high)
    return rows


def shard_starts(spark: SparkSession, path: str) -> DataFrame:
    """Ids before each shard: one row per file, from the two columns that count."""
    sizes = spark.read.orc(path).groupBy("shard").agg(F.max(F.col("before") + F.col("n_tokens")).alias("held"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("shard", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("earlier"))


def placed(spark: SparkSession, rows: DataFrame, path: str) -> DataFrame:
    """``rows`` of the folder ``path`` with ``start``, the number of ids of all documents before."""
    starts = shard_starts(spark, path)
    return rows.join(starts, "shard").withColumn("start", F.col("earlier") + F.col("before")).drop("earlier")


def with_crc(rows: DataFrame) -> DataFrame:
    """The columns but the ids, and the CRC-32 of the ids as little-endian 32-bit integers."""
    kept = [c for c in rows.columns if c != "token_ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("token_ids")
            ends = lists.offsets.to_numpy().astype(np.int64) * 4
            data = memoryview(np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), "<i4")).cast("B")
            crcs = [crc32(data[a:b]) for a, b in zip(ends.tolist(), ends[1:].tolist())]
            yield pa.RecordBatch.from_arrays([*map(batch.column, kept), pa.array(crcs, pa.int64())], [*kept, "ids_crc32"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*kept).schema.fields]
    return rows.mapInArrow(run, ", ".join([*fields, "ids_crc32 bigint"]))
