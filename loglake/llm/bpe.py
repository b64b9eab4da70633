"""BPE encoding and decoding with a vocabulary that ends words with a marker.

One pre-token is encoded by a priority queue of merge ranks over a doubly linked list of
symbols; queue entries whose symbols have since been merged are stale and skipped.
Decoding joins the vocabulary's strings. Spark hands every task batches of texts; a task
keeps the pre-tokens it has met, so most of them are looked up.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglake.session import released

#: Output batches hold about so many characters of text.
BATCH_CHARS = 1 << 21
#: Pre-tokens that a task remembers before it starts afresh; bounds memory, not results.
REMEMBERED = 400_000
#: What a task leaves for the next one in its worker, which later stages use too: more than so many are forgotten.
LEFT = 50_000


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte: itself where it is printable
    Latin, else the next free code point from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    alphabet, free = {b: chr(b) for b in shown}, 256
    for b in range(256):
        if b not in alphabet:
            alphabet[b], free = chr(free), free + 1
    return [alphabet[b] for b in range(256)]


def _for_latin(pattern: str) -> str:
    """The pattern for texts of Latin-1 characters only, with classes spelled out: the
    standard matcher has none by category, but is faster."""
    classes = {}
    for name, member in ((r"\p{L}", "L"), (r"\p{N}", "N")):
        classes[name] = "".join(re.escape(chr(c)) for c in range(256) if unicodedata.category(chr(c))[0] == member)
    classes[r"\s"] = "\\t-\\r \x85\xa0"
    for name, members in classes.items():
        pattern = pattern.replace(f"[{name}]", name).replace(name, f"[{members}]")
    # inside a negated class the members stand without brackets of their own
    return re.sub(r"\[\^(.*)\]\+$", lambda m: "[^" + "".join(classes.values()) + "]+", pattern)


class _Known(dict):
    """Packed ids of the pre-tokens met so far; others are merged on first use."""

    def __init__(self, merge):
        self.merge = merge

    def __missing__(self, word: str) -> bytes:
        ids = self[word] = array("I", self.merge(word)).tobytes()
        return ids


class Vocabulary:
    """Merge ranks, ids and strings of one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        ids, suffix = model["vocab"], model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        strings = {i: s for s, i in ids.items()} | {i: s for s, i in self.special.items()}
        self.strings = [strings[i] for i in range(max(strings) + 1)]
        #: rank by pair, and by rank both symbols and the symbol they become
        self.ranks: dict[tuple[int, int], int] = {}
        self.left, self.right, self.joined = [], [], []
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[ids[left], ids[right]] = rank
            self.left.append(ids[left])
            self.right.append(ids[right])
            self.joined.append(ids[left + right])
        alphabet = byte_alphabet()
        self.plain = [ids[c] for c in alphabet]
        self.final = [ids[c + suffix] for c in alphabet]
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = regex.compile(split.replace(r"\s", r"\p{White_Space}"))
        self.latin_words = re.compile(_for_latin(split))
        parts = sorted(self.special, key=len, reverse=True)
        self.marks = regex.compile("|".join(map(regex.escape, parts))) if parts else None
        self.known = _Known(self.merge)

    def merge(self, word: str) -> list[int]:
        """Ids of one pre-token."""
        data = word.encode("utf-8")
        symbols = [self.plain[b] for b in data]
        symbols[-1] = self.final[data[-1]]
        count = len(symbols)
        ranks, left, right = self.ranks.get, self.left, self.right
        #: entries are rank * 2**32 + place, so that they compare as one number
        queue = []
        for i, rank in enumerate(map(ranks, zip(symbols, symbols[1:]))):
            if rank is not None:
                queue.append(rank << 32 | i)
        if not queue:
            return symbols
        heapify(queue)
        before = list(range(-1, count - 1))
        after = [*range(1, count), -1]
        while queue:
            entry = heappop(queue)
            i, rank = entry & 0xFFFFFFFF, entry >> 32
            if symbols[i] != left[rank]:
                continue  # stale
            j = after[i]
            if j < 0 or symbols[j] != right[rank]:
                continue
            symbols[i] = joined = self.joined[rank]
            symbols[j] = -1
            k = after[i] = after[j]
            if k >= 0:
                before[k] = i
                rank = ranks((joined, symbols[k]))
                if rank is not None:
                    heappush(queue, rank << 32 | i)
            h = before[i]
            if h >= 0:
                rank = ranks((symbols[h], joined))
                if rank is not None:
                    heappush(queue, rank << 32 | h)
        return [s for s in symbols if s >= 0]

    def _plain_text(self, text: str) -> bytes:
        if not text.isascii():
            # lower case is taken letter by letter, so a sigma knows no word end
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        try:
            text.encode("latin-1")
            found = self.latin_words.findall(text)
        except UnicodeEncodeError:
            found = self.words.findall(text)
        if len(self.known) > REMEMBERED:
            self.known.clear()
        return b"".join(map(self.known.__getitem__, found))

    def encode(self, text: str | None) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers; null is empty."""
        if not text:
            return b""
        if self.marks is None or not self.marks.search(text):
            return self._plain_text(text)
        out, at = [], 0
        for m in self.marks.finditer(text):
            out.append(self._plain_text(text[at : m.start()]))
            out.append(np.array([self.special[m.group()]], "<u4").tobytes())
            at = m.end()
        return b"".join([*out, self._plain_text(text[at:])])

    def decode(self, ids: bytes) -> str:
        """The strings of the ids, one space between two of them."""
        return " ".join(map(self.strings.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _some(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Pieces of the batches with about ``limit`` characters or bytes of ``column``."""
    for batch in batches:
        sizes = pa.compute.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        low, total = 0, np.cumsum(sizes)
        while low < batch.num_rows:
            base = total[low - 1] if low else 0
            high = max(low + 1, int(np.searchsorted(total, base + limit, side="right")))
            piece = batch.slice(low, high - low)
            yield piece, piece.column(column).to_pylist()
            low = high


def encode(docs: DataFrame, path: str, decoded: bool = False, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Token ids of every text: ``keep`` columns, ``token_ids`` (little-endian unsigned
    32-bit integers, the usual form of training shards) and, with ``decoded``, the text
    that these ids decode to.

    A null or empty text has no ids and decodes to the empty text. Rows are neither
    merged nor dropped: repeated rows are encoded again. Only ``keep`` and ``text`` are
    read, so further columns of ``docs`` can have any name.
    """
    slim = docs.select(*(F.col(c) for c in keep), F.col("text").cast("string").alias("_text"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in slim.select(*keep).schema.fields]
    schema = ", ".join([*fields, "token_ids binary", *(["decoded string"] if decoded else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        try:
            yield from encoded(batches, vocab)
        finally:
            if len(vocab.known) > LEFT:
                vocab.known.clear()

    def encoded(batches: Iterator[pa.RecordBatch], vocab: Vocabulary) -> Iterator[pa.RecordBatch]:
        for piece, texts in _some(batches, "_text", BATCH_CHARS):
            ids = [vocab.encode(t) for t in texts]
            columns = [piece.column(c) for c in keep] + [pa.array(ids, pa.binary())]
            if decoded:
                columns.append(pa.array([vocab.decode(i) for i in ids], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, [*keep, "token_ids", *(["decoded"] if decoded else [])])

    return slim.mapInArrow(released(run), schema)


def decode(encoded: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Text of every row of ``token_ids``; null ids decode to the empty text."""
    slim = encoded.select(*(F.col(c) for c in keep), F.col("token_ids"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in slim.select(*keep).schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for piece, ids in _some(batches, "token_ids", 4 * BATCH_CHARS):
            texts = pa.array([vocab.decode(i or b"") for i in ids], pa.string())
            yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in keep), texts], [*keep, "decoded"])

    return slim.mapInArrow(run, ", ".join([*fields, "decoded string"]))


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Per document: number of tokens and SHA-256 of its ids and of its decoded text."""
    return encode(docs, path, decoded=True).select(
        "doc_id",
        (F.length("token_ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
