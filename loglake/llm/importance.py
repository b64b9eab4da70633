"""Target-distribution importance resampling on hashed n-grams whose CRCs come from prefixes.

A document is lower-cased (A-Z) and its words are joined by one space. It is scanned
once, and the running CRC-32 at the end of every word is kept. The CRC is linear over
GF(2): with v(i) the CRC of the first i bytes, the CRC of the bytes i to j is
``v(j) xor shift(v(i), j - i)``, where ``shift`` appends zero bytes to a register. So the
CRC of any n-gram takes two prefixes and no second look at its bytes. Shifts by powers
of two are tables, made from the polynomial and squared.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loglake.session import written

POLYNOMIAL = 0xEDB88320
#: Bytes that separate words become blanks, A-Z become a-z; bytes of other alphabets stay.
NORMAL = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).lower()
#: Texts that are put through numpy together hold about so many bytes.
SLICE_BYTES = 1 << 20


def _byte_table() -> np.ndarray:
    """What a register's lowest byte adds once it has been shifted out."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> np.uint32(1)) ^ np.where(table & 1, np.uint32(POLYNOMIAL), np.uint32(0))
    return table


_STEP = _byte_table()
_ONES = np.uint32(0xFFFFFFFF)


def _push(register: np.ndarray, byte: int) -> np.ndarray:
    return _STEP[(register ^ np.uint32(byte)) & np.uint32(255)] ^ (register >> np.uint32(8))


def _applied(lanes: np.ndarray, register: np.ndarray) -> np.ndarray:
    """A linear map, given for every value of each of the four bytes, of every register."""
    low = np.uint32(255)
    out = lanes[0][register & low]
    for lane in (1, 2, 3):
        out = out ^ lanes[lane][(register >> np.uint32(8 * lane)) & low]
    return out


def _shifts(bits: int = 31) -> list[np.ndarray]:
    """Maps that append 1, 2, 4, ... zero bytes."""
    lanes = np.stack([_push(np.arange(256, dtype=np.uint32) << np.uint32(8 * k), 0) for k in range(4)])
    maps = [lanes]
    for _ in range(bits - 1):
        maps.append(np.stack([_applied(maps[-1], lane) for lane in maps[-1]]))
    return maps


_SHIFTS = _shifts()


def shift(register: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Every register after ``length`` zero bytes."""
    out = register.copy()
    for bit in range(int(length.max(initial=0)).bit_length()):
        some = np.flatnonzero((length >> bit) & 1)
        out[some] = _applied(_SHIFTS[bit], out[some])
    return out


class Prefixes:
    """Running CRCs of some normalised documents: before and behind every word."""

    def __init__(self, texts: list[bytes | None]):
        ends: list[int] = []
        sizes: list[int] = []
        counts = []
        for text in texts:
            words = (text or b"").translate(NORMAL).split()
            counts.append(len(words))
            if words:
                # every word but the first is scanned with the blank before it
                pieces = b"\0 ".join(words).split(b"\0")
                ends += accumulate(pieces, lambda crc, piece: crc32(piece, crc), initial=0)
                ends.pop(-len(pieces) - 1)
                sizes += map(len, pieces)
        self.counts = np.array(counts, np.int64)
        self.first = np.concatenate(([0], np.cumsum(self.counts)))
        self.behind = np.array(ends, np.uint32)
        opening = np.zeros(len(ends), bool)
        opening[self.first[:-1][self.counts > 0]] = True
        before = np.zeros(len(ends), np.uint32)
        before[1:] = _push(self.behind[:-1] ^ _ONES, 0x20) ^ _ONES
        before[opening] = 0
        self.before = before
        size = np.array(sizes, np.int64)
        # places of the words' ends and starts in all texts put together
        self.end = np.cumsum(size)
        self.start = self.end - size + ~opening
        self.text = np.repeat(np.arange(len(texts)), self.counts)

    def ngrams(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """CRC of every run of ``length`` words of one document, and the document's index."""
        count = len(self.behind) - length + 1
        if count <= 0:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        at = np.flatnonzero(self.text[:count] == self.text[length - 1 :])
        last = at + length - 1
        return self.behind[last] ^ shift(self.before[at], self.end[last] - self.start[at]), self.text[at]


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[int, list[bytes | None]]]:
    """First row and texts of pieces of about ``SLICE_BYTES``; a longer text is one of its own."""
    sizes = pa.compute.binary_length(batch.column("_text")).fill_null(0).to_numpy(zero_copy_only=False)
    total = np.concatenate(([0], np.cumsum(sizes)))
    low = 0
    while low < batch.num_rows:
        high = max(low + 1, int(np.searchsorted(total, total[low] + SLICE_BYTES, side="right")) - 1)
        yield low, batch.column("_text").slice(low, high - low).to_pylist()
        low = high


def features(docs: DataFrame, key: str, shortest: int, longest: int, buckets: int) -> DataFrame:
    """``key``, n_words and the buckets of all n-grams of every text, as packed little-endian
    integers of two bytes (four beyond 65,536 buckets). Null and empty texts have none."""
    kind = "<u2" if buckets <= 1 << 16 else "<u4"
    slim = docs.select(F.col(key).alias("_key"), F.col("text").cast("string").cast("binary").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, texts in _slices(batch):
                known = Prefixes(texts)
                found = [known.ngrams(n) for n in range(shortest, longest + 1)]
                crcs, owner = (np.concatenate(x) for x in zip(*found))
                if len(found) > 1:
                    order = np.argsort(owner, kind="stable")
                    crcs, owner = crcs[order], owner[order]
                packed = (crcs % np.uint32(buckets)).astype(kind).tobytes()
                width = np.dtype(kind).itemsize
                cut = (width * np.searchsorted(owner, np.arange(len(texts) + 1))).tolist()
                lists = [packed[a:b] for a, b in zip(cut, cut[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_key").slice(low, len(texts)), pa.array(known.counts), pa.array(lists, pa.binary())],
                    ["_key", "n_words", "buckets"],
                )

    schema = f"_key {slim.schema['_key'].dataType.simpleString()}, n_words bigint, buckets binary"
    return slim.mapInArrow(run, schema)


def _unpacked(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """All buckets of a batch and where each row's end."""
    rows = column.to_pylist()
    flat = np.frombuffer(b"".join(rows), kind)
    return flat, np.cumsum([len(r) // np.dtype(kind).itemsize for r in rows], dtype=np.int64)


def bucket_counts(found: DataFrame, buckets: int) -> DataFrame:
    """Occurrences per bucket; a task sends one row for each of its buckets at most."""
    kind = "<u2" if buckets <= 1 << 16 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            total += np.bincount(_unpacked(batch.column("buckets"), kind)[0], minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["bucket", "n"])

    rows = found.select("buckets").mapInArrow(run, "bucket bigint, n bigint")
    return rows.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """What a feature of each bucket adds: ``buckets`` integers, whatever the input."""
    spark = corpus.sparkSession
    all_of = spark.range(buckets).withColumnRenamed("id", "bucket")
    held = all_of.join(corpus.withColumnRenamed("n", "s"), "bucket", "left").join(target.withColumnRenamed("n", "t"), "bucket", "left")
    held = written(held.na.fill(0, ["s", "t"]), "bucket-counts")
    sums = held.agg((F.sum("s") + buckets).alias("S"), (F.sum("t") + buckets).alias("T")).first()
    s, t = F.col("s").cast("double") + 1, F.col("t").cast("double") + 1
    ratio = t * F.lit(float(sums.S)) / (s * F.lit(float(sums.T)))
    rows = held.select("bucket", F.floor(F.log(ratio) * 1000).alias("gain")).toPandas()
    out = np.zeros(buckets, np.int64)
    out[rows["bucket"].to_numpy()] = rows["gain"].to_numpy()
    return out


def weights(found: DataFrame, gain: np.ndarray) -> DataFrame:
    """Floored mean gain of every document's features; 0 without any."""
    kind = "<u2" if len(gain) <= 1 << 16 else "<u4"
    shared = found.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, ends = _unpacked(batch.column("buckets"), kind)
            total = np.concatenate(([0], np.cumsum(shared.value[flat])))
            n = np.diff(ends, prepend=0)
            weight = (total[ends] - total[ends - n]) // np.maximum(n, 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_key"), batch.column("n_words"), pa.array(n), pa.array(weight)],
                ["_key", "n_words", "n_features", "weight"],
            )

    return found.mapInArrow(run, f"_key {found.schema['_key'].dataType.simpleString()}, n_words bigint, n_features bigint, weight bigint")


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 10,
    shortest: int = 1,
    longest: int = 1,
    buckets: int = 10_000,
    least_words: int = 20,
    seed: int = 2024,
    key: str = "doc_id",
) -> DataFrame:
    """Draws ``percent`` of the documents of ``least_words`` words and more, those whose
    n-grams are likelier in ``target`` than in ``docs`` first, with Gumbel noise by seed and key.

    Returns for every row of ``docs`` key, n_features, weight, score and rank (null if it is
    not drawn). Only the key and ``text`` are read. Null and empty texts have no features,
    weight 0 and are never drawn unless ``least_words`` is 0; a null key hashes as an empty one and comes
    last among equal scores. Ties go to the smaller key; rows of one key and score take
    neighbouring ranks in the order of n_features and weight. Empty tables give no rows, and an empty target equal counts.
    """
    with_buckets = written(features(docs, key, shortest, longest, buckets), "features")
    wanted = features(target.select(F.lit(0).alias("_key"), "text"), "_key", shortest, longest, buckets)
    gain = gains(bucket_counts(with_buckets, buckets), bucket_counts(wanted, buckets), buckets)

    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("_key").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.log(-F.log((h + 0.5) / 4294967296)) * -1000)
    scored = written(weights(with_buckets, gain).withColumn("score", F.col("weight") + noise), "scored")

    able = F.col("n_words") >= least_words
    drawn = scored.agg(F.count_if(able)).first()[0] * percent // 100
    # scores are integers in a range that the noise's 32 bits and the gains bound, so they are few
    histogram = scored.where(able).groupBy("score").agg(F.count("*").alias("held"))
    higher = Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    histogram = histogram.withColumn("higher", F.coalesce(F.sum("held").over(higher), F.lit(0)))
    histogram = written(histogram.where(F.col("higher") < drawn).select("score", "higher"), "ranks")
    last = histogram.agg(F.min("score")).first()[0]

    rest = scored if last is None else scored.where(~able | (F.col("score") < last))
    rest = rest.withColumn("rank", F.lit(None).cast("bigint"))
    among = Window.partitionBy("score").orderBy(F.asc_nulls_last("_key"), "n_features", "weight")
    place = F.row_number().over(among) + F.col("higher")
    chosen = scored.where(able).join(histogram, "score").withColumn("rank", place.cast("bigint"))
    chosen = chosen.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    columns = (F.col("_key").alias(key), "n_features", "weight", "score", "rank")
    return rest.select(*columns).unionAll(chosen.select(*columns))
