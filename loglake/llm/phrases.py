"""Phrase collocations counted in sorted counting quotient filters.

Frequent words get small numbers, so an n-gram packs into two integers of a few bits. An
invertible permutation (a Feistel network) spreads the packed n-grams evenly; its upper
bits are the quotient, which is stored as the number of entries of each slot, and all the other bits
are the remainder, which is stored in full. Together they give the n-gram back, so counts
are exact. A task keeps one filter in sorted order; filters of all tasks are cut at the same
quotients and merged in that order, range by range.

Longer n-grams are counted only where every shorter one inside is frequent: those of the
length before mark a bitmap of fixed size, which lets a few others through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loglake.llm.words import LOWER, Hasher, Slice, mix, runs, slices
from loglake.session import written

LEAST = 30
LONGEST = 4
#: A phrase goes if a longer one around it has so many percent of its occurrences.
PART_PERCENT = 80
FACTOR = 2_000_000
MOST = 2000
NO_LANG = "und"
#: Words whose numbers are sent to the tasks at a time.
DICTIONARY = 1 << 20
#: Words that a task counts before it hands them on.
COUNTED = 1 << 17
#: Entries that a task gathers before it sorts, and keeps before it hands its filter on.
GATHERED = 1 << 18
KEPT = 1 << 20
#: Entries that meet in one range of quotients, about.
RANGE = 1 << 21
#: Bits that mark frequent n-grams.
BITS = 1 << 26

_IS_BREAK = np.zeros(256, bool)
_IS_BREAK[[*b".,;:!?", 10, 11, 12, 13]] = True
_INSIDE = ~_IS_BREAK
_INSIDE[[9, 32]] = False


# --- the filter -----------------------------------------------------------------------


@dataclass(frozen=True)
class Layout:
    """Bits of an n-gram of numbers of ``bits`` bits: the first half packs into the upper
    integer, the rest into the lower one (at most 64 bits each)."""

    length: int
    bits: int

    @property
    def upper(self) -> int:
        return (self.length + 1) // 2 * self.bits

    @property
    def lower(self) -> int:
        return self.length // 2 * self.bits

    def pack(self, grams: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        half = (self.length + 1) // 2
        out = []
        for part in (grams[:half], grams[half:]):
            packed = np.zeros(len(grams[0]), np.uint64)
            for word in part:
                packed = (packed << np.uint64(self.bits)) | word.astype(np.uint64)
            out.append(packed)
        return out[0], out[1]

    def unpack(self, upper: np.ndarray, lower: np.ndarray) -> list[np.ndarray]:
        half, mask, out = (self.length + 1) // 2, _mask(self.bits), []
        for packed, n in ((upper, half), (lower, self.length - half)):
            out += [((packed >> np.uint64(self.bits * (n - 1 - k))) & mask).astype(np.int64) for k in range(n)]
        return out

    def permute(self, upper: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        up, low = _mask(self.upper), _mask(self.lower)
        upper = upper ^ (mix(lower + np.uint64(1)) & up)
        lower = lower ^ (mix(upper + np.uint64(2)) & low)
        return upper ^ (mix(lower + np.uint64(3)) & up), lower

    def restore(self, upper: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        up, low = _mask(self.upper), _mask(self.lower)
        upper = upper ^ (mix(lower + np.uint64(3)) & up)
        lower = lower ^ (mix(upper + np.uint64(2)) & low)
        return upper ^ (mix(lower + np.uint64(1)) & up), lower


def _mask(bits: int) -> np.uint64:
    return np.uint64((1 << bits) - 1)


@dataclass
class Filter:
    """Permuted n-grams in order, each once, with their counts."""

    layout: Layout
    upper: np.ndarray
    lower: np.ndarray
    count: np.ndarray

    def __len__(self) -> int:
        return len(self.count)

    @staticmethod
    def of(layout: Layout, upper: np.ndarray, lower: np.ndarray, count: np.ndarray | None = None) -> Filter:
        """Sorts and sums; parts that are sorted already are merged in linear time."""
        if layout.upper + layout.lower <= 64:
            shift = np.uint64(layout.lower)
            key = (upper << shift) | lower if layout.lower else upper
            if count is None:
                key, count = np.unique(key, return_counts=True)
                upper, lower = (key >> shift, key & _mask(layout.lower)) if layout.lower else (key, np.zeros_like(key))
                return Filter(layout, upper, lower, count.astype(np.int64))
            order = np.argsort(key, kind="stable")
        else:
            order = np.lexsort((lower, upper))
        upper, lower = upper[order], lower[order]
        count = np.ones(len(order), np.int64) if count is None else count[order]
        if not len(order):
            return Filter(layout, upper, lower, count)
        first = np.flatnonzero(np.concatenate(([True], (upper[1:] != upper[:-1]) | (lower[1:] != lower[:-1]))))
        return Filter(layout, upper[first], lower[first], np.add.reduceat(count, first))

    @staticmethod
    def merged(parts: list[Filter]) -> Filter:
        joined = (np.concatenate(x) for x in zip(*((p.upper, p.lower, p.count) for p in parts)))
        return Filter.of(parts[0].layout, *joined)

    def ranges(self, bits: int) -> Iterator[tuple[int, Filter]]:
        """The entries of every range of quotients that share their upper ``bits`` bits."""
        number = (self.upper >> np.uint64(self.layout.upper - bits)).astype(np.int64)
        cut = np.flatnonzero(np.concatenate(([True], number[1:] != number[:-1]))) if len(number) else np.zeros(0, np.int64)
        for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(number)]):
            yield int(number[a]), Filter(self.layout, self.upper[a:b], self.lower[a:b], self.count[a:b])

    def pack(self, bits: int) -> tuple[int, bytes, bytes, bytes, bytes]:
        """One range as quotient bits, slot sizes, both remainders and counts, in few bytes."""
        rest = self.layout.upper - bits
        quotient = min(rest, max(0, len(self).bit_length() - 1))
        within = self.upper & _mask(rest)
        slots = np.bincount((within >> np.uint64(rest - quotient)).astype(np.int64), minlength=1 << quotient)
        remainder = within & _mask(rest - quotient)
        return quotient, _narrow(slots), _narrow(remainder), _narrow(self.lower), _narrow(self.count)

    @staticmethod
    def unpack(layout: Layout, bits: int, number: int, quotient: int, slots: bytes, upper: bytes, lower: bytes, count: bytes) -> Filter:
        rest = layout.upper - bits
        sizes = _wide(slots, 1 << quotient).astype(np.int64)
        n = int(sizes.sum())
        within = np.repeat(np.arange(1 << quotient, dtype=np.uint64), sizes) << np.uint64(rest - quotient) | _wide(upper, n)
        whole = within | np.uint64(number << rest)
        return Filter(layout, whole, _wide(lower, n), _wide(count, n).astype(np.int64))


def _narrow(values: np.ndarray) -> bytes:
    """Unsigned integers in as few bytes each as the greatest needs."""
    width = max(1, -(-int(values.max(initial=0)).bit_length() // 8))
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def _wide(data: bytes, n: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    if n:
        out[:, : len(data) // n] = np.frombuffer(data, np.uint8).reshape(n, -1)
    return out.reshape(-1).view("<u8")


# --- words ----------------------------------------------------------------------------


def _split(piece: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word of a slice, and whether a piece of text begins with it."""
    start, end = runs(_INSIDE[piece.data], piece.offsets)
    breaks = np.concatenate(([0], np.cumsum(_IS_BREAK[piece.data], dtype=np.int64)))
    opens = np.ones(len(start), bool)
    text = piece.text_of(start)
    opens[1:] = (text[1:] != text[:-1]) | (breaks[start[1:]] != breaks[end[:-1]])
    return start, end, opens


def _keys(piece: Slice, data: np.ndarray, start: np.ndarray, end: np.ndarray, langs: np.ndarray) -> np.ndarray:
    """64-bit hash of every word with its document's language."""
    own = langs[piece.low : piece.high][piece.text_of(start)]
    return mix(Hasher(data).ranges(start, end) ^ own)


def _lang_hashes(column: pa.Array) -> tuple[list[str], np.ndarray]:
    names = column.to_pylist()
    known = {n: np.uint64(0) for n in set(names)}
    for name in known:
        raw = np.frombuffer(name.encode() or b"\0", np.uint8)
        known[name] = mix(Hasher(raw).ranges(np.array([0]), np.array([len(raw)])) + np.uint64(1 + len(name)))[0]
    return names, np.array([known[n] for n in names], np.uint64)


def _slim(docs: DataFrame) -> DataFrame:
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG))
    return docs.select(lang.alias("_lang"), F.col("text").cast("string").alias("_text"))


def count_words(docs: DataFrame) -> DataFrame:
    """lang, word, key (the hash that stands for both) and n of every word of a text; besides one row with a
    null word and the number of all words per language and task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list] = {}
        totals: dict[str, int] = {}

        def rows() -> pa.RecordBatch:
            columns = list(zip(*((lang, word, key, n) for key, (lang, word, n) in found.items()))) or [[]] * 4
            kinds = (pa.string(), pa.string(), pa.uint64(), pa.int64())
            arrays = [pa.array(c, t) for c, t in zip(columns, kinds)]
            arrays[2] = arrays[2].view(pa.int64())
            found.clear()
            return pa.RecordBatch.from_arrays(arrays, ["lang", "word", "key", "n"])

        for batch in batches:
            names, langs = _lang_hashes(batch.column("_lang"))
            for piece in slices(batch.column("_text")):
                data = LOWER[piece.data]
                start, end, _ = _split(piece)
                words = np.bincount(piece.text_of(start), minlength=piece.size).tolist()
                for name, n in zip(names[piece.low : piece.high], words):
                    totals[name] = totals.get(name, 0) + n
                keys, at, n = np.unique(_keys(piece, data, start, end, langs), return_index=True, return_counts=True)
                raw = data.tobytes()
                text = piece.text_of(start[at]).tolist()
                for key, a, b, t, c in zip(keys.tolist(), start[at].tolist(), end[at].tolist(), text, n.tolist()):
                    row = found.get(key)
                    if row is None:
                        found[key] = [names[piece.low + t], raw[a:b].decode(errors="replace"), c]
                    else:
                        row[2] += c
                if len(found) > COUNTED:
                    yield rows()
        yield rows()
        schema = pa.schema([("lang", pa.string()), ("word", pa.string()), ("key", pa.int64()), ("n", pa.int64())])
        yield pa.RecordBatch.from_pylist([{"lang": k, "n": n} for k, n in totals.items()], schema)

    return _slim(docs).mapInArrow(run, "lang string, word string, key bigint, n bigint")


def vocabulary(docs: DataFrame, least: int) -> tuple[DataFrame, DataFrame, int]:
    """Frequent words (id, lang, word, key, n) numbered from 1 without gaps, all words per
    language (lang, n), and how many frequent ones there are."""
    counted = count_words(docs).groupBy("lang", "word").agg(F.sum("n").alias("n"), F.min("key").alias("key"))
    counted = written(counted.where(F.col("word").isNull() | (F.col("n") >= least)), "words")
    totals = counted.where(F.col("word").isNull()).select("lang", "n")
    seen = F.monotonically_increasing_id()
    some = written(counted.where(F.col("word").isNotNull()).withColumn("_seen", seen), "numbered")
    part, place = F.shiftright("_seen", 33), F.col("_seen").bitwiseAND((1 << 33) - 1)
    sizes = some.groupBy(part.alias("_part")).agg(F.count("*").alias("held"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("_part", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("earlier"))
    numbered = some.withColumn("_part", part).join(sizes, "_part")
    words = numbered.select((F.col("earlier") + place + 1).alias("id"), "lang", "word", "key", "n")
    words = written(words, "vocabulary")
    return words, totals, words.count()


def number_words(docs: DataFrame, words: DataFrame, size: int) -> DataFrame:
    """Every slice of texts as numbers of its words, ``numbers`` (little-endian, four bytes): 0
    for a word that is not frequent and before every piece of text.

    The dictionary goes to the tasks in parts of ``DICTIONARY`` words. One part is the usual
    case; with more, the words' hashes are stored and numbered part by part.
    """
    context = docs.sparkSession.sparkContext
    parts = [(low, low + DICTIONARY) for low in range(1, size + 1, DICTIONARY)]

    def part_of(low: int, high: int):
        rows = words.where(F.col("id").between(low, high - 1)).select("key", "id").toPandas()
        keys = rows["key"].to_numpy(np.int64).view(np.uint64)
        order = np.argsort(keys)
        return context.broadcast((keys[order], rows["id"].to_numpy(np.int64)[order]))

    def looked_up(shared, keys: np.ndarray) -> np.ndarray:
        known, ids = shared.value
        if not len(known):
            return np.zeros(len(keys), np.int64)
        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        return np.where(known[at] == keys, ids[at], 0)

    def with_breaks(values: np.ndarray, opens: np.ndarray, gap) -> np.ndarray:
        return np.insert(values, np.flatnonzero(opens), gap)

    def scan(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                _, langs = _lang_hashes(batch.column("_lang"))
                for piece in slices(batch.column("_text")):
                    start, end, opens = _split(piece)
                    keys = _keys(piece, LOWER[piece.data], start, end, langs)
                    if shared is None:
                        out = (with_breaks(np.zeros(len(keys), "<u4"), opens, 0), with_breaks(keys, opens, 0))
                    else:
                        out = (with_breaks(looked_up(shared, keys).astype("<u4"), opens, 0), np.zeros(0, np.uint64))
                    yield pa.RecordBatch.from_arrays([pa.array([o.tobytes()], pa.binary()) for o in out], ["numbers", "keys"])

        return run

    def again(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for numbers, keys in zip(*(c.to_pylist() for c in batch.columns)):
                    found = looked_up(shared, np.frombuffer(keys, np.uint64))
                    both = np.maximum(np.frombuffer(numbers, "<u4"), found.astype("<u4"))
                    yield pa.RecordBatch.from_arrays([pa.array([both.tobytes()], pa.binary()), pa.array([keys], pa.binary())], ["numbers", "keys"])

        return run

    schema = "numbers binary, keys binary"
    first = part_of(*parts[0]) if len(parts) == 1 else None
    numbered = written(_slim(docs).mapInArrow(scan(first), schema), "numbers")
    for part in parts if len(parts) > 1 else []:
        numbered = written(numbered.mapInArrow(again(part_of(*part)), schema), "numbers")
    return numbered.select("numbers")


# --- counting -------------------------------------------------------------------------


def _mark(grams: list[np.ndarray]) -> np.ndarray:
    """Which bit of the bitmap an n-gram sets."""
    total = np.zeros(len(grams[0]), np.uint64)
    for word in grams:
        total = mix(total + word.astype(np.uint64))
    return (total & np.uint64(BITS - 1)).astype(np.int64)


def _bitmap(grams: DataFrame) -> np.ndarray:
    """``BITS / 8`` bytes, however many n-grams there are."""
    page = 1 << 15
    number = (F.col("mark") / page).cast("int")
    rows = grams.groupBy(number.alias("page")).agg(F.bitmap_construct_agg(F.col("mark") % page).alias("bits"))
    bits = np.zeros(BITS // 8, np.uint8)
    for row in rows.collect():
        bits[row.page << 12 : (row.page + 1) << 12] = np.frombuffer(bytes(row.bits), np.uint8)
    return bits


def _possible(numbers: np.ndarray, length: int, bits: np.ndarray | None) -> list[np.ndarray]:
    """The n-grams of a slice of frequent words whose shorter ones are marked."""
    n = len(numbers) - length + 1
    if n <= 0:
        return [np.zeros(0, np.uint32)] * length
    able = np.ones(n, bool)
    for k in range(length):
        able &= numbers[k : k + n] > 0
    at = np.flatnonzero(able)
    if bits is not None and len(at):
        for k in (0, 1):
            mark = _mark([numbers[at + k + j] for j in range(length - 1)])
            at = at[(bits[mark >> 3] >> (mark & 7).astype(np.uint8)) & 1 == 1]
    return [numbers[at + k] for k in range(length)]


def count_ngrams(numbered: DataFrame, layout: Layout, ranges: int, least: int, shorter: DataFrame | None) -> DataFrame:
    """Frequent n-grams: ``words`` (their numbers), a (occurrences) and mark."""
    context = numbered.sparkSession.sparkContext
    shared = None if shorter is None else context.broadcast(_bitmap(shorter))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if shared is None else shared.value
        kept: list[Filter] = []
        gathered: list[tuple[np.ndarray, np.ndarray]] = []
        waiting = 0

        def sort() -> None:
            nonlocal waiting
            if gathered:
                upper, lower = (np.concatenate(x) for x in zip(*gathered))
                gathered.clear()
                waiting = 0
                kept.append(Filter.of(layout, *layout.permute(upper, lower)))
            # filters of like size are merged, so each entry is moved a few times only
            while len(kept) > 1 and (2 * len(kept[-1]) >= len(kept[-2]) or sum(map(len, kept)) > KEPT):
                kept.append(Filter.merged([kept.pop(), kept.pop()]))

        def rows() -> Iterator[pa.RecordBatch]:
            kinds = [pa.int64(), pa.int32(), *[pa.binary()] * 4]
            for whole in kept:
                parts = whole.ranges(ranges)
                while some := [(number, *part.pack(ranges)) for number, part in islice(parts, 16)]:
                    arrays = [pa.array(c, t) for c, t in zip(zip(*some), kinds)]
                    yield pa.RecordBatch.from_arrays(arrays, ["number", "quotient", "slots", "upper", "lower", "counts"])
            kept.clear()

        for batch in batches:
            for data in batch.column("numbers").to_pylist():
                grams = _possible(np.frombuffer(data, "<u4"), layout.length, bits)
                gathered.append(layout.pack(grams))
                waiting += len(grams[0])
                if waiting > GATHERED:
                    sort()
                    if sum(map(len, kept)) > KEPT:
                        yield from rows()
        sort()
        yield from rows()

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        parts = zip(*(table.column(c).to_pylist() for c in ("quotient", "slots", "upper", "lower", "counts")))
        whole = Filter.merged([Filter.unpack(layout, ranges, key[0].as_py(), *p) for p in parts])
        often = whole.count >= least
        grams = layout.unpack(*layout.restore(whole.upper[often], whole.lower[often]))
        flat = np.stack(grams, axis=1).reshape(-1) if len(grams[0]) else np.zeros(0, np.int64)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(grams[0]) + 1) * layout.length, pa.int32()), pa.array(flat))
        return pa.table({"words": lists, "a": whole.count[often], "mark": _mark(grams)})

    schema = "number bigint, quotient int, slots binary, upper binary, lower binary, counts binary"
    filters = numbered.mapInArrow(run, schema)
    return filters.groupBy("number").applyInArrow(merge, "words array<bigint>, a bigint, mark bigint")


def ngrams(docs: DataFrame, least: int, longest: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All frequent runs of up to ``longest`` words (words, a), the vocabulary and all words per language."""
    words, totals, size = vocabulary(docs, least)
    totals = written(totals, "totals")
    single = words.select(F.array("id").alias("words"), F.col("n").alias("a"))
    if not size:
        return single, words, totals
    bits = size.bit_length()
    if bits > 32 or bits * ((longest + 1) // 2) > 64:
        raise ValueError(f"{size} frequent words do not pack into 64 bits by {(longest + 1) // 2}")
    everything = totals.agg(F.sum("n")).first()[0]
    numbered = number_words(docs, words, size)
    found, shorter = single, None
    for length in range(2, longest + 1):
        layout = Layout(length, bits)
        ranges = min(layout.upper, max(5, (everything // RANGE).bit_length()))
        shorter = written(count_ngrams(numbered, layout, ranges, least, shorter), f"{length}-grams")
        found = found.unionByName(shorter.select("words", "a"))
    return found, words, totals


# --- phrases --------------------------------------------------------------------------


def _cut(low: Column | int, size: Column) -> Column:
    return F.slice("words", low, size)


def phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, most: int = MOST, part_percent: int = PART_PERCENT) -> DataFrame:
    """Each language's ``most`` strongest phrases of 2 to ``longest`` words: lang, rank, phrase, a, l, r,
    n and score.

    Texts are cut at punctuation and line ends; only ``lang`` (null: ``und``) and ``text`` (null: empty) are
    read. Repeated rows count as often as they stand there. Ties go to the greater a, then to the
    phrase that comes first by bytes. Texts without phrases, and empty tables, give no rows.
    """
    found, words, totals = ngrams(docs, least, longest)
    size = F.size("words")
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    candidates = found.where(size > 1)

    around = found.where(size > 2).select(
        F.col("a").alias("_a"),
        F.explode(
            F.flatten(
                F.transform(F.sequence(F.lit(2), size - 1), lambda n: F.transform(F.sequence(F.lit(1), size - n + 1), lambda i: F.slice("words", i, n)))
            )
        ).alias("words"),
    )
    around = around.groupBy("words").agg(F.max("_a").alias("_a"))
    inside = F.coalesce(wide("_a") * 100 >= wide("a") * part_percent, F.lit(False))
    standing = candidates.join(around, "words", "left").where(~inside).select("words", "a")

    cuts = standing.select("words", "a", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.withColumns({"first": _cut(1, F.col("k")), "rest": _cut(F.col("k") + 1, size - F.col("k"))})
    counts = found.select(F.col("words").alias("first"), F.col("a").alias("l"))
    cuts = cuts.join(counts, "first").join(counts.withColumnsRenamed({"first": "rest", "l": "r"}), "rest")
    score = F.expr(f"(cast(a as decimal(20, 0)) * {FACTOR}) div (cast(l as decimal(20, 0)) + r)")
    cuts = cuts.withColumn("score", score.cast("bigint"))
    weakest = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    scored = cuts.groupBy("words").agg(F.max("a").alias("a"), weakest).select("words", "a", "cut.l", "cut.r", "cut.score")

    lang = words.select(F.col("id").alias("_id"), "lang")
    scored = written(scored.withColumn("_id", F.get("words", F.lit(0))).join(lang, "_id").drop("_id"), "scored")
    # the words themselves are fetched for what can be among the first only
    strength = [F.desc("score"), F.desc("a")]
    close = scored.withColumn("_at", F.rank().over(Window.partitionBy("lang").orderBy(*strength))).where(F.col("_at") <= most)
    spelled = close.select("lang", "words", "a", "l", "r", "score", F.posexplode("words").alias("_k", "_id"))
    spelled = spelled.join(words.select(F.col("id").alias("_id"), "word"), "_id").groupBy("lang", "words", "a", "l", "r", "score").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_k", "word"))), lambda x: x["word"]), " ").alias("phrase")
    )
    place = F.row_number().over(Window.partitionBy("lang").orderBy(*strength, "phrase"))
    ranked = spelled.withColumn("rank", place.cast("bigint")).where(F.col("rank") <= most)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
