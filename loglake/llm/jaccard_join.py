"""N-gram Jaccard join in the metric space of shingle sets.

Documents with equal sets form a class; one set stands for it. Pivots are sets, every
set belongs to the regions of the pivots it can be near, and the triangle inequality of the Jaccard
distance decides who has to be compared with whom: two sets within the radius have
distances to a pivot that differ by the radius at most.

Unrelated documents all lie at distance 1 from each other and from any pivot, so distances
alone would replicate every set into every region. Regions are therefore opened by
shingles: in an order that puts rare shingles first, two sets within the radius share one of their first
``n - ceil(0.8 n) + 1`` shingles, so the sets that hold one shingle there form a region,
and every link lies inside one.

A region's pivot is its set with the fewest rare shingles; sets that it cannot link get further pivots. Each set
is compared with its nearest pivots, and what they tie together is one component. Regions that
still hold several components are joined inside tasks: a region of more than ``BLOCK`` sets is cut into windows of the
distance to its pivot, with the boundary sets in the next window too, and a window that stays large into pairs of blocks. There
every pair of different components is bounded from above by its counts of shingles per hash bucket, and only
pairs that may link leave the task. First the two best pairs of any two components are compared by their whole sets, then the
rest that is still apart. The components are exact, up to collisions of 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loglake.llm.components import components
from loglake.llm.words import Slice, mix, shingles, slices, words
from loglake.session import arrow_rows, released, written

GRAM = 5
PERCENT = 80
RADIUS = 1 - PERCENT / 100
#: A shingle is common if it is counted so often, counting only what repeats among some
#: neighbouring documents of a task. Common shingles come last in the order; what is missed costs time, not links.
COMMON = 16
LOCAL = 2
MOST_COMMON = 1 << 18
#: Shingles that a task holds while it counts repeats, about; documents of an Arrow batch, and bytes of text hashed at once.
COUNTED, BATCH, SLICE = 1 << 21, 2000, 1 << 18
#: Sets of a region, window or block that are compared with each other in one task.
BLOCK = 1024
#: Pivots that a region tries to give each set a near one.
PIVOTS = 4
#: Best pairs compared for each set, and for any two components, before the rest is.
BEST = 2
#: Hash buckets a set's shingles are counted in; sets of more than ``LONG`` shingles have the finer ones.
BUCKETS, FINE, LONG = 256, 2048, 2048
#: Bits that mark documents whose sets are needed.
BITS = 1 << 26


def sets(piece: Slice) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text of a slice; A-Z count as a-z. A text of
    fewer than five words has its whole sequence as its only shingle, without words none."""
    found = words(piece, lower=True)
    values, at = shingles(found, GRAM)
    cut = np.searchsorted(at, found.first)
    out = []
    for t, count in enumerate(found.counts.tolist()):
        if count >= GRAM:
            own = np.sort(values[cut[t] : cut[t + 1]])
            own = own[np.concatenate(([True], own[1:] != own[:-1]))]
        elif count:
            whole = np.uint64(count)
            for h in found.hash[found.first[t] : found.first[t + 1]]:
                whole = mix(np.array([whole ^ h]))[0]
            own = np.array([whole], np.uint64)
        else:
            own = np.zeros(0, np.uint64)
        out.append(own)
    return out


def class_of(own: np.ndarray) -> int:
    """Hash of a set, whatever the order of its members."""
    total = mix(own).sum(dtype=np.uint64) + np.uint64(len(own))
    return int(mix(np.array([total])).view(np.int64)[0])


def sketch(own: np.ndarray) -> bytes:
    """Shingles counted by bucket: two sets share at most the sum of their lesser counts."""
    buckets = BUCKETS if len(own) <= LONG else FINE
    counts = np.bincount((own & np.uint64(buckets - 1)).astype(np.int64), minlength=buckets)
    return counts.astype(np.min_scalar_type(counts.max())).tobytes()


class Sketches:
    """Sketches of many sets, as matrices; a fine one is folded where its partner is coarse."""

    def __init__(self, rows: list[bytes], n: np.ndarray):
        self.n = n
        fine = n > LONG
        self.place = np.cumsum(fine) - 1
        # no bucket counts more than the set has
        kind = np.min_scalar_type(max(int(n.max()), 256))
        self.coarse = np.empty((len(rows), BUCKETS), kind)
        self.fine = np.empty((int(fine.sum()), FINE), kind)
        for at, row in enumerate(rows):
            buckets = FINE if fine[at] else BUCKETS
            counts = np.frombuffer(row, f"u{len(row) // buckets}")
            if fine[at]:
                self.fine[self.place[at]] = counts
                counts = counts.reshape(-1, BUCKETS).sum(axis=0)
            self.coarse[at] = counts

    def overlap(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Most shingles that each of the pairs can share."""
        most = np.empty(len(a), np.int64)
        fine = (self.n[a] > LONG) & (self.n[b] > LONG)
        for matrix, mask, at in ((self.coarse, ~fine, None), (self.fine, fine, self.place)):
            where, step = np.flatnonzero(mask), (1 << 20) // matrix.shape[1]
            for low in range(0, len(where), step):
                some = where[low : low + step]
                left, right = (a[some], b[some]) if at is None else (at[a[some]], at[b[some]])
                most[some] = np.minimum(matrix[left], matrix[right]).sum(axis=1, dtype=np.uint32)
        return most


def _slim(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.col("text").cast("string").alias("_text"))


def _slices(column: pa.Array) -> Iterator[Slice]:
    return slices(column, SLICE)


def _with_repeats(columns: list[pa.Array], members: list[np.ndarray]) -> pa.RecordBatch:
    """The columns and, in the first row, the shingles that several of ``members`` hold."""
    value = np.concatenate(members) if members else np.zeros(0, np.uint64)
    members.clear()
    value.sort()
    first = np.flatnonzero(np.concatenate((np.ones(min(len(value), 1), bool), value[1:] != value[:-1])))
    count = np.diff(first, append=len(value))
    often = count >= LOCAL
    pairs = pa.StructArray.from_arrays(
        [pa.array(value[first[often]].view(np.int64)), pa.array(count[often].astype(np.int64))], ["shingle", "n"]
    )
    ends = np.full(len(columns[0]) + 1, len(pairs), np.int32)
    ends[0] = 0
    repeats = pa.ListArray.from_arrays(pa.array(ends), pairs)
    return pa.RecordBatch.from_arrays([*columns, repeats], ["doc_id", "n", "class", "sketch", "repeats"])


def _count_sets(docs: DataFrame) -> DataFrame:
    """doc_id, n (shingles) and class of every row; besides, the sketch of a class where some neighbouring
    batches first meet it, and shingles that repeat among the sets of these."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        members: list[np.ndarray] = []
        held = None
        for batch in batches:
            if held is not None:
                yield held
            n, classes, sketches = [], [], []
            for piece in _slices(batch.column("_text")):
                for own in sets(piece):
                    n.append(len(own))
                    classes.append(class_of(own) if len(own) else None)
                    first = len(own) > 0 and classes[-1] not in seen
                    sketches.append(sketch(own) if first else None)
                    if first:
                        seen.add(classes[-1])
                        members.append(own)
            columns = [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(classes, pa.int64()), pa.array(sketches, pa.binary())]
            full = sum(map(len, members)) >= COUNTED
            held = _with_repeats(columns, members if full else [])
            if full:
                seen, members = set(), []
        if held is not None:
            yield _with_repeats(held.columns[:-1], members) if members else held

    schema = f"doc_id {kind}, n bigint, class bigint, sketch binary, repeats array<struct<shingle: bigint, n: bigint>>"
    return _slim(docs).mapInArrow(released(run), schema)


def _is_common(own: np.ndarray, common: np.ndarray) -> np.ndarray:
    if not len(common):
        return np.zeros(len(own), bool)
    at = np.minimum(np.searchsorted(common, own), len(common) - 1)
    return common[at] == own


def _openings(docs: DataFrame, common: np.ndarray, with_class: bool) -> DataFrame:
    """The shingles of every set that may open a region it shares with a set within the radius."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in _slices(batch.column("_text")):
                found, owner, rare = [], [], []
                for own in sets(piece):
                    if not len(own):
                        continue
                    late = _is_common(own, common)
                    length = len(own) - -(-PERCENT * len(own) // 100) + 1
                    early = own[~late]
                    chosen = early[:length]
                    if len(chosen) < length:
                        chosen = np.concatenate((chosen, own[late][: length - len(chosen)]))
                    found.append(chosen)
                    if with_class:
                        owner.append(class_of(own))
                        rare.append(1000 * len(early) // len(own))
                flat = np.concatenate(found).view(np.int64) if found else np.zeros(0, np.int64)
                columns = [pa.array(flat)]
                if with_class:
                    sizes = [len(f) for f in found]
                    columns += [pa.array(np.repeat(np.array(owner, np.int64), sizes)), pa.array(np.repeat(np.array(rare, np.int16), sizes))]
                yield pa.RecordBatch.from_arrays(columns, ["shingle", "class", "rare"][: len(columns)])

    schema = "shingle bigint" + (", class bigint, rare smallint" if with_class else "")
    return _slim(docs).mapInArrow(released(run), schema)


def _bit(doc_id: str = "doc_id") -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(BITS))


def _bitmap(ids: DataFrame) -> np.ndarray:
    """One bit for the hash of every id: ``BITS / 8`` bytes at most, however many ids there are."""
    page = F.lit(1 << 15)
    rows = ids.groupBy((_bit() / page).cast("int").alias("page")).agg(F.bitmap_construct_agg(_bit() % page).alias("bits"))
    bits = np.zeros(BITS // 8, np.uint8)
    for row in rows.collect():
        bits[row.page << 12 : (row.page + 1) << 12] = np.frombuffer(bytes(row.bits), np.uint8)
    return bits


def _members(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Sets of the wanted documents: class and its sorted shingles, as a written table. No text is shuffled: the scan
    keeps what a bitmap of bounded size marks, so a few other sets may come along."""
    marked = docs.sparkSession.sparkContext.broadcast(_bitmap(wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = marked.value
        for batch in batches:
            bit = batch.column("_bit").to_numpy()
            few = batch.filter(pa.array((bits[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1))
            for piece in _slices(few.column("_text")):
                own = sets(piece)
                lists = pa.array([s.view(np.int64) for s in own], pa.list_(pa.int64()))
                classes = pa.array([class_of(s) if len(s) else None for s in own], pa.int64())
                yield pa.RecordBatch.from_arrays([classes, lists], ["class", "shingles"])

    rows = docs.select(_bit().alias("_bit"), F.col("text").cast("string").alias("_text"))
    members = written(rows.mapInArrow(released(run), "class bigint, shingles array<bigint>").where(F.col("class").isNotNull()), "members")
    marked.destroy()
    return members


def _measured(docs: DataFrame, inside: DataFrame, pairs: DataFrame) -> DataFrame:
    """Jaccard distance of every pair (a, b), from the whole sets."""
    pairs = written(pairs.select("a", "b"), "pairs")
    if pairs.isEmpty():
        return pairs.select("a", "b", F.lit(0.0).alias("distance"), F.lit(False).alias("linked"))
    wanted = pairs.select(F.col("a").alias("class")).union(pairs.select("b")).distinct()
    members = _members(docs, inside.join(wanted, "class", "left_semi").select("doc_id"))
    left = members.select(F.col("class").alias("a"), F.col("shingles").alias("_a"))
    right = members.select(F.col("class").alias("b"), F.col("shingles").alias("_b"))
    shared = F.size(F.array_intersect("_a", "_b"))
    joined = pairs.join(left, "a").join(right, "b")
    sized = joined.select("a", "b", shared.alias("shared"), (F.size("_a") + F.size("_b")).alias("both"))
    union = F.col("both") - F.col("shared")
    distance, linked = (1 - F.col("shared") / union).alias("distance"), (F.col("shared") * 100 >= union * PERCENT).alias("linked")
    # an id that stands in several rows brings its set several times
    return sized.select("a", "b", distance, linked).dropDuplicates(["a", "b"])


def _regions(docs: DataFrame, common: np.ndarray) -> DataFrame:
    """Rows of region, class and rare for all regions of two and more sets; of regions with the same sets one stays."""
    twice = _openings(docs, common, False).groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1").select("shingle")
    rows = _openings(docs, common, True).join(twice, "shingle").groupBy("shingle", "class").agg(F.first("rare").alias("rare"))
    rows = written(rows, "openings")
    signature = rows.groupBy("shingle").agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("class")).alias("x"), F.bit_xor(F.xxhash64("class", F.lit(1))).alias("y")
    )
    kept = signature.where("n > 1").groupBy("n", "x", "y").agg(F.min("shingle").alias("shingle")).select("shingle")
    return rows.join(kept, "shingle").withColumnRenamed("shingle", "region")


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by group as tables that hold whole groups, of ``BLOCK`` rows or else one group."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        rest = table if rest is None else pa.concat_tables([rest, table])
        group = rest.column("group").to_numpy()
        low = 0
        while low < len(group):
            cut = int(np.searchsorted(group, group[min(low + BLOCK, len(group) - 1)]))
            if cut <= low:
                cut = int(np.searchsorted(group, group[low], side="right"))
            if cut == len(group):
                break
            yield rest.slice(low, cut - low)
            low = cut
        rest = rest.slice(low)
    if rest is not None and rest.num_rows:
        yield rest


def _grouped(rows: DataFrame, *order: str) -> DataFrame:
    return rows.repartition("group").sortWithinPartitions("group", *order)


def _to_pivots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pivot that may be nearest of every row, and how far its group's first pivot is at least."""
    for table in _whole_groups(batches):
        group, n, class_ = (table.column(c).to_numpy() for c in ("group", "n", "class"))
        known = Sketches(table.column("sketch").to_pylist(), n)
        start = np.searchsorted(group, group)
        rows = np.arange(len(group))
        nearest, best, apart = rows.copy(), np.full(len(group), -1.0), np.zeros(len(group))
        pivot, open_ = start, rows
        for turn in range(PIVOTS):
            to = pivot[open_]
            both = n[open_] + n[to]
            shared = known.overlap(open_, to)
            share = shared / (both - shared)
            if not turn:
                apart = 1 - share
            may = ((100 + PERCENT) * shared >= PERCENT * both) & (share > best[open_]) & (class_[open_] != class_[to])
            nearest[open_[may]], best[open_[may]] = to[may], share[may]
            # what no pivot may link has its group's first such row as the next pivot
            open_ = open_[((best[open_] < 0) & (open_ != to))]
            if not len(open_):
                break
            firsts = np.searchsorted(group[open_], group[open_])
            pivot = np.zeros(len(group), np.int64)
            pivot[open_] = open_[firsts]
        yield pa.RecordBatch.from_arrays(
            [table.column("region").combine_chunks(), pa.array(class_), pa.array(class_[nearest]), pa.array(best), pa.array(apart)],
            ["region", "a", "b", "share", "apart"],
        )


def _pairs_inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of a group that are of different components and may link by windows, sizes and sketches."""
    for table in _whole_groups(batches):
        group, n, class_, component, low, high, block, two = (
            table.column(c).to_numpy() for c in ("group", "n", "class", "component", "low", "high", "block", "two")
        )
        known = Sketches(table.column("sketch").to_pylist(), n)
        left = np.arange(len(group))
        reach = RADIUS + 1e-9
        for lag in range(1, len(group)):
            # rows whose group goes on that far
            left = left[left < len(group) - lag]
            left = left[group[left] == group[left + lag]]
            if not len(left):
                break
            a, b = left, left + lag
            may = (component[a] != component[b]) & (low[a] - high[b] <= reach) & (low[b] - high[a] <= reach)
            may &= (100 * n[a] >= PERCENT * n[b]) & (100 * n[b] >= PERCENT * n[a]) & (~two[a] | (block[a] != block[b]))
            a, b = a[may], b[may]
            if not len(a):
                continue
            shared, both = known.overlap(a, b), n[a] + n[b]
            may = (100 + PERCENT) * shared >= PERCENT * both
            a, b, share = a[may], b[may], (shared / (both - shared))[may]
            if not len(a):
                continue
            turned = component[a] > component[b]
            a, b = np.where(turned, b, a), np.where(turned, a, b)
            yield pa.RecordBatch.from_arrays(
                [pa.array(class_[a]), pa.array(class_[b]), pa.array(component[a]), pa.array(component[b]), pa.array(share)],
                ["a", "b", "u", "v", "share"],
            )


def _windows(active: DataFrame, key: list[str]) -> DataFrame:
    """Rows of ``key`` with the number of blocks that it has to be cut into (``parts``)."""
    sizes = active.groupBy(*key).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"))
    return active.join(sizes, key)


def _placed(active: DataFrame) -> DataFrame:
    """Rows of regions with their group: the region, of a large one each window of distances to its
    pivot that a set can be in or next to, of a large window each pair of blocks."""
    width = lambda c, d: F.floor((F.col(c) + d) / RADIUS).cast("int")
    rings = F.sequence(F.greatest(width("low", -1e-9), F.lit(0)), F.least(width("high", 1e-9) + 1, F.lit(5)))
    cut = _windows(active, ["region"])
    cut = cut.withColumn("ring", F.explode(F.when(F.col("parts") > 1, rings).otherwise(F.array(F.lit(-1))))).drop("parts")
    cut = _windows(cut, ["region", "ring"]).withColumn("block", F.pmod(F.xxhash64("class"), F.col("parts")).cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    first, second = F.least("block", "other"), F.greatest("block", "other")
    group = F.xxhash64("region", "ring", first, second).alias("group")
    return cut.select(group, (first != second).alias("two"), "block", "class", "component", "low", "high")


def _best(pairs: DataFrame, *key: str) -> DataFrame:
    """The pairs of each key with the greatest shares, ``BEST`` at most."""
    once = pairs.groupBy(*dict.fromkeys((*key, "a", "b"))).agg(F.max("share").alias("share"))
    order = Window.partitionBy(*key).orderBy(F.desc("share"), "a", "b")
    return once.withColumn("place", F.row_number().over(order)).where(F.col("place") <= BEST).select("a", "b")


def _tied(labels: DataFrame, found: DataFrame) -> DataFrame:
    """Labels (class, component) after the links (a, b) between them."""
    one = labels.select(F.col("class").alias("a"), F.col("component").alias("u"))
    two = labels.select(F.col("class").alias("b"), F.col("component").alias("v"))
    links = found.join(one, "a").join(two, "b").select(F.col("u").alias("a"), F.col("v").alias("b"))
    merged = components(links)
    if merged.isEmpty():
        return labels
    merged = labels.join(merged.withColumnRenamed("component", "to"), F.col("component") == F.col("node"), "left")
    return written(merged.select("class", F.coalesce("to", "component").alias("component")), "components")


def links(docs: DataFrame, counted: DataFrame) -> DataFrame:
    """Component of every class that shares a region with another: class and component."""
    again = counted.select(F.inline("repeats")).groupBy("shingle").agg(F.sum("n").alias("n")).where(F.col("n") >= COMMON)
    # at most MOST_COMMON numbers, whatever the input
    rows = again.orderBy(F.desc("n"), "shingle").limit(MOST_COMMON).select("shingle").toPandas()
    common = np.sort(rows["shingle"].to_numpy(np.int64).view(np.uint64))

    regions = written(_regions(docs, common), "regions")
    held = regions.select("class").distinct()
    sized = counted.where(F.col("class").isNotNull()).groupBy("class").agg(F.max("n").alias("n"), F.min("doc_id").alias("doc_id"))
    sketches = counted.where(F.col("sketch").isNotNull()).select("class", "sketch").join(held, "class", "left_semi")
    inside = sized.join(sketches.dropDuplicates(["class"]), "class")
    inside = written(inside, "inside")

    # a region's pivot goes into all its parts
    heads = regions.groupBy("region").agg(F.min(F.struct("rare", "class")).alias("p"), F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"))
    heads = written(heads.select("region", F.col("p.class").alias("pivot"), "parts"), "pivots")
    part = F.pmod(F.xxhash64("class"), F.col("parts")).cast("int")
    is_pivot = F.col("class") == F.col("pivot")
    parts = F.when(is_pivot, F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array(part))
    cut = regions.join(heads, "region").withColumn("part", F.explode(parts))
    cut = cut.withColumn("rank", F.when(is_pivot, F.lit(-1)).otherwise(F.col("rare").cast("int")))
    cut = cut.join(inside.select("class", "n", "sketch"), "class")
    cut = cut.select(F.xxhash64("region", "part").alias("group"), "region", "rank", "class", "n", "sketch")
    schema = "region bigint, a bigint, b bigint, share double, apart double"
    near = written(_grouped(cut, "region", "rank", "class").mapInArrow(released(_to_pivots), schema), "near")
    tries = _best(near.where("share >= 0").select("a", "b", "share"), "a")
    tries = tries.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    known = written(_measured(docs, inside, tries), "measured")
    labels = _tied(inside.select("class", F.col("class").alias("component")), known.where("linked"))

    # distances to the region's pivot: exact, or at least what the sketches leave
    exact = known.select("a", "b", "distance").unionAll(known.select("b", "a", "distance"))
    exact = exact.select(F.col("a").alias("class"), F.col("b").alias("pivot"), "distance")
    # the pivot of a region of several parts is in each of them
    windows = near.groupBy("region", F.col("a").alias("class")).agg(F.min("apart").alias("apart"))
    windows = windows.join(heads.select("region", "pivot"), "region").join(exact, ["class", "pivot"], "left")
    itself = F.when(F.col("class") == F.col("pivot"), F.lit(0.0))
    low = F.coalesce(itself, "distance", "apart").alias("low")
    windows = written(windows.select("region", "class", low, F.coalesce(itself, "distance", F.lit(1.0)).alias("high")), "windows")

    schema = "a bigint, b bigint, u bigint, v bigint, share double"
    for last in (False, True):
        placed = written(windows.join(labels, "class"), "placed")
        several = placed.groupBy("region").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y")
        active = written(placed.join(several.select("region"), "region", "left_semi"), "active")
        if active.isEmpty():
            break
        # the sketches are long and come last
        placed = _placed(active).join(inside.select("class", "n", "sketch"), "class")
        pairs = _grouped(placed).mapInArrow(released(_pairs_inside), schema)
        seen = known.select("a", "b").unionAll(known.select("b", "a"))
        pairs = pairs.join(seen, ["a", "b"], "left_anti")
        pairs = pairs.select("a", "b").distinct() if last else _best(pairs, "u", "v")
        measured = written(_measured(docs, inside, pairs), "measured")
        known = known.unionByName(measured)
        labels = _tied(labels, measured.where("linked"))
    return labels


def groups(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest id that links reach) of every row.

    Null and empty texts have no shingles and are linked with nothing: their component is
    their own id. Repeated rows are in one component. A null id is a document, but never
    the smallest id, unless no other is in the component. Only doc_id and text are read.
    """
    # texts and sketches are long: all tables that Python tasks make are written in here
    with arrow_rows(docs.sparkSession, BATCH):
        counted = written(_count_sets(docs), "sets")
        tied = links(docs, counted)
    least = counted.where(F.col("class").isNotNull()).groupBy("class").agg(F.min("doc_id").alias("least"))
    tied = least.join(tied, "class", "left").select("class", "least", F.coalesce("component", "class").alias("component"))
    # only components of several classes need their minimum
    smallest = tied.groupBy("component").agg(F.min("least").alias("component_id"))
    named = tied.join(smallest, "component").select("class", "component_id")
    rows = counted.select("doc_id", "n", "class").join(named, "class", "left")
    own = F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return rows.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))
