"""Mixing sources to target weights by Sainte-Lague apportionment.

Sources are cut into shards of bounded size by a hash of the document. The mix is a
number of equal blocks of words. Blocks go to sources by the highest quotients
votes / (2k + 1), with the source's target as votes, and a source's blocks go to its
shards likewise, with the shard's words as votes. A shard lays its documents end to end
in a seeded order, cuts the stream into blocks and takes its quota of them, each at most
twice, in a seeded order. Sources and shards stay tables; only sums reach the driver.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loglake.session import release_memory, written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST_TIMES = 2
BLOCK_WORDS = 32
SHARD_WORDS = 1 << 20
SHARD_DOCS = 1 << 14
SEED = 20240229
#: After a shard of so many bytes its task hands memory back to the system.
LARGE = 1 << 21


def source_key(source: Column) -> Column:
    """Sorts by code point, null last, and is itself never null."""
    return F.coalesce(F.concat(F.lit("0"), source.cast("string")), F.lit("1"))


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Rows numbered from 0 in a total order, without gathering them in one task."""
    ranged = df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*order)).cast("bigint")
    ranged = written(ranged.withColumn("_inside", inside), "numbered")
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("_rows"))
    before = F.sum("_rows").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    return ranged.join(sizes, "_part").withColumn(name, F.col("_before") + F.col("_inside") - 1).drop(
        "_part", "_inside", "_before"
    )


def targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """``sources(key, source_size)`` with each source's weight and target.

    Targets are in proportion to the weights and add up to ``share`` of all words. One that
    would exceed ``MOST_TIMES`` of its source stops there and the excess is shared again.
    """
    ranked = numbered(sources, [F.col("key")], "rank")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    weighted = written(ranked.withColumn("weight", weight), "weighted")
    cap = F.col("source_size") * float(MOST_TIMES)
    total, level = weighted.agg(F.coalesce(F.sum("source_size"), F.lit(0)) * share, F.sum("weight")).first()
    level = float(total) / level if level else 0.0
    stopped = -1
    while True:
        over = F.col("weight") * level > cap
        held, free, count = weighted.agg(
            F.sum(F.when(over, cap).otherwise(0.0)), F.sum(F.when(over, 0.0).otherwise(F.col("weight"))), F.count_if(over)
        ).first()
        if count == stopped or not free:
            break
        stopped, level = count, (float(total) - held) / free
    return weighted.withColumn("target", F.least(F.col("weight") * level, cap))


def apportion(parties: DataFrame, group: str, votes: str, seats: str, order: str, name: str) -> DataFrame:
    """Adds ``name``: how many of its group's ``seats`` each party gets by Sainte-Lague.

    For a divisor d a party has round(votes / d) seats, and over n parties these sums stay
    within n / 2 of total / d. Two divisors around the wanted one therefore leave about one
    open seat a party, and only the quotients of open seats are ranked. Ties go by ``order``.
    """
    v, n = F.col(votes), F.col("_n")
    sums = parties.groupBy(group).agg(F.sum(votes).alias("_votes"), F.count("*").alias("_n"))
    joined = parties.join(sums, group)
    # round(v / d) with d = votes / (seats -+ n / 2)
    fixed = F.floor(v / F.col("_votes") * (F.col(seats) - n / 2 - 1) + 0.5)
    most = F.floor(v / F.col("_votes") * (F.col(seats) + n / 2 + 1) + 0.5)
    bounds = {
        "_fixed": F.greatest(F.when(F.col("_votes") > 0, fixed).otherwise(0), F.lit(0)).cast("bigint"),
        "_most": F.greatest(F.when(F.col("_votes") > 0, most).otherwise(0), F.lit(0)).cast("bigint"),
    }
    bounded = written(joined.withColumns(bounds), "bounded")
    left = bounded.groupBy(group).agg((F.max(seats) - F.sum("_fixed")).alias("_left"))
    open_seats = bounded.where(F.col("_most") > F.col("_fixed")).select(
        group, order, votes, F.explode(F.sequence(F.col("_fixed"), F.col("_most") - 1)).alias("_k")
    )
    quotient = F.col(votes) / (2 * F.col("_k") + 1)
    ranked = numbered(
        open_seats.withColumn("_quotient", quotient), [F.col(group), F.desc("_quotient"), F.col(order), F.col("_k")], "_place"
    )
    ranked = written(ranked, "ranked")
    first = ranked.groupBy(group).agg(F.min("_place").alias("_first"))
    won = ranked.join(first, group).join(left, group).where(F.col("_place") - F.col("_first") < F.col("_left"))
    extra = won.groupBy(group, order).agg(F.count("*").alias("_extra"))
    given = bounded.join(extra, [group, order], "left")
    return given.withColumn(name, F.col("_fixed") + F.coalesce("_extra", F.lit(0))).drop(
        "_votes", "_n", "_fixed", "_most", "_extra"
    )


def _times(size: int, quota: int, key: str, shard: int, block: int) -> tuple[np.ndarray, np.ndarray]:
    """How often each block of a shard is taken, and the taken words before each block."""
    count = -(-size // block)
    quota = min(quota, MOST_TIMES * count)
    base, extra = divmod(quota, count)
    seed = [SEED, shard, zlib.crc32(key.encode())]
    times = np.full(count, base, np.int64)
    times[np.random.default_rng(seed).permutation(count)[:extra]] += 1
    words = np.full(count, block, np.int64)
    words[-1] = size - (count - 1) * block
    return times, np.concatenate(([0], np.cumsum(times * words)))


def _pieces(text: str, begin: int, end: int, times: np.ndarray, least: int, block: int) -> str | None:
    """The parts of a text whose blocks are taken ``least`` times or more, or None."""
    first, last = begin // block, (end - 1) // block
    taken = times[first : last + 1] >= least
    if not taken.any():
        return None
    if taken.all():
        return text
    spans = [m.span() for m in re.finditer(WORD, text)]
    edges = np.flatnonzero(np.diff(np.concatenate(([0], taken.astype(np.int8), [0]))))
    parts = []
    for low, high in zip(edges[::2], edges[1::2]):
        a, b = max((first + low) * block, begin) - begin, min((first + high) * block, end) - begin
        parts.append(text[spans[a][0] : spans[b - 1][1]])
    return "\n".join(parts)


def mix(docs: DataFrame, with_text: bool = False, block: int = BLOCK_WORDS) -> DataFrame:
    """What the mix takes of each document of ``docs(doc_id, text, source, ...)``.

    Without ``with_text``: one row per document with size, source_size, target and
    taken (words, repeats counted). With it: the taken text as rows of doc_id, text, lang,
    source and n_chars; a document of which blocks are taken twice gives two rows, one of which nothing is taken none.

    A null text has size 0 and nothing is taken of it; a null source is a source of its own, after all others.
    Repeated rows are documents of their own. Columns of other names are not read. An
    empty table gives no rows. Results do not depend on partitioning. ``docs`` is read again for the
    texts, which are not stored: give it as a table that is read, not as one that is made anew each time.
    """
    size = F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("bigint")
    carried = ["text", "lang"] if with_text else []
    sized = docs.select("doc_id", "source", *carried, source_key(F.col("source")).alias("key"), size.alias("size"))
    identity = ["doc_id", "size", *carried[:1]]
    texts = sized.withColumn("_order", F.xxhash64(F.lit(SEED), *identity))
    sized = written(texts.drop(*carried), "sized")

    sources = sized.groupBy("key").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    aimed = targets(written(sources, "sources")).withColumn("all", F.lit(0))
    seats = aimed.agg(F.sum("target")).first()[0] or 0.0
    shards = F.greatest(F.ceil(F.col("source_size") / SHARD_WORDS), F.ceil(F.col("docs") / SHARD_DOCS), F.lit(1))
    aimed = aimed.withColumns({"seats": F.lit(round(seats / block)).cast("bigint"), "shards": shards.cast("bigint")})
    granted = written(apportion(aimed, "all", "target", "seats", "key", "source_seats"), "granted")

    def parted(rows: DataFrame) -> DataFrame:
        rows = rows.join(granted.select("key", "source_size", "target", "shards"), "key")
        return rows.withColumn("shard", F.pmod(F.col("_order"), F.col("shards")).cast("int"))

    per_shard = parted(sized).groupBy("key", "shard").agg(F.sum("size").cast("double").alias("shard_size"))
    per_shard = written(per_shard.join(granted.select("key", "source_seats"), "key"), "shards")
    quotas = apportion(per_shard, "key", "shard_size", "source_seats", "shard", "quota").select("key", "shard", "quota")
    ready = parted(texts if with_text else sized).join(written(quotas, "quotas"), ["key", "shard"])

    def take(shard: pa.Table) -> pa.Table:
        shard = shard.sort_by([("_order", "ascending"), ("doc_id", "ascending"), ("size", "ascending")])
        sizes = shard["size"].to_numpy()
        ends = np.cumsum(sizes)
        starts = ends - sizes
        times, before = np.zeros(1, np.int64), np.zeros(2, np.int64)
        if ends[-1]:
            quota, key, number = (shard[c][0].as_py() for c in ("quota", "key", "shard"))
            times, before = _times(int(ends[-1]), quota, key, number, block)
        if with_text:
            copies = [
                (row, part)
                for row, (text, a, b) in enumerate(zip(shard["text"].to_pylist(), starts.tolist(), ends.tolist()))
                if b > a
                for least in range(1, MOST_TIMES + 1)
                if (part := _pieces(text, a, b, times, least, block)) is not None
            ]
            out = shard.select(["doc_id", "lang", "source"]).take(pa.array([row for row, _ in copies], pa.int64()))
            out = out.add_column(1, "text", pa.array([part for _, part in copies], pa.string()))
            if shard.nbytes > LARGE:
                del copies
                release_memory()
            return out
        full = np.append(times, 0)
        words = lambda at: before[at // block] + full[at // block] * (at % block)
        out = shard.select(["doc_id", "size", "source_size", "target"])
        return out.append_column("taken", pa.array(words(ends) - words(starts)))

    kinds = {f.name: f.dataType.simpleString() for f in ready.schema.fields}
    if with_text:
        schema = f"doc_id {kinds['doc_id']}, text string, lang {kinds['lang']}, source {kinds['source']}"
        taken = ready.select("key", "shard", "quota", "size", "_order", "doc_id", "text", "lang", "source")
        mixed = taken.groupBy("key", "shard").applyInArrow(take, schema)
        return mixed.withColumn("n_chars", F.length("text").cast("bigint"))
    schema = f"doc_id {kinds['doc_id']}, size bigint, source_size bigint, target double, taken bigint"
    slim = ready.select("key", "shard", "quota", "size", "_order", "doc_id", "source_size", "target")
    return slim.groupBy("key", "shard").applyInArrow(take, schema)
