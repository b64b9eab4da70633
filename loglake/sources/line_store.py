"""The lines that earlier runs took in, as hashes by range and mergeable Bloom filters.

``lines/run=<n>/range=<r>`` holds two 64-bit hashes of every line a run took in, by the upper bits of the
first. ``filters/run=<n>`` holds the run's filter: a line sets four bits of one page, and
pages of all runs with as many pages are merged by OR. A new run tests its lines on the pages they fall on. Only
lines that pass can be copies, and only the ranges that hold such lines are read.
Filters err on the side of reading; whether a line is a copy is decided by its hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loglake.session import written
from loglake.sources.lake import partition_values

#: Ranges of hashes, and pages of a range: 2**6 * 2**14 pages of 4 KB a run at most.
RANGE_BITS, PAGE_BITS = 6, 14
#: Lines that share a page, about: 8 bits a line, so about one strange line in 40 passes.
LINES_A_PAGE = 4096
#: Bits of a page, as the bitmap aggregates make them.
PAGE = 1 << 15
TESTS = 4
_KEYS = ("_k1", "_k2")
_BY = ("page_bits", "range", "page")


def with_keys(lines: DataFrame) -> DataFrame:
    """Lines with two hashes and their range."""
    hashed = lines.withColumns({"_k1": F.xxhash64("value"), "_k2": F.xxhash64(F.lit("again"), "value")})
    return hashed.withColumn("range", F.shiftrightunsigned("_k1", 64 - RANGE_BITS).cast("int"))


def page_bits(lines: int) -> int:
    """How many bits of a hash choose its page, in a run of so many lines."""
    return min(PAGE_BITS, ((lines >> RANGE_BITS) // LINES_A_PAGE).bit_length())


def _page(bits: Column) -> Column:
    pages = F.call_function("shiftleft", F.lit(1).cast("bigint"), bits)
    return F.col("_k1").bitwiseAND(pages - 1).cast("int")


def _places() -> list[Column]:
    """The bits of a page that a line sets."""
    return [F.shiftrightunsigned(F.col("_k2"), 15 * i).bitwiseAND(PAGE - 1) for i in range(TESTS)]


def filter_of(keyed: DataFrame, bits: int) -> DataFrame:
    """The lines' filter with ``2**bits`` pages a range; pages without a line are absent.

    Lines are dealt out by range before their pages are made: a task of unordered lines would send a
    page of ``PAGE`` bits for nearly every one of its lines.
    """
    marks = keyed.repartition("range").select(F.lit(bits).alias("page_bits"), "range", _page(F.lit(bits)).alias("page"), F.explode(F.array(*_places())).alias("place"))
    return marks.groupBy(*_BY).agg(F.bitmap_construct_agg("place").alias("bits"))


def merged(filters: DataFrame) -> DataFrame:
    return filters.groupBy(*_BY).agg(F.bitmap_or_agg("bits").alias("bits"))


def possible(keyed: DataFrame, filters: DataFrame) -> DataFrame:
    """Hashes and range of the lines that ``filters`` cannot rule out."""
    # PAGE_BITS + 1 numbers at most
    sizes = sorted(r.page_bits for r in filters.select("page_bits").distinct().collect())
    keys = keyed.select(*_KEYS, "range", F.explode(F.array(*map(F.lit, sizes))).alias("page_bits"))
    keys = keys.withColumn("page", _page(F.col("page_bits")))

    def is_set(place: Column) -> Column:
        byte = F.conv(F.hex(F.substring("bits", (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        return F.call_function("shiftright", byte, (place % 8).cast("int")).bitwiseAND(1) == 1

    pages = merged(filters.join(keys.select(*_BY).distinct(), list(_BY), "left_semi"))
    passes = F.lit(True)
    for place in _places():
        passes = passes & is_set(place)
    return keys.join(pages, list(_BY)).where(passes).select(*_KEYS, "range").distinct()


def known_lines(spark: SparkSession, store: str, run: int, ranges: list[int]) -> DataFrame:
    """Hashes of earlier runs in some ranges; the folders of all others are not opened."""
    rows = spark.read.schema("_k1 bigint, _k2 bigint, run int, range int").parquet(f"{store}/lines")
    return rows.where((F.col("run") < run) & F.col("range").isin(ranges)).select(*_KEYS)


def take_new(lines: DataFrame, store: str, run: int) -> DataFrame:
    """The lines (each once in ``lines``) that no run before ``run`` took in; they are added to the store.

    A repeated run replaces what it wrote before and sees earlier runs only.
    """
    spark = lines.sparkSession
    keyed = with_keys(lines)
    if any(int(r) < run for r in partition_values(spark, f"{store}/filters", "run")):
        keyed = written(keyed, "keyed-lines")
        filters = spark.read.schema("page_bits int, range int, page int, bits binary, run int").parquet(f"{store}/filters")
        maybe = written(possible(keyed, filters.where(F.col("run") < run)), "possible-copies")
        # 2**RANGE_BITS numbers at most
        ranges = [r.range for r in maybe.select("range").distinct().collect()]
        if ranges:
            copies = written(maybe.join(known_lines(spark, store, run, ranges), list(_KEYS), "left_semi"), "copies")
            keyed = keyed.join(copies, list(_KEYS), "left_anti")
    fresh = written(keyed, "new-lines")
    hashes = fresh.select(*_KEYS, "range")
    hashes.repartition("range").write.mode("overwrite").partitionBy("range").parquet(f"{store}/lines/run={run}")
    filter_of(fresh, page_bits(fresh.count())).write.mode("overwrite").parquet(f"{store}/filters/run={run}")
    return fresh.select(*lines.columns)
