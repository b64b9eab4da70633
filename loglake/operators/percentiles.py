"""Exact percentiles (linear interpolation) that never gather or order a group's values.

A histogram over fixed buckets, made inside the scan, tells which bucket holds each wanted
rank. A bucket with a single value is done. A bucket of few rows is read as a sorted
list. Any other is cut into finer buckets, from its own rows only, until it is one of
those. So what is shuffled are counts per bucket, never values, however many values or
copies of one value a group has.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loglake.session import written

#: Rows of a bucket that are read as one sorted list.
FEW = 4096
#: Buckets that one is cut into.
CUTS = 1024


def log_bucket(value: Column) -> Column:
    """Buckets that grow with the value, about 0.1 % wide, in the order of the values."""
    return (F.signum(value) * F.floor(F.log1p(F.abs(value)) * 1024)).cast("bigint")


def linear_bucket(width: float) -> Callable[[Column], Column]:
    return lambda value: F.floor(value / width).cast("bigint")


def _finer(value: Column) -> Column:
    """The part of its bucket's range, ``_low`` to ``_high``, that a value is in.

    A range over several powers of two is cut by sign and power. One within a power or
    two is cut into ``CUTS`` equal parts, and the largest value has one of its own. Every cut splits a
    bucket of two and more values, and a few cuts reach single values, as numbers have 53 bits.
    """
    low, high = F.col("_low"), F.col("_high")
    wide = ((low <= 0) & (high >= 0)) | (F.greatest(F.abs(low), F.abs(high)) / 2 > F.least(F.abs(low), F.abs(high)))
    power = F.when(value == 0, 0.0).otherwise(F.signum(value) * (F.floor(F.log2(F.abs(value))) + 1100))
    # halves of the smallest numbers can be equal
    part = F.floor(F.coalesce(F.try_divide(value / 2 - low / 2, high / 2 - low / 2), F.lit(0.0)) * CUTS)
    equal = F.when(value >= high, CUTS).otherwise(F.least(part, F.lit(CUTS - 1)))
    return F.when(wide, power).otherwise(equal).cast("bigint")


def exact_percentiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probabilities: dict[str, float],
    bucket: Callable[[Column], Column] = log_bucket,
) -> DataFrame:
    """One row per key with a column per named probability; null values are left out.

    ``bucket`` must not decrease as the value grows. Keys must not be null. Infinite values count as the largest
    and smallest ones; NaN counts as the largest of all.
    """
    keys = list(keys)
    rows = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_value"))
    odd = F.isnan("_value") | (F.abs("_value") == float("inf"))
    # infinities and NaN have buckets of their own beyond all others
    beyond = F.when(F.isnan("_value"), (1 << 62) + 1).otherwise(F.signum("_value").cast("bigint") * F.lit(1 << 62))
    rows = rows.withColumn("_bucket", F.when(odd, beyond).otherwise(bucket(F.col("_value"))))

    by_key = [F.col(k) for k in keys] or [F.lit(0)]
    counts = rows.groupBy(*keys, "_bucket").agg(
        F.count("*").alias("_held"), F.min("_value").alias("_low"), F.max("_value").alias("_high")
    )
    lower = Window.partitionBy(*by_key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumns(
        {"_before": F.coalesce(F.sum("_held").over(lower), F.lit(0)), "_total": F.sum("_held").over(Window.partitionBy(*by_key))}
    )
    spots = {name: (F.col("_total") - 1) * p for name, p in probabilities.items()}
    wanted = F.array_distinct(F.array(*(f(s).cast("bigint") for s in spots.values() for f in (F.floor, F.ceil))))
    level = _holding(counts.withColumn("_ranks", wanted), [*keys, "_bucket", "_low", "_high", "_before", "_held", "_total", "_ranks"])
    level = written(level, "rank-buckets")
    totals = level.groupBy(*keys).agg(F.max("_total").alias("_total"))

    found = _single(level, keys)
    path: list[str] = []
    while True:
        several = level.where(F.col("_low") != F.col("_high"))
        # two numbers: are there small buckets to read, and large ones to cut?
        few, many = several.agg(F.count_if(F.col("_held") <= FEW), F.count_if(F.col("_held") > FEW)).first()
        if not few and not many:
            break
        step = f"_cut{len(path)}"
        inside = several.withColumnRenamed("_bucket", step)
        # rows of the wanted buckets: their number of buckets is that of keys and ranks, not of values
        rows = rows.withColumnRenamed("_bucket", step).join(inside, [*keys, *path, step])
        path.append(step)
        if few:
            lists = rows.where(F.col("_held") <= FEW).groupBy(*keys, *path).agg(
                F.sort_array(F.collect_list("_value")).alias("_values"), F.min("_before").alias("_before"),
                F.min("_ranks").alias("_ranks"),
            )
            each = lists.select(*keys, "_values", "_before", F.explode("_ranks").alias("_rank"))
            found = found.unionByName(each.select(*keys, "_rank", F.get("_values", (F.col("_rank") - F.col("_before")).cast("int")).alias("_value")))
        if not many:
            break
        rows = rows.where(F.col("_held") > FEW).withColumn("_bucket", _finer(F.col("_value")))
        rows = written(rows.select(*keys, *path, "_bucket", "_value"), "rank-rows")
        cut = rows.groupBy(*keys, *path, "_bucket").agg(
            F.count("*").alias("_held"), F.min("_value").alias("_low"), F.max("_value").alias("_high")
        )
        # the bucket that is cut says what stands before it and which ranks are wanted
        cut = cut.join(inside.where(F.col("_held") > FEW).select(*keys, *path, F.col("_before").alias("_outer"), "_ranks"), [*keys, *path])
        lower = Window.partitionBy(*keys, *path).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
        cut = cut.withColumn("_before", F.col("_outer") + F.coalesce(F.sum("_held").over(lower), F.lit(0)))
        level = written(_holding(cut, [*keys, *path, "_bucket", "_low", "_high", "_before", "_held", "_ranks"]), "rank-buckets")
        found = found.unionByName(_single(level, keys))

    found = written(found, "rank-values") if path else found
    # without keys there is one total
    placed = found.join(totals, keys) if keys else found.withColumn("_total", totals.scalar())

    def at(rank: Column) -> Column:
        return F.max(F.when(F.col("_rank") == rank, F.col("_value")))

    columns = []
    for name, spot in spots.items():
        low, high = at(F.floor(spot)), at(F.ceil(spot))
        share = F.max(spot - F.floor(spot))
        columns.append(F.when(share == 0, low).otherwise(low + (high - low) * share).alias(name))
    return placed.groupBy(*keys).agg(*columns)


def _holding(buckets: DataFrame, columns: list[str]) -> DataFrame:
    """The buckets that hold wanted ranks, each with those it holds."""
    end = F.col("_before") + F.col("_held")
    own = F.filter("_ranks", lambda rank: (rank >= F.col("_before")) & (rank < end))
    return buckets.withColumn("_ranks", own).where(F.size("_ranks") > 0).select(*columns)


def _single(level: DataFrame, keys: list[str]) -> DataFrame:
    """The values at the ranks that lie in buckets of one value."""
    alone = level.where(F.col("_low") == F.col("_high"))
    return alone.select(*keys, F.explode("_ranks").alias("_rank"), F.col("_low").alias("_value"))
