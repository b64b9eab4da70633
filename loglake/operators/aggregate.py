"""Aggregates of the enriched log table.

Counts are hash aggregates with a partial step, so hot values are reduced before the
shuffle. Every top-k breaks ties by key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglake import fixed_values as fv
from loglake.functions.columns import is_error, percent
from loglake.operators.percentiles import exact_percentiles

# section name -> column counted
SECTIONS = {
    "level_distribution": "level",
    "hourly_distribution": "hour",
    "daily_counts": "date",
    "top_endpoints": "endpoint",
    "top_ips": "ip",
    "top_services": "service",
    "status_distribution": "status_code",
    "time_bucket_distribution": "time_bucket",
}


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value of ``column``, nulls left out, most frequent first."""
    counted = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("records"))
    return counted.orderBy(F.desc("records"), column)


def counts_in_order(df: DataFrame, column: str) -> DataFrame:
    """Rows per value of ``column`` in the order of the values."""
    counted = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("records"))
    return counted.orderBy(column)


def top_counts(df: DataFrame, column: str, k: int = 10) -> DataFrame:
    return value_counts(df, column).limit(k)


def counts_with_zeros(df: DataFrame, column: str, values: tuple[str, ...]) -> DataFrame:
    """Rows per listed value, 0 for values that do not occur. One row is shuffled per task."""
    counts = df.agg(*(F.count_if(F.col(column) == v).alias(v) for v in values))
    pairs = F.array(*(F.struct(F.lit(v).alias(column), F.col(v).alias("records")) for v in values))
    return counts.select(F.inline(pairs))


def error_rate(df: DataFrame, *keys: str) -> DataFrame:
    """Records, errors and error percentage, overall or per ``keys``."""
    errors = F.count_if(is_error(F.col("level")))
    return df.groupBy(*keys).agg(
        F.count("*").alias("total_records"),
        errors.alias("error_count"),
        percent(errors, F.count("*")).alias("error_rate"),
    )


def response_size_stats(df: DataFrame) -> DataFrame:
    """Mean, median, largest and total size of the responses that have one."""
    size = F.col("response_size")
    stats = df.agg(
        F.round(F.avg(size), 2).alias("mean"), F.max(size).alias("max"), F.sum(size).alias("total")
    )
    median = exact_percentiles(df, [], "response_size", {"median": 0.5})
    return _beside(stats, median.select(F.round("median", 2).alias("median")))


def duration_stats(df: DataFrame) -> DataFrame:
    """Mean, p50, p95, p99 and longest duration, two decimals."""
    duration = F.col("duration_ms").cast("double")
    stats = df.agg(F.round(F.avg(duration), 2).alias("mean"), F.round(F.max(duration), 2).alias("max"))
    ranks = exact_percentiles(df, [], "duration_ms", {"p50": 0.5, "p95": 0.95, "p99": 0.99})
    return _beside(stats, ranks.select(*(F.round(c, 2).alias(c) for c in ranks.columns)))


def _beside(left: DataFrame, right: DataFrame) -> DataFrame:
    """Two one-row tables as one row."""
    one = F.lit(1).alias("_one")
    return left.select(one, "*").join(right.select(one, "*"), "_one", "left").drop("_one")


def _section_name(grouping: Column) -> Column:
    """Names the grouping set: its column is the only one with a 0 bit."""
    n = len(SECTIONS)
    chain = F
    for i, name in enumerate(SECTIONS):
        chain = chain.when(grouping == (2**n - 1) - 2 ** (n - 1 - i), name)
    return chain.otherwise("total_records")


def aggregate_all(df: DataFrame) -> DataFrame:
    """All value counts from one scan, as (section, key, records); nulls left out."""
    columns = list(SECTIONS.values())
    grouped = df.groupingSets([[c] for c in columns] + [[]], *columns).agg(
        F.grouping_id().alias("_grouping"), F.count("*").alias("records")
    )
    key = F.coalesce(*(F.col(c).cast("string") for c in columns))
    section = _section_name(F.col("_grouping"))
    return grouped.select(section.alias("section"), key.alias("key"), "records").where(
        F.col("key").isNotNull() | (F.col("section") == "total_records")
    )


def hour_weekday_matrix(df: DataFrame) -> DataFrame:
    """Records per weekday (rows) and hour (columns h0..h23)."""
    cells = [F.count_if(F.col("hour") == h).alias(f"h{h}") for h in range(24)]
    return df.where(F.col("day_of_week").isNotNull()).groupBy("day_of_week").agg(*cells)


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Equal-width bins between the smallest and the largest value, empty ones left out.

    Two scans: the range first (a scalar sub-query), then the counts.
    """
    bounds = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    lo, hi = bounds.select("lo").scalar(), bounds.select("hi").scalar()
    value = F.col(column)
    # the largest value belongs to the last bin; a single distinct value fills bin 1
    place = F.when(lo < hi, F.least(F.floor((value - lo) / ((hi - lo) / bins)) + 1, F.lit(bins)))
    return (
        df.where(value.isNotNull() & ~F.isnan(value.cast("double")))
        .groupBy(F.coalesce(place, F.lit(1)).cast("int").alias("bin"))
        .agg(F.count("*").alias("records"))
    )


def time_bucket_distribution(df: DataFrame) -> DataFrame:
    return counts_with_zeros(df, "time_bucket", fv.TIME_BUCKETS)
