"""Aggregates as states of each batch and day, stored once and merged without a scan.

A recurring run stores what its own records add: counts of every report section, and per day
a quantile sketch of each measure and a distinct-count sketch of each identity. Sections
and days of any batches are then merged from these small tables. A repeated batch replaces
its own states, so it never counts twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loglake.operators.aggregate import aggregate_all
from loglake.sources import lake

#: Size of a quantile sketch: the rank of a value it gives is off by less than 1 % (of all values) in 99 of 100 cases.
QUANTILE_SIZE = 400
#: Registers of a distinct count, as a power of two: its standard error is about 0.8 %.
DISTINCT_BITS = 14
MEASURES = ("duration_ms", "response_size")
IDENTITIES = ("message", "ip")


def daily_states(df: DataFrame, measures: Sequence[str] = MEASURES, identities: Sequence[str] = IDENTITIES) -> DataFrame:
    """One row per day: records, and for each measure and identity its sketch. Records
    without a day are left out, null and NaN values of a column do not enter its sketch."""
    states = [F.count("*").alias("records")]
    for name in measures:
        number = F.nanvl(F.col(name).cast("double"), F.lit(None).cast("double"))
        states.append(F.kll_sketch_agg_double(number, QUANTILE_SIZE).alias(f"{name}_ranks"))
    for name in identities:
        states.append(F.hll_sketch_agg(name, DISTINCT_BITS).alias(f"{name}_distinct"))
    return df.where(F.col("date").isNotNull()).groupBy("date").agg(*states)


def store_batch(df: DataFrame, root: str, batch: str, **columns) -> None:
    """Adds a batch's counts and daily states to the lake, in the place of an earlier run of the same batch."""
    lake.store_batch(aggregate_all(df), root, "processed", "section_counts", batch, by="batch")
    lake.store_batch(daily_states(df, **columns), root, "processed", "daily_states", batch, by="batch")


def _stored(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(lake.zone_path(root, "processed", name))


def section_counts(spark: SparkSession, root: str) -> DataFrame:
    """All value counts of all batches: what ``aggregate_all`` gives on all of their records."""
    counts = _stored(spark, root, "section_counts")
    return counts.groupBy("section", "key").agg(F.sum("records").alias("records"))


def quantile(sketch: Column, share: float) -> Column:
    """The value of a rank; null if the sketch is empty."""
    return F.when(F.kll_sketch_get_n_double(sketch) > 0, F.kll_sketch_get_quantile_double(sketch, F.lit(share)))


def merged(states: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Daily states of any days and batches as one state, or as one per ``by`` (such as a month)."""
    columns = [F.sum("records").alias("records")]
    for name in states.columns:
        if name.endswith("_ranks"):
            columns.append(F.kll_merge_agg_double(name).alias(name))
        elif name.endswith("_distinct"):
            columns.append(F.hll_union_agg(name).alias(name))
    return states.groupBy(*by).agg(*columns)


def day_range(spark: SparkSession, root: str, first: str, last: str) -> DataFrame:
    """Records, p50, p95 and p99 of every measure and distinct values of every identity from
    ``first`` to ``last``, both included, read from stored states alone."""
    states = _stored(spark, root, "daily_states").where(F.col("date").between(F.lit(first), F.lit(last)))
    state = merged(states)
    columns: list[Column] = [F.coalesce("records", F.lit(0)).alias("records")]
    for name in state.columns:
        if name.endswith("_ranks"):
            measure = name.removesuffix("_ranks")
            columns += [quantile(F.col(name), p / 100).alias(f"{measure}_p{p}") for p in (50, 95, 99)]
        elif name.endswith("_distinct"):
            columns.append(F.coalesce(F.hll_sketch_estimate(name), F.lit(0)).alias(name))
    return state.select(*columns)
