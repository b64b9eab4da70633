"""Streams over processed records by event time: window statistics and duplicates.

Both keep state up to a watermark, the latest time seen less a delay. Records
behind it are late and are dropped by that rule, and state behind it is given up, so state
stays as large as the delay, not as the stream. Runs take what has arrived and stop;
the next one goes on from the checkpoint.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglake.operators.features import window_stats


def _run(stream: DataFrame, table: str, progress: str) -> None:
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", table)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _timed(records: DataFrame, time: str, delay: str) -> DataFrame:
    """Records with a watermark on ``_time``, an instant; those without a time are left out."""
    return records.where(F.col(time).isNotNull()).withColumn("_time", F.col(time).cast("timestamp")).withWatermark("_time", delay)


def append_window_features(records: DataFrame, table: str, progress: str, minutes: int = 60, delay: str = "1 day") -> None:
    """Adds to ``table`` the statistics of every time window that is complete: one row per
    window, written once, when the watermark has passed its end.

    ``records`` is a stream with a ``timestamp``. Records of windows that are complete are
    late and do not count. The statistics are those of ``window_features`` without the exact
    distinct counts and the percentile, which need all records of a window together; distinct counts come from sketches.
    """
    stats = window_stats(records.columns, F.approx_count_distinct)
    rows = _timed(records, "timestamp", delay)
    windows = rows.groupBy(F.window("_time", f"{minutes} minutes").alias("_window")).agg(*(c.alias(n) for n, c in stats.items()))
    start = F.col("_window.start").cast("timestamp_ntz").alias("window_start")
    _run(windows.select(start, *(F.coalesce(n, F.lit(0)).alias(n) for n in stats)), table, progress)


def append_first_copies(
    records: DataFrame, table: str, progress: str, keys: Sequence[str], time: str = "timestamp", delay: str = "1 day"
) -> None:
    """Adds to ``table`` the records that are no copy (equal ``keys``) of one up to ``delay`` before.

    Unlike the store of all lines (``line_store``), this forgets: a key is kept until the watermark is ``delay`` past
    the record that was taken, so an old record's copy is taken again.
    """
    rows = _timed(records, time, delay).dropDuplicatesWithinWatermark(list(keys))
    _run(rows.drop("_time"), table, progress)
