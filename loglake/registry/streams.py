"""Registered queries: event-time streams in several runs, and the same rules as SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from loglake.operators.enrich import enrich_logs
from loglake.registry import sql_views as v
from loglake.session import scratch_path
from loglake.sources import test_tables as t
from loglake.streaming import event_time

#: Days of a month on which the second and the third run begin.
_SECOND, _THIRD = "2024-01-11", "2024-01-21"
_DELAY_DAYS = 1
_STATS = ("log_count", "count_error", "error_rate", "avg_duration", "max_duration", "total_response_size", "error_status_count")


def _run_of(time):
    return F.when(time < _SECOND, 1).when(time < _THIRD, 2).otherwise(3)


def window_stream(spark, sf_dir):
    """Hourly windows of records that arrive in three runs. Every tenth record comes one run
    too late: most of these belong to windows that are complete by then."""
    root = scratch_path(spark, "stream")
    rows = enrich_logs(t.logs(spark, sf_dir))
    late = ((F.col("row_id") % 10 == 0) & (F.col("timestamp") < _THIRD)).cast("int")
    rows = rows.withColumn("run", _run_of(F.col("timestamp")) + late)
    for run in (1, 2, 3):
        rows.where(F.col("run") == run).drop("run").write.mode("append").parquet(f"{root}/records")
        stream = spark.readStream.schema(rows.drop("run").schema).parquet(f"{root}/records")
        event_time.append_window_features(stream, f"{root}/windows", f"{root}/progress", delay=f"{_DELAY_DAYS} days")
    found = spark.read.parquet(f"{root}/windows")
    return found.select("window_start", *(F.round(c, 6).alias(c) if c in ("error_rate", "avg_duration") else F.col(c) for c in _STATS))


def copies_stream(spark, sf_dir):
    """How often records are taken that come again two hours and twenty days later, in three runs."""
    root = scratch_path(spark, "stream")
    rows = t.logs(spark, sf_dir).select("row_id", "timestamp", "message")
    last = rows.agg(F.max("timestamp")).first()[0]
    later = lambda hours: rows.where("row_id % 5 = 0").withColumn("timestamp", F.col("timestamp") + F.expr(f"interval {hours} hours"))
    rows = rows.unionByName(later(2)).unionByName(later(480)).where(F.col("timestamp") <= F.lit(last))
    rows = rows.withColumn("run", _run_of(F.col("timestamp")))
    for run in (1, 2, 3):
        rows.where(F.col("run") == run).drop("run").write.mode("append").parquet(f"{root}/records")
        stream = spark.readStream.schema(rows.drop("run").schema).parquet(f"{root}/records")
        event_time.append_first_copies(stream, f"{root}/taken", f"{root}/progress", ["row_id", "message"], delay=f"{_DELAY_DAYS} days")
    return spark.read.parquet(f"{root}/taken").groupBy("row_id").agg(F.count("*").alias("taken"))


QUERIES = {"window_stream": window_stream, "copies_stream": copies_stream}

_RUN = f"case when timestamp < timestamp '{_SECOND}' then 1 when timestamp < timestamp '{_THIRD}' then 2 else 3 end"
ORACLES = {
    # a run's watermark is the latest time of the runs before it, less the delay
    "window_stream": v.with_views(
        f"""select window_start, count(*) as log_count, count(*) filter (where level = 'ERROR') as count_error,
              round(count(*) filter (where level in ('ERROR', 'CRITICAL')) / count(*), 6) as error_rate, round(avg(duration_ms), 6) as avg_duration,
              max(duration_ms) as max_duration, cast(sum(response_size) as bigint) as total_response_size,
              count(*) filter (where status_code >= 400) as error_status_count
            from (select *, time_bucket(interval '1 hour', timestamp) as window_start,
                {_RUN} + case when row_id % 10 = 0 and timestamp < timestamp '{_THIRD}' then 1 else 0 end as run from enriched) r
            left join (select run + 1 as after_run, max(latest) over (order by run) - interval '{_DELAY_DAYS} days' as passed
              from (select {_RUN} + case when row_id % 10 = 0 and timestamp < timestamp '{_THIRD}' then 1 else 0 end as run,
                max(timestamp) as latest from enriched group by 1)) on run = after_run
            where (passed is null or window_start + interval '1 hour' > passed)
              and window_start + interval '1 hour' <= (select max(timestamp) - interval '{_DELAY_DAYS} days' from enriched)
            group by 1""",
        "enriched",
    ),
    "copies_stream": v.with_views(
        """select row_id, 1 + case when row_id % 5 = 0 and timestamp + interval '480 hours' <= (select max(timestamp) from logs)
             then 1 else 0 end as taken from logs""",
        "logs",
    ),
}
