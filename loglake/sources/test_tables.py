"""Log-shaped views of the test tables (``events``, ``documents``, ``embeddings``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loglake.session import spread

# The same text serves Spark and the SQL check.
LOGS_SQL = """
select event_id as row_id, ts as timestamp,
  case event_type when 'error' then case when value >= 100 then 'FATAL' else 'ERROR' end
    when 'signup' then 'WARN' when 'view' then 'DEBUG' else 'INFO' end as level,
  concat('svc-', cast(user_id % 8 as string)) as service,
  concat('10.0.', cast(user_id % 4 as string), '.', cast(user_id % 20 as string)) as ip,
  case event_type when 'purchase' then 'POST' when 'signup' then 'PUT'
    when 'error' then 'DELETE' else 'GET' end as method,
  concat('/api/v1/r', cast(cast(regexp_extract(props, '([0-9]+)', 1) as int) % 12 as string)) as endpoint,
  case when event_type = 'error' then case when user_id % 2 = 0 then 500 else 404 end
    when event_type = 'signup' then 201 else 200 end as status_code,
  cast(floor(value * 100) as bigint) as response_size,
  cast(floor(value * 10) as bigint) as duration_ms,
  concat(event_type, ' request from usr_', cast(user_id as string),
    case event_type when 'error' then ' failed: timeout on /var/log/app.log'
      when 'signup' then ' slow, retry 10.0.0.1' else ' completed: success' end) as message
from {events}
"""

# The same records with holes: no time, no message, a short message or no level.
GAPS_SQL = """
select row_id, case when row_id % 11 = 0 then null else timestamp end as timestamp,
  case when row_id % 7 = 0 then null when row_id % 13 = 0 then substring(message, 1, 3) else message end as message,
  case when row_id % 5 = 0 then null else level end as level,
  case when row_id % 3 = 0 then null else status_code end as status_code,
  case when row_id % 4 = 0 then null else response_size end as response_size,
  case when row_id % 6 = 0 then null else duration_ms end as duration_ms,
  service, method
from {logs}
"""

INGEST_TS = "2026-01-01 00:00:00"
DEFAULT_YEAR = 2024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One log record per event, levels as written by the source (WARN, FATAL)."""
    return spark.sql(LOGS_SQL, events=table(spark, sf_dir, "events"))


def gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(GAPS_SQL, logs=logs(spark, sf_dir))


def log_lines(spark: SparkSession, sf_dir: str, duplicates: bool = True) -> DataFrame:
    """Raw lines in six files, one per format plus a generic and a blank one.

    With ``duplicates`` every fiftieth record is written again in a seventh file.
    """
    from loglake.sources.render import render_lines

    rendered = render_lines(logs(spark, sf_dir))
    if not duplicates:
        return rendered
    again = rendered.where(F.col("_line_no") % 50 == 0).withColumn("_file", F.lit("f9"))
    return rendered.unionByName(again)


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs(spark, sf_dir).select("row_id", "message")


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Free text in the place of messages."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("row_id"), F.col("text").alias("message")
    )
