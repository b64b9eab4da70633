"""Registered queries: cleaning, filters, enrichment."""

from __future__ import annotations

from pyspark.sql import functions as F

from loglake.functions import columns as c
from loglake.operators import clean
from loglake.operators.enrich import enrich_logs
from loglake.operators.parse import parse_logs
from loglake.registry import sql_views as v
from loglake.sources import test_tables as t


def _parsed(spark, sf_dir):
    return parse_logs(t.log_lines(spark, sf_dir), t.INGEST_TS, t.DEFAULT_YEAR)


def _enriched(spark, sf_dir):
    return enrich_logs(t.logs(spark, sf_dir))


def dedup_raw(spark, sf_dir):
    first = clean.dedup_keep_first(t.log_lines(spark, sf_dir), key="value")
    return first.select(F.col("_file").alias("file"), F.col("_line_no").alias("line_no"), "value")


def dedup_rows(spark, sf_dir):
    rows = t.logs(spark, sf_dir).select("level", "service", "ip", "method", "endpoint", "status_code")
    return clean.dedup_rows(rows)


CLEAN_COLUMNS = ("timestamp", "level", "message", "service", "status_code")


def cleaned(spark, sf_dir):
    rows = clean.clean_logs(_parsed(spark, sf_dir))
    return rows.select(F.col("_file").alias("file"), F.col("_line_no").alias("line_no"), *CLEAN_COLUMNS)


def coerced(spark, sf_dir):
    """Times as text in several spellings, some of them unreadable."""
    iso = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    blank = F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss")
    text = F.when(F.col("row_id") % 3 == 0, iso).when(F.col("row_id") % 3 == 1, blank).otherwise("not a time")
    return t.logs(spark, sf_dir).select("row_id", c.coerce_timestamp(text).alias("timestamp"))


ENRICHED_COLUMNS = (
    "row_id", "level", "hour", "day_of_week", "date", "is_business_hours", "time_bucket", "severity_num",
    "message_length", "status_category",
)


def _columns(*names):
    return lambda spark, sf_dir: _enriched(spark, sf_dir).select("row_id", *names)


def _columns_sql(*names):
    return v.with_views(f"select row_id, {', '.join(names)} from enriched", "enriched")


def _gap_query(operator, *columns):
    return lambda spark, sf_dir: operator(t.gaps(spark, sf_dir)).select("row_id", *columns)


def filtered(spark, sf_dir):
    rows = clean.filter_logs(_enriched(spark, sf_dir), "ERROR", "svc-3", order=("timestamp", "row_id"))
    return rows.select("row_id", "timestamp", "level", "service", "message")


def status_edges(spark, sf_dir):
    """Status codes spread over every bin edge."""
    status = (F.col("response_size") % 700).cast("int")
    return t.logs(spark, sf_dir).select(
        "row_id", status.alias("status_code"), c.status_category(status).alias("status_category")
    )


def anomalies(spark, sf_dir):
    rows = _enriched(spark, sf_dir).withColumn("is_anomaly", (F.col("level") == "CRITICAL").cast("int"))
    from loglake.operators.anomaly import anomaly_listing

    return anomaly_listing(rows).select("row_id", "timestamp", "level", "message")


QUERIES = {
    "dedup_raw": dedup_raw,
    "dedup_rows": dedup_rows,
    "drop_nulls": _gap_query(clean.drop_nulls, "timestamp", "message"),
    "fill_nulls": _gap_query(clean.fill_nulls, "message", "level"),
    "min_message_length": _gap_query(clean.min_message_length, "message"),
    "valid_timestamps": _gap_query(clean.valid_timestamps, "timestamp"),
    "coerce_timestamp": coerced,
    "clean_audit": lambda s, d: clean.clean_audit(t.gaps(s, d), key="message", order=("row_id",)),
    "clean_audit_fill": lambda s, d: clean.clean_audit(t.gaps(s, d), key="message", order=("row_id",), null_handling="fill"),
    "clean_logs": cleaned,
    "filter_logs": filtered,
    "filter_choices": lambda s, d: clean.filter_choices(_enriched(s, d)),
    "anomaly_listing": anomalies,
    "sort_by_time": lambda s, d: t.logs(s, d).select("row_id", "timestamp").orderBy("timestamp", "row_id"),
    "normalize_level": _columns("level"),
    "time_parts": _columns("hour", "day_of_week", "date"),
    "business_hours": _columns("is_business_hours"),
    "time_bucket": _columns("time_bucket"),
    "severity_num": _columns("severity_num"),
    "status_category": status_edges,
    "enrich_logs": _columns(*ENRICHED_COLUMNS[1:]),
}

_AUDIT = """select cast(sum(copies) as bigint) as input_rows, cast(sum(copies - 1) as bigint) as duplicates,
    count(*) filter (where gone) as null_rows,
    count(*) filter (where not gone and chars < 5) as short_messages,
    count(*) filter (where not gone and chars >= 5 and timestamp is null) as invalid_times,
    count(*) filter (where not gone and chars >= 5 and timestamp is not null) as output_rows
  from (select *, coalesce(length(message), 0) as chars, {null} as gone, row_number() over (partition by message order by row_id) as copy,
      count(*) over (partition by message) as copies from gaps)
  where copy = 1"""

ORACLES = {
    "dedup_raw": v.with_views(
        """select file, line_no, value from (select *, row_number() over (partition by value order by file, line_no) as copy
           from doubled) where copy = 1""",
        "doubled",
    ),
    "dedup_rows": v.with_views("select distinct level, service, ip, method, endpoint, status_code from logs", "logs"),
    "drop_nulls": v.with_views(
        "select row_id, timestamp, message from gaps where timestamp is not null and message is not null", "gaps"
    ),
    "fill_nulls": v.with_views(
        "select row_id, coalesce(message, '') as message, coalesce(level, 'INFO') as level from gaps", "gaps"
    ),
    "min_message_length": v.with_views("select row_id, message from gaps where length(message) >= 5", "gaps"),
    "valid_timestamps": v.with_views("select row_id, timestamp from gaps where timestamp is not null", "gaps"),
    "coerce_timestamp": v.with_views(
        """select row_id, case row_id % 3 when 0 then timestamp when 1 then date_trunc('second', timestamp) end as timestamp
           from logs""",
        "logs",
    ),
    "clean_audit": v.with_views(_AUDIT.format(null="timestamp is null or message is null"), "gaps"),
    "clean_audit_fill": v.with_views(_AUDIT.format(null="false"), "gaps"),
    "clean_logs": v.with_views(f"select file, line_no, {', '.join(CLEAN_COLUMNS)} from cleaned", "cleaned"),
    "filter_logs": v.with_views(
        """select row_id, timestamp, level, service, message from enriched where level = 'ERROR' and service = 'svc-3'
           order by timestamp, row_id limit 500""",
        "enriched",
    ),
    "filter_choices": v.with_views(
        """select distinct 'level' as field, level as choice from enriched union select distinct 'service', service from enriched
           union select distinct 'date', date from enriched""",
        "enriched",
    ),
    "anomaly_listing": v.with_views(
        "select row_id, timestamp, level, message from labelled where is_anomaly = 1 order by row_id limit 200", "labelled"
    ),
    "sort_by_time": v.with_views("select row_id, timestamp from logs order by timestamp, row_id", "logs"),
    "normalize_level": _columns_sql("level"),
    "time_parts": _columns_sql("hour", "day_of_week", "date"),
    "business_hours": _columns_sql("is_business_hours"),
    "time_bucket": _columns_sql("time_bucket"),
    "severity_num": _columns_sql("severity_num"),
    "status_category": v.with_views(
        """select row_id, cast(response_size % 700 as int) as status_code,
             case when response_size % 700 between 1 and 199 then '1xx' when response_size % 700 between 200 and 299 then '2xx'
               when response_size % 700 between 300 and 399 then '3xx' when response_size % 700 between 400 and 499 then '4xx'
               when response_size % 700 between 500 and 599 then '5xx' end as status_category
           from logs""",
        "logs",
    ),
    "enrich_logs": _columns_sql(*ENRICHED_COLUMNS[1:]),
}
