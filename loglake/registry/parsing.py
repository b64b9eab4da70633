"""Registered queries: scanning, rendering and parsing raw lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglake import fixed_values as fv
from loglake.functions.columns import parse_severity
from loglake.operators import parse
from loglake.registry import sql_views as v
from loglake.session import scratch_path
from loglake.sources import render, test_tables
from loglake.sources.raw_text import scan_raw_lines
from loglake.sources.test_tables import DEFAULT_YEAR, INGEST_TS


def _parsed(spark, sf_dir) -> DataFrame:
    return parse.parse_logs(test_tables.log_lines(spark, sf_dir), INGEST_TS, DEFAULT_YEAR)


def _of_format(fmt: str, *columns: str):
    def query(spark, sf_dir):
        rows = _parsed(spark, sf_dir).where(F.col("_format") == fmt)
        return rows.select(F.col("_file").alias("file"), F.col("_line_no").alias("line_no"), *columns)

    return query


def _of_format_sql(fmt: str, *columns: str) -> str:
    return v.with_views(f"select file, line_no, {', '.join(columns)} from parsed where route = '{fmt}'", "parsed")


def scanned(spark, sf_dir):
    """Lines written as text files, one folder per source, and scanned again."""
    folder = scratch_path(spark, "raw")
    lines = test_tables.log_lines(spark, sf_dir).select(F.col("_file").alias("source"), "value")
    lines.write.partitionBy("source").text(folder)
    source = F.regexp_extract("_file", "source=([^/]+)", 1)
    return scan_raw_lines(spark, folder).select(source.alias("file"), "value")


def detected(spark, sf_dir):
    rows = parse.detect_format(test_tables.log_lines(spark, sf_dir))
    return rows.select(
        F.col("_file").alias("file"), F.col("_line_no").alias("line_no"), F.col("_format").alias("format")
    )


def detected_files(spark, sf_dir):
    rows = parse.file_formats(test_tables.log_lines(spark, sf_dir))
    return rows.select(F.col("_file").alias("file"), F.col("_format").alias("format"))


def parse_stats(spark, sf_dir):
    stats = parse.parse_stats(test_tables.log_lines(spark, sf_dir))
    return stats.select(
        F.col("_file").alias("file"), "total_lines", "parse_errors", F.round("success_rate", 4).alias("success_rate")
    )


RECORD_COLUMNS = (
    "timestamp", "level", "severity", "message", "service", "ip", "method", "endpoint", "protocol",
    "status_code", "response_size", "user_agent", "hostname", "pid", "host", "duration_ms", "thread",
)


def parsed(spark, sf_dir):
    return _parsed(spark, sf_dir).select(
        F.col("_file").alias("file"), F.col("_line_no").alias("line_no"), F.col("_format").alias("format"),
        F.col("_raw").alias("raw"), *RECORD_COLUMNS,
    )


def level_severity(spark, sf_dir):
    rows = test_tables.logs(spark, sf_dir)
    return rows.select("row_id", "level", parse_severity(F.col("level")).alias("severity"))


def rendered(spark, sf_dir):
    """Every record in each of the four formats."""
    records = test_tables.logs(spark, sf_dir)
    lines = None
    for fmt in render.RENDERERS:
        part = render.render(records, fmt).withColumn("format", F.lit(fmt))
        lines = part if lines is None else lines.unionByName(part)
    return lines


def union_formats(spark, sf_dir):
    """Records of differing shape stacked into one table, absent columns null."""
    records = test_tables.logs(spark, sf_dir)
    web = records.where(F.col("method") == "GET").select("row_id", "ip", "endpoint", "status_code")
    service = records.where(F.col("method") != "GET").select("row_id", "service", "duration_ms")
    return web.unionByName(service, allowMissingColumns=True)


QUERIES = {
    "scan_raw_lines": scanned,
    "render_log_lines": rendered,
    "union_formats": union_formats,
    "detect_format": detected,
    "detect_file_format": detected_files,
    "parse_apache": _of_format(
        "apache", "timestamp", "level", "message", "ip", "method", "endpoint", "protocol", "status_code",
        "response_size", "user_agent",
    ),
    "parse_syslog": _of_format("syslog", "timestamp", "level", "severity", "message", "service", "hostname", "pid"),
    "parse_json": _of_format("json", "timestamp", "level", "severity", "message", "service", "host", "duration_ms"),
    "parse_application": _of_format("application", "timestamp", "level", "severity", "message", "service", "thread"),
    "parse_generic": _of_format("generic", "timestamp", "level", "severity", "message"),
    "parse_logs": parsed,
    "parse_stats": parse_stats,
    "level_severity": level_severity,
}

_RENDER_SQL = {
    "apache": """concat(ip, ' - - [', strftime(timestamp, '%d/%b/%Y:%H:%M:%S'), ' +0000] "', method, ' ', endpoint,
      ' HTTP/1.1" ', cast(status_code as string), ' ', cast(response_size as string), ' "-" "curl/8.4.0"')""",
    "syslog": """concat(strftime(timestamp, '%b %d %H:%M:%S'), ' prod-01 ', service, '[', cast(1000 + row_id as string),
      ']: [', level, '] ', message)""",
    "json": """concat('{"timestamp": "', strftime(timestamp, '%Y-%m-%dT%H:%M:%S.%f'), '", "level": "', level,
      '", "service": "', service, '", "message": "', message, '", "duration_ms": ', cast(duration_ms as string), '}')""",
    "application": """concat(strftime(timestamp, '%Y-%m-%d %H:%M:%S,%g'), ' [thread-', cast(row_id % 50 as string), '] ',
      rpad(level, 8, ' '), ' ', service, ' - ', message)""",
}

ORACLES = {
    "scan_raw_lines": v.with_views("select file, value from doubled", "doubled"),
    "render_log_lines": v.with_views(
        " union all ".join(f"select row_id, {x} as value, '{f}' as format from logs" for f, x in _RENDER_SQL.items()),
        "logs",
    ),
    "union_formats": v.with_views(
        """select row_id, ip, endpoint, status_code, null as service, null as duration_ms from logs where method = 'GET'
           union all select row_id, null, null, null, service, duration_ms from logs where method <> 'GET'""",
        "logs",
    ),
    "detect_format": v.with_views(f"select file, line_no, {v.LINE_FORMAT} as format from nonblank", "nonblank"),
    "detect_file_format": v.with_views("select file, fmt as format from file_formats", "file_formats"),
    "parse_apache": _of_format_sql(
        "apache", "timestamp", "level", "message", "ip", "method", "endpoint", "protocol", "status_code",
        "response_size", "user_agent",
    ),
    "parse_syslog": _of_format_sql("syslog", "timestamp", "level", "severity", "message", "service", "hostname", "pid"),
    "parse_json": _of_format_sql("json", "timestamp", "level", "severity", "message", "service", "host", "duration_ms"),
    "parse_application": _of_format_sql(
        "application", "timestamp", "level", "severity", "message", "service", "thread"
    ),
    "parse_generic": _of_format_sql("generic", "timestamp", "level", "severity", "message"),
    "parse_logs": v.with_views(
        f"select file, line_no, route as format, raw, {', '.join(RECORD_COLUMNS)} from parsed", "parsed"
    ),
    "parse_stats": v.with_views(
        """select f.file, cast(count(r.file) as bigint) as total_lines,
             cast(count(r.file) filter (where r.route in ('generic', 'dropped')) as bigint) as parse_errors,
             round(case when count(r.file) > 0 then
               count(r.file) filter (where r.route not in ('generic', 'dropped')) / count(r.file) * 100 else 0 end, 4) as success_rate
           from (select distinct file from doubled) f left join routed r on f.file = r.file group by f.file""",
        "doubled", "routed",
    ),
    "level_severity": v.with_views(
        f"select row_id, level, {v.severity_case('level', fv.PARSE_SEVERITY)} as severity from logs", "logs"
    ),
}
