"""Structured records of a table rendered as raw lines of the formats the parser knows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def apache_line() -> Column:
    return F.concat(
        F.col("ip"), F.lit(" - - ["), F.date_format("timestamp", "dd/MMM/yyyy:HH:mm:ss"),
        F.lit(' +0000] "'), F.col("method"), F.lit(" "), F.col("endpoint"), F.lit(' HTTP/1.1" '),
        F.col("status_code").cast("string"), F.lit(" "), F.col("response_size").cast("string"),
        F.lit(' "-" "curl/8.4.0"'),
    )


def syslog_line() -> Column:
    return F.concat(
        F.date_format("timestamp", "MMM dd HH:mm:ss"), F.lit(" prod-01 "), F.col("service"),
        F.lit("["), (F.lit(1000) + F.col("row_id")).cast("string"), F.lit("]: ["), F.col("level"),
        F.lit("] "), F.col("message"),
    )


def application_line() -> Column:
    return F.concat(
        F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss,SSS"), F.lit(" [thread-"),
        (F.col("row_id") % 50).cast("string"), F.lit("] "), F.rpad("level", 8, " "), F.lit(" "),
        F.col("service"), F.lit(" - "), F.col("message"),
    )


def json_line() -> Column:
    time = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.concat(
        F.lit('{"timestamp": "'), time, F.lit('", "level": "'), F.col("level"),
        F.lit('", "service": "'), F.col("service"), F.lit('", "message": "'), F.col("message"),
        F.lit('", "duration_ms": '), F.col("duration_ms").cast("string"), F.lit("}"),
    )


def generic_line() -> Column:
    time = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.concat(F.lit("# "), F.col("level"), F.lit(" "), time, F.lit(" "), F.col("message"))


RENDERERS = {
    "apache": apache_line,
    "syslog": syslog_line,
    "json": json_line,
    "application": application_line,
}


def render(records: DataFrame, fmt: str) -> DataFrame:
    """All records in one format."""
    if fmt not in RENDERERS:
        raise ValueError(f"unknown log format {fmt!r}: use one of {sorted(RENDERERS)}")
    return records.select("row_id", RENDERERS[fmt]().alias("value"))


def render_lines(records: DataFrame) -> DataFrame:
    """Every record as a line of one of five files, four formats and a generic one; with
    every sixth record a blank line is added to a sixth file."""
    kind = F.col("row_id") % 5
    value = (
        F.when(kind == 0, syslog_line())
        .when(kind == 1, application_line())
        .when(kind == 2, json_line())
        .when(kind == 3, generic_line())
        .otherwise(apache_line())
    )
    line = F.struct(F.concat(F.lit("f"), kind.cast("string")).alias("_file"), value.alias("value"))
    blank = F.struct(F.lit("f5").alias("_file"), F.lit("  ").alias("value"))
    lines = F.when(F.col("row_id") % 6 == 5, F.array(line, blank)).otherwise(F.array(line))
    return records.select(F.col("row_id").alias("_line_no"), F.inline(lines)).select(
        "_file", F.lit(0).cast("bigint").alias("_block"), "_line_no", "value"
    )
