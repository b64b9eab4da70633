"""Raw lines to records: format detection, routing and typed columns in one pass.

Input rows follow ``LINE_SCHEMA``. Nothing here shuffles, except that ``mode="file"``
needs the first line of each file, which is one small aggregate plus a checked join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglake import fixed_values as fv
from loglake.functions.columns import coerce_timestamp, parse_severity, strip
from loglake.operators.lookup import lookup_join
from loglake.operators.position import ranked
from loglake.schema import RECORD_SCHEMA
from loglake.session import written

# (?s): a message may hold any character, line separators of other alphabets included.
APACHE = "(?s)" + fv.APACHE_PATTERN
SYSLOG = "(?s)" + fv.SYSLOG_PATTERN
APPLICATION = "(?s)" + fv.APPLICATION_PATTERN


def nonblank_lines(lines: DataFrame) -> DataFrame:
    """Stripped lines without the blank ones and without undecodable bytes."""
    value = F.replace(F.col("value"), F.lit("\ufffd"), F.lit(""))
    some_text = F.col("value").rlike(f"[^{fv.WHITESPACE_CLASS}\ufffd]")
    return lines.where(some_text).withColumn("value", strip(value))


def json_document(value: Column) -> Column:
    """The line as one JSON value, or null when it is not exactly one.

    The JSON reader stops after the first value and ignores what follows. The line is
    therefore read as the first item of an array whose second item is the line's own
    hash: only a line that is a single whole value leaves that hash in second place.
    """
    mark = F.xxhash64(value)
    pair = F.try_parse_json(F.concat(F.lit("["), value, F.lit(","), mark.cast("string"), F.lit("]")))
    whole = F.try_variant_get(pair, "$[1]", "bigint") == mark
    return F.when(whole, F.variant_get(pair, "$[0]", "variant"))


def line_format(value: Column) -> Column:
    """Format of a stripped line, tried in the order json, apache, syslog, application."""
    return (
        F.when(value.startswith("{") & json_document(value).isNotNull(), "json")
        .when(value.rlike(APACHE), "apache")
        .when(value.rlike(SYSLOG), "syslog")
        .when(value.rlike(APPLICATION), "application")
        .otherwise("unknown")
    )


def detect_format(lines: DataFrame) -> DataFrame:
    """Adds ``_format`` to each non-blank line."""
    return nonblank_lines(lines).withColumn("_format", line_format(F.col("value")))


def file_formats(lines: DataFrame) -> DataFrame:
    """One row per file that has text: ``_rank`` in name order and the format of its first non-blank line.

    A hash aggregate finds the number of that line; the line itself is then fetched, from
    rows no further down than the last of these numbers.
    """
    some = nonblank_lines(lines)
    firsts = written(ranked(some.groupBy("_file").agg(F.min("_line_no").alias("_line_no"))), "first-lines")
    last = firsts.agg(F.max("_line_no")).first()[0]
    heads = nonblank_lines(lines.where(F.col("_line_no") <= (-1 if last is None else last)))
    return heads.join(firsts, ["_file", "_line_no"]).select("_file", "_rank", line_format(F.col("value")).alias("_format"))


def _instant_to_utc(instant: Column) -> Column:
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), instant.cast("timestamp_ntz"))


def _apache_time(text: Column) -> Column:
    """Time with its offset applied; an unreadable offset is ignored."""
    stem = "d/MMM/yyyy:H:m:s"
    with_offset = F.coalesce(
        F.try_to_timestamp(text, F.lit(f"{stem} Z")), F.try_to_timestamp(text, F.lit(f"{stem} XXX"))
    )
    bare = F.try_to_timestamp(F.substring_index(text, " ", 1), F.lit(stem))
    return F.coalesce(_instant_to_utc(with_offset), bare.cast("timestamp_ntz"))


def _json_time(text: Column) -> Column:
    has_offset = text.rlike(r"(Z|[+-]\d{2}:?\d{2})$") & text.rlike(r"[T ]\d")
    instant = F.try_to_timestamp(text)
    # a bare time of day would be read as today's
    return F.when(text.rlike(r"^\d{4}"), F.when(has_offset, _instant_to_utc(instant)).otherwise(
        coerce_timestamp(text)))


def _generic_time(value: Column) -> Column:
    """First ISO time in the line, else the first bracket-style one; null if unreadable."""
    iso = F.regexp_extract(value, fv.GENERIC_ISO_TIME, 0)
    other = F.regexp_extract(value, fv.GENERIC_APACHE_TIME, 0)
    iso_time = F.try_to_timestamp(F.translate(iso, "T", " "), F.lit("yyyy-MM-dd HH:mm:ss"))
    other_time = F.try_to_timestamp(other, F.lit("d/MMM/yyyy:H:m:s"))
    return F.when(iso != "", iso_time).when(other != "", other_time).cast("timestamp_ntz")


def with_format(lines: DataFrame, mode: str = "file") -> DataFrame:
    """Non-blank lines with ``_format``, per file (first line decides) or per line."""
    if mode == "line":
        return detect_format(lines)
    if mode != "file":
        raise ValueError(f"unknown mode {mode!r}: use 'file' or 'line'")
    return lookup_join(nonblank_lines(lines), file_formats(lines).drop("_rank"), "_file")


# Separates the captured groups; a line that itself contains it takes the slower way.
_MARK = "\x01"
_GROUPS = {"apache": (APACHE, 9), "syslog": (SYSLOG, 6), "application": (APPLICATION, 5)}


def _captures(value: Column, fmt: Column) -> Column:
    """All groups of the format's pattern from one match; a single item if it fails."""
    quick, careful = F, F
    for name, (pattern, groups) in _GROUPS.items():
        joined = _MARK.join(f"${i}" for i in range(1, groups + 1))
        one_match = F.regexp_replace(value, F.lit(f"{pattern}.*$"), F.lit(joined))
        quick = quick.when(fmt == name, F.split(one_match, _MARK))
        each = F.array(*(F.regexp_extract(value, pattern, i) for i in range(1, groups + 1)))
        careful = careful.when((fmt == name) & value.rlike(pattern), each)
    return F.when(value.contains(_MARK), careful).otherwise(quick)


def route_lines(formatted: DataFrame) -> DataFrame:
    """Decides what becomes of each line: ``_outcome`` is ok, generic or dropped.

    Adds the captured groups (``_part``), the JSON value (``_doc``) and the time of an
    apache line, whose failure to parse is what sends that line to the generic reader.
    """
    value, fmt, part, doc = (F.col(c) for c in ("value", "_format", "_part", "_doc"))
    matched = F.when(fmt == "json", doc.isNotNull())
    for name, (_, groups) in _GROUPS.items():
        matched = matched.when(fmt == name, F.coalesce(F.size(part) == groups, F.lit(False)))
    level_kind = F.schema_of_variant(F.try_variant_get(doc, "$.level", "variant"))
    # a whole JSON value that starts with a brace is an object
    json_readable = value.startswith("{") & (level_kind.isNull() | (level_kind == "STRING"))
    outcome = (
        F.when(fmt == "unknown", "generic")
        .when(~F.col("_matched"), "dropped")
        .when((fmt == "apache") & F.col("_apache_time").isNull(), "generic")
        .when((fmt == "json") & ~json_readable, "generic")
        .otherwise("ok")
    )
    staged = (
        formatted.withColumns(
            {"_part": _captures(value, fmt), "_doc": F.when(fmt == "json", json_document(value))}
        )
        .withColumn("_matched", matched)
        .withColumn("_apache_time", F.when((fmt == "apache") & F.col("_matched"), _apache_time(F.get(part, F.lit(1)))))
        .withColumn("_outcome", outcome)
    )
    # One row in, one row out. The generator keeps filters on the outcome from being
    # rewritten in terms of the raw line, which would match every pattern again.
    carried = F.struct(*(c for c in staged.columns if c != "_matched"))
    return staged.select(F.inline(F.array(carried)))


def _apart(column: Column) -> Column:
    """The same value through a higher-order function.

    Those are not part of whole-stage code. A projection that has one is generated as
    many small methods, which the JIT compiles; as one method, the whole record is too
    large for it and runs at half the speed.
    """
    return F.get(F.transform(F.array(column), lambda item: item), F.lit(0))


def parse_lines(
    formatted: DataFrame, ingest_ts: Column | str, default_year: int
) -> DataFrame:
    """Every non-blank line as a record plus ``_outcome``: ok, generic or dropped.

    ``ingest_ts`` stands in for times that are absent or unreadable; ``default_year``
    completes the year-less syslog time. Lines that fail their file's format are
    kept here as "dropped" so that they can be counted.
    """
    now = F.lit(ingest_ts).cast("timestamp_ntz")
    routed = route_lines(formatted).withColumn(
        "_route", F.when(F.col("_outcome") == "ok", F.col("_format")).otherwise(F.col("_outcome"))
    )
    value, doc, route = F.col("value"), F.col("_doc"), F.col("_route")
    apache, syslog, application, json = (
        route == name for name in ("apache", "syslog", "application", "json")
    )
    generic = route == "generic"

    def part(number: int) -> Column:
        return F.get(F.col("_part"), F.lit(number - 1))

    def field(name: str, kind: str = "string") -> Column:
        return F.try_variant_get(doc, f"$.{name}", kind)

    def present(name: str) -> Column:
        return F.try_variant_get(doc, f"$.{name}", "variant").isNotNull()

    def field_or(name: str, default: str) -> Column:
        return F.when(present(name), field(name)).otherwise(F.lit(default))

    status = part(6).try_cast("int")
    syslog_time = F.try_to_timestamp(
        F.concat(F.lit(f"{default_year} "), part(1)), F.lit("yyyy MMM d H:m:s")
    ).cast("timestamp_ntz")
    application_time = F.try_to_timestamp(part(1), F.lit("yyyy-MM-dd HH:mm:ss,SSS")).cast("timestamp_ntz")
    generic_level = F.upper(F.regexp_extract(value, fv.GENERIC_LEVEL, 1))

    records = routed.select(
        *(c for c in formatted.columns if c not in ("value", "_format")),
        "_outcome",
        F.when(apache, F.col("_apache_time"))
        .when(syslog, F.coalesce(syslog_time, now))
        .when(application, F.coalesce(application_time, now))
        .when(json, F.when(present("timestamp"), _json_time(field("timestamp"))).otherwise(now))
        .when(generic, F.coalesce(_generic_time(value), now))
        .alias("timestamp"),
        F.when(apache, F.when(status >= 500, "ERROR").when(status >= 400, "WARNING").otherwise("INFO"))
        .when(syslog, F.upper(part(5)))
        .when(application, F.upper(part(3)))
        .when(json, F.upper(field_or("level", fv.DEFAULT_LEVEL)))
        .when(generic, F.when(generic_level != "", generic_level).otherwise(fv.DEFAULT_LEVEL))
        .alias("level"),
        F.when(apache, F.concat_ws(" ", part(3), part(4), status.cast("string")))
        .when(syslog, part(6))
        .when(application, part(5))
        .when(json, field_or("message", ""))
        .when(generic, value)
        .alias("message"),
        F.when(syslog, part(3))
        .when(application, part(4))
        .when(json, field_or("service", fv.JSON_DEFAULT_NAME))
        .alias("service"),
        F.when(apache, part(1)).alias("ip"),
        F.when(apache, part(3)).alias("method"),
        F.when(apache, part(4)).alias("endpoint"),
        F.when(apache, part(5)).alias("protocol"),
        F.when(apache, status).when(json, field("status_code", "int")).alias("status_code"),
        F.when(apache, part(7).try_cast("bigint")).alias("response_size"),
        F.when(apache, part(8)).alias("referrer"),
        F.when(apache, part(9)).alias("user_agent"),
        F.when(syslog, part(2)).alias("hostname"),
        F.when(syslog, part(4).try_cast("int")).alias("pid"),
        F.when(json, field_or("host", fv.JSON_DEFAULT_NAME)).alias("host"),
        F.when(json, field("request_id")).alias("request_id"),
        F.when(json, field("duration_ms", "double")).alias("duration_ms"),
        F.when(json, field("error_trace")).alias("error_trace"),
        F.when(json, field("anomaly_hint", "boolean")).alias("anomaly_hint"),
        F.when(application, part(2)).alias("thread"),
        route.alias("_format"),
        _apart(value).alias("_raw"),
    )
    severity = F.when(F.col("_format") != "apache", parse_severity(F.col("level")))
    return records.withColumn("severity", severity)


def parse_logs(
    lines: DataFrame, ingest_ts: Column | str, default_year: int, mode: str = "file"
) -> DataFrame:
    """The whole parsing job: unified records (``RECORD_SCHEMA``), dropped lines left out."""
    return records_of(parse_lines(with_format(lines, mode), ingest_ts, default_year))


def records_of(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("_outcome") != "dropped").select(*RECORD_SCHEMA.fieldNames())


def parse_stats(lines: DataFrame, mode: str = "file") -> DataFrame:
    """Per file: non-blank lines, errors and success percentage; files of blanks count 0."""
    counts = route_lines(with_format(lines, mode)).groupBy("_file").agg(
        F.count("*").alias("total_lines"),
        F.count_if(F.col("_outcome") != "ok").alias("parse_errors"),
    )
    files = lines.select("_file").distinct()
    total, errors = F.coalesce("total_lines", F.lit(0)), F.coalesce("parse_errors", F.lit(0))
    return files.join(counts, "_file", "left").select(
        "_file",
        total.alias("total_lines"),
        errors.alias("parse_errors"),
        F.when(total > 0, (total - errors) / total * 100).otherwise(F.lit(0.0)).alias("success_rate"),
    )

