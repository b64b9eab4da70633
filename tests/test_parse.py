"""Line formats, fields, routing and edge cases of the parser."""

import datetime as dt

import pytest

from loglake.operators.parse import detect_format, parse_logs, parse_stats
from loglake.schema import LINE_SCHEMA, RECORD_SCHEMA

NOW = "2026-01-01 00:00:00"
APACHE = '10.44.0.7 - - [17/Nov/2025:21:04:56 +0000] "POST /cart/items?id=8 HTTP/2.0" 201 87 "https://shop.test/" "curl/8.9"'
SYSLOG = "Nov 17 21:04:56 edge-7 cache-sync[408]: [ERROR] replica 3 is 40 s behind"
JSON = '{"timestamp": "2025-11-17T21:04:56", "level": "ERROR", "service": "billing", "message": "card 12 refused"}'
APPLICATION = "2025-11-17 21:04:56,789 [worker-9] INFO     stock-sync - took in 31 parcels"
MALFORMED = "no known shape, only some words"
TIME = dt.datetime(2025, 11, 17, 21, 4, 56)


def frame(spark, *files):
    rows = [(f"f{i}", 0, n, line) for i, lines in enumerate(files) for n, line in enumerate(lines)]
    return spark.createDataFrame(rows, LINE_SCHEMA)


def parse(spark, *lines, mode="line"):
    out = parse_logs(frame(spark, lines), NOW, 2026, mode)
    assert out.schema.simpleString() == RECORD_SCHEMA.simpleString()
    return out.orderBy("_line_no").collect()


@pytest.mark.parametrize(
    "line, expected",
    [(APACHE, "apache"), (SYSLOG, "syslog"), (JSON, "json"), (APPLICATION, "application"), (MALFORMED, "unknown"),
     ('{"a": 1} trailing', "unknown"), ('{"a": 1}] }', "unknown"), ("Nov  7 21:04:56 h s[1]: [INFO] two blanks", "unknown")],
)
def test_format(spark, line, expected):
    assert detect_format(frame(spark, [line])).first()._format == expected


def test_fields(spark):
    apache, syslog, json, application = parse(spark, APACHE, SYSLOG, JSON, APPLICATION)
    assert (apache.ip, apache.method, apache.endpoint, apache.status_code, apache.response_size) == (
        "10.44.0.7", "POST", "/cart/items?id=8", 201, 87)
    assert (apache.message, apache.level, apache.severity, apache.timestamp) == ("POST /cart/items?id=8 201", "INFO", None, TIME)
    assert (syslog.level, syslog.service, syslog.hostname, syslog.pid, syslog.severity) == (
        "ERROR", "cache-sync", "edge-7", 408, 3)
    assert syslog.timestamp == TIME.replace(year=2026)
    assert (json.level, json.message, json.service, json.host) == ("ERROR", "card 12 refused", "billing", "unknown")
    assert (application.thread, application.level, application.message) == (
        "worker-9", "INFO", "took in 31 parcels")
    assert application.timestamp == TIME.replace(microsecond=789000)


def test_blank_lines_give_no_row(spark):
    assert parse(spark, "", "   ", "\t  ") == []


def test_malformed_line_is_generic(spark):
    (row,) = parse(spark, MALFORMED)
    assert (row._format, row.message, row.level) == ("generic", MALFORMED, "INFO")
    assert row.timestamp == dt.datetime(2026, 1, 1)


def test_generic_time_and_level(spark):
    blank, iso, bracket, broken = parse(
        spark, "x 2025-11-17 21:04:56 warn y", "x 2025-11-17T21:04:56 fatal", "at 17/Nov/2025:21:04:56 Warning",
        "2025-99-17T21:04:56 17/Nov/2025:21:04:56 z")
    assert (blank.timestamp, blank.level, blank.severity) == (TIME, "WARN", 2)
    assert (iso.timestamp, iso.level, iso.severity) == (TIME, "FATAL", 4)
    assert (bracket.timestamp, bracket.level) == (TIME, "WARNING")
    assert broken.timestamp == dt.datetime(2026, 1, 1)


def test_apache_offset_and_levels(spark):
    shifted = APACHE.replace("+0000", "+0200").replace(" 201 ", " 404 ")
    colon, broken = APACHE.replace("+0000", "+02:00"), APACHE.replace("17/Nov", "99/Nov")
    server = APACHE.replace(" 201 ", " 503 ").replace(" +0000", "")
    rows = parse(spark, shifted, colon, broken, server)
    assert rows[0].timestamp == rows[1].timestamp == TIME - dt.timedelta(hours=2)
    assert (rows[0].level, rows[3].level, rows[3].timestamp) == ("WARNING", "ERROR", TIME)
    assert rows[2]._format == "generic" and rows[2].message == broken


def test_json_defaults_and_nulls(spark):
    empty, null_level, number_level, null_message, extra, bad_time = parse(
        spark, "{}", '{"level": null}', '{"level": 3}', '{"message": null, "level": "warn"}',
        '{"duration_ms": 12.5, "status_code": 503, "request_id": "r1", "anomaly_hint": true, "other": 1}',
        '{"timestamp": "soon"}')
    assert (empty.level, empty.service, empty.host, empty.message) == ("INFO", "unknown", "unknown", "")
    assert empty.timestamp == dt.datetime(2026, 1, 1)
    assert null_level._format == number_level._format == "generic"
    assert (null_message._format, null_message.message, null_message.level) == ("json", None, "WARN")
    assert (extra.duration_ms, extra.status_code, extra.request_id, extra.anomaly_hint) == (12.5, 503, "r1", True)
    assert bad_time.timestamp is None


def test_syslog_29_february(spark):
    (row,) = parse_logs(frame(spark, [SYSLOG.replace("Nov 17", "Feb 29")]), NOW, 2025, "line").collect()
    assert row._format == "syslog" and row.timestamp == dt.datetime(2026, 1, 1)


def test_line_with_the_group_mark(spark):
    (row,) = parse(spark, SYSLOG + " a\x01b")
    assert (row.message, row.service) == ("replica 3 is 40 s behind a\x01b", "cache-sync")


def test_message_keeps_foreign_line_separators(spark):
    (row,) = parse(spark, SYSLOG + " a b\u0085c")
    assert row.message == "replica 3 is 40 s behind a b\u0085c"


def test_file_mode_forces_the_first_format(spark):
    lines = frame(spark, ["", APACHE, SYSLOG, APACHE], [MALFORMED, APACHE], ["  "])
    rows = parse_logs(lines, NOW, 2026, "file").collect()
    assert sorted((r._file, r._format) for r in rows) == [
        ("f0", "apache"), ("f0", "apache"), ("f1", "generic"), ("f1", "generic")]
    stats = {r._file: (r.total_lines, r.parse_errors, r.success_rate) for r in parse_stats(lines).collect()}
    assert stats["f0"][:2] == (3, 1) and stats["f1"] == (2, 2, 0.0) and stats["f2"] == (0, 0, 0.0)


def test_stats(spark):
    stats = parse_stats(frame(spark, ['{"timestamp": "2025-11-17", "level": "DEBUG", "message": "fine"}', "neither this nor that"]), "line")
    row = stats.first()
    assert (row.total_lines, row.parse_errors, row.success_rate) == (2, 1, 50.0)


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        parse_logs(frame(spark, [APACHE]), NOW, 2026, "whole")
