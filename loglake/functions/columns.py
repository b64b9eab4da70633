"""Scalar column expressions: levels, time parts, bins, sizes. All run in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loglake import fixed_values as fv


def strip(text: Column) -> Column:
    """Remove white space of every kind from both ends.

    Most lines start and end with a printable ASCII character and are passed on as is.
    """
    first, last = F.substring(text, 1, 1), F.substring(text, -1, 1)
    plain = first.between("!", "~") & last.between("!", "~")
    return F.when(plain, text).otherwise(F.btrim(text, F.lit(fv.WHITESPACE)))


def lookup(key: Column, table: dict, default: Column) -> Column:
    """Value of ``key`` in a small fixed table."""
    chain = F
    for name, value in table.items():
        chain = chain.when(key == name, F.lit(value))
    return chain.otherwise(default)


def parse_severity(level: Column) -> Column:
    return lookup(level, fv.PARSE_SEVERITY, F.lit(fv.DEFAULT_SEVERITY))


def severity_num(level: Column) -> Column:
    return lookup(level, fv.LEVEL_SEVERITY, F.lit(fv.DEFAULT_SEVERITY))


def normalize_level(level: Column) -> Column:
    upper = F.upper(level)
    return lookup(upper, fv.LEVEL_ALIASES, upper)


def is_error(level: Column) -> Column:
    return level.isin(*fv.ERROR_LEVELS)


def date_text(timestamp: Column) -> Column:
    return F.date_format(timestamp, "yyyy-MM-dd")


def is_business_hours(hour: Column) -> Column:
    return hour.between(9, 17)


def time_bucket(hour: Column) -> Column:
    night, morning, afternoon, evening = fv.TIME_BUCKETS
    return (
        F.when(hour <= 6, night)
        .when(hour <= 12, morning)
        .when(hour <= 18, afternoon)
        .when(hour <= 24, evening)
    )


def status_category(status: Column) -> Column:
    """Bins (0,199] (199,299] (299,399] (399,499] (499,599]; anything else is null."""
    chain = F.when((status <= 0) | (status > 599), F.lit(None).cast("string"))
    for upper, label in zip((199, 299, 399, 499, 599), fv.STATUS_CATEGORIES):
        chain = chain.when(status <= upper, label)
    return chain


def anomaly_severity(score: Column) -> Column:
    critical, high, medium, normal = fv.ANOMALY_SEVERITIES
    return (
        F.when(score <= -0.3, critical)
        .when(score <= -0.1, high)
        .when(score <= 0, medium)
        .when(score > 0, normal)
    )


def human_size(size: Column) -> Column:
    """Bytes as text with one decimal (ties to even), in powers of 1024 up to PB."""
    size = size.cast("double")

    def shown(power: int, unit: str) -> Column:
        return F.format_string(f"%.1f {unit}", F.bround(size / F.lit(1024.0**power), 1))

    chain = F
    for power, unit in enumerate(fv.SIZE_UNITS):
        chain = chain.when(size < 1024.0 ** (power + 1), shown(power, unit))
    return chain.otherwise(shown(5, "PB"))


def rate_class(rate: Column) -> Column:
    """Card colour of a percentage: above 10 danger, above 5 warning, else normal."""
    return F.when(rate > 10, "danger").when(rate > 5, "warning").otherwise("normal")


def status_class(status: Column) -> Column:
    """Bar colour of an HTTP status."""
    return (
        F.when(status < 300, "success")
        .when(status < 400, "redirect")
        .when(status < 500, "client_error")
        .otherwise("server_error")
    )


def coerce_timestamp(text: Column) -> Column:
    """ISO text to a UTC timestamp without zone; unreadable text becomes null."""
    return F.try_to_timestamp(text).cast("timestamp_ntz")


def finite(value: Column) -> Column:
    """Infinite, NaN and null become 0."""
    value = value.cast("double")
    bad = value.isNull() | F.isnan(value) | (F.abs(value) == F.lit(float("inf")))
    return F.when(bad, F.lit(0.0)).otherwise(value)


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """``part`` of ``whole`` in percent, rounded; 0 when there is nothing."""
    ratio = F.when(whole > 0, part / whole * 100).otherwise(F.lit(0.0))
    return F.round(ratio, digits)
