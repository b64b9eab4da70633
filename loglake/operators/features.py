"""Numeric features per record and per time window."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglake import fixed_values as fv
from loglake.functions.columns import finite, severity_num
from loglake.operators.categories import CategoryDictionary, with_vector
from loglake.operators.percentiles import exact_percentiles

_NOT_SPACE = f"[^{fv.WHITESPACE_CLASS}]+"


def flag(condition: Column) -> Column:
    """1 when true, 0 when false or unknown."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def word_count(message: Column) -> Column:
    return F.regexp_count(message, F.lit(_NOT_SPACE))


def time_features() -> dict[str, Column]:
    ts = F.col("timestamp")
    hour, weekday = F.hour(ts), F.weekday(ts)
    angle = hour * (F.pi() * 2) / 24
    return {
        "hour": hour,
        "day_of_week": weekday,
        "is_weekend": flag(weekday >= 5),
        "is_night": flag((hour < 6) | (hour > 22)),
        "minute_of_day": hour * 60 + F.minute(ts),
        "hour_sin": F.sin(angle),
        "hour_cos": F.cos(angle),
    }


def message_features() -> dict[str, Column]:
    message = F.col("message")
    # a missing message reads as the text "None" for the character ratio, as 0 elsewhere
    upper = F.length(message) - F.length(F.regexp_replace(message, r"\p{Lu}", ""))
    ratio = upper / F.greatest(F.length(message), F.lit(1))
    return {
        "message_length": F.length(message),
        "word_count": word_count(message),
        "has_error_keyword": flag(message.rlike(fv.ERROR_KEYWORD_PATTERN)),
        "has_number": flag(message.rlike(r"\p{Nd}")),
        "uppercase_ratio": F.when(message.isNull(), F.lit(0.25)).otherwise(ratio),
        "special_char_count": F.regexp_count(message, F.lit(fv.SPECIAL_CHARACTERS)),
    }


def network_features() -> dict[str, Column]:
    status, size = F.col("status_code"), F.col("response_size")
    return {
        "status_code": F.coalesce(status, F.lit(200)),
        "is_error_status": flag(status >= 400),
        "is_server_error": flag(status >= 500),
        "response_size": F.coalesce(size, F.lit(0)),
        "response_size_log": F.log1p(F.coalesce(size, F.lit(0))),
    }


def duration_features() -> dict[str, Column]:
    duration = F.col("duration_ms")
    return {
        "duration_ms": F.coalesce(duration, F.lit(0)),
        "duration_log": F.log1p(F.coalesce(duration, F.lit(0))),
        "is_slow": flag(duration > 1000),
    }


def severity_feature(df: DataFrame) -> Column:
    if "severity_num" in df.columns:
        return F.col("severity_num")
    return severity_num(F.col("level"))


def numeric_features(df: DataFrame) -> dict[str, Column]:
    """The 22 numeric features as expressions; remaining nulls become 0.

    A feature whose source column is absent is left out.
    """
    groups = (
        ("timestamp", time_features),
        ("message", message_features),
        ("status_code", network_features),
        ("duration_ms", duration_features),
    )
    features: dict[str, Column] = {}
    if "severity_num" in df.columns or "level" in df.columns:
        features["severity"] = severity_feature(df)
    for source, build in groups:
        if source in df.columns:
            features.update(build())
    if "response_size" not in df.columns:
        features = {k: v for k, v in features.items() if not k.startswith("response_size")}
    return {name: F.coalesce(column, F.lit(0)) for name, column in features.items()}


#: Columns that one-hot encoding makes of one column at most.
MOST_COLUMNS = 1000


def categories(df: DataFrame, column: str, most: int = MOST_COLUMNS) -> list[str]:
    """Sorted distinct values of a column that is about to become one column each.

    More than ``most`` of them are an error, and no more than that are fetched: such columns are
    encoded by a dictionary (``categories.fit_categories``) as sparse vectors.
    """
    rows = df.select(column).na.drop().distinct().limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"{column} has more than {most} values: encode it by a dictionary")
    return sorted(row[0] for row in rows)


def one_hot(df: DataFrame, column: str, values: Sequence[str] | None = None) -> dict[str, Column]:
    """One boolean expression per value, named ``<column>_<value>``."""
    values = categories(df, column) if values is None else values
    return {f"{column}_{v}": F.coalesce(F.col(column) == v, F.lit(False)) for v in values}


def record_features(
    df: DataFrame,
    keep: Sequence[str] = (),
    encode: Sequence[str] = (),
    dictionaries: Mapping[str, CategoryDictionary] | None = None,
) -> DataFrame:
    """The whole per-record feature job: one projection, no shuffle.

    ``keep`` passes columns through (a row id); ``encode`` adds one-hot columns. Columns of
    any number of values are encoded by their fitted ``dictionaries``, each as one sparse
    vector ``<column>_vector``.
    """
    features = numeric_features(df)
    for column in encode:
        if column in df.columns:
            features.update(one_hot(df, column))
    wide = {c: d for c, d in (dictionaries or {}).items() if c in df.columns}
    for column, dictionary in wide.items():
        df = with_vector(df, column, dictionary)
    return df.select(*keep, *(c.alias(name) for name, c in features.items()), *(f"{c}_vector" for c in wide))


def align_features(df: DataFrame, names: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Exactly the trained columns in the trained order, missing ones 0, all finite."""
    aligned = [finite(F.col(n) if n in df.columns else F.lit(0)).alias(n) for n in names]
    return df.select(*keep, *aligned)


def feature_summary(features: DataFrame, names: Sequence[str] = fv.NUMERIC_FEATURES) -> DataFrame:
    """Mean, sample deviation, range and share of non-zero values of every feature.

    All features are aggregated side by side in one pass; only the single result row
    is turned into one row per feature.
    """
    names = [n for n in names if n in features.columns]
    stats = []
    for name in names:
        v = F.col(name).cast("double")
        stats += [
            F.struct(
                F.lit(name).alias("feature"),
                F.round(F.avg(v), 4).alias("mean"),
                F.round(F.stddev_samp(v), 4).alias("std"),
                F.round(F.min(v), 4).alias("min"),
                F.round(F.max(v), 4).alias("max"),
                F.round(F.avg((v != 0).cast("double")) * 100, 2).alias("non_zero_pct"),
            ).alias(name)
        ]
    return features.agg(*stats).select(F.inline(F.array(*names)))


def window_stats(columns: Sequence[str], distinct: Callable[[str], Column] = F.countDistinct) -> dict[str, Column]:
    """The statistics of a time window that the given columns allow, all but the percentile."""
    has = set(columns).__contains__
    total = F.count("*")
    stats: dict[str, Column] = {"log_count": total}
    if has("level"):
        for level in fv.LEVELS:
            stats[f"count_{level.lower()}"] = F.count_if(F.col("level") == level)
        stats["error_rate"] = F.count_if(F.col("level").isin(*fv.ERROR_LEVELS)) / total
    if has("message"):
        length = F.length("message")
        stats |= {
            "avg_message_length": F.avg(length),
            "max_message_length": F.max(length),
            "unique_messages": distinct("message"),
            "message_diversity": distinct("message") / total,
        }
    if has("ip"):
        stats["unique_ips"] = distinct("ip")
    if has("service"):
        stats["unique_services"] = distinct("service")
    if has("status_code"):
        stats |= {
            "avg_status": F.avg("status_code"),
            "error_status_count": F.count_if(F.col("status_code") >= 400),
            "server_error_count": F.count_if(F.col("status_code") >= 500),
        }
    if has("response_size"):
        stats |= {"avg_response_size": F.avg("response_size"), "total_response_size": F.sum("response_size")}
    if has("duration_ms"):
        stats |= {"avg_duration": F.avg("duration_ms"), "max_duration": F.max("duration_ms")}
    if has("severity_num"):
        stats |= {"avg_severity": F.avg("severity_num"), "max_severity": F.max("severity_num")}
    return stats


def window_features(df: DataFrame, minutes: int = 60, approximate_distinct: bool = False) -> DataFrame:
    """One row of statistics per non-empty time window, nulls as 0.

    Distinct counts and the 95th percentile are exact. ``approximate_distinct`` replaces
    the former by sketches, which saves the expansion of every row per counted column.
    """
    if "timestamp" not in df.columns:
        raise ValueError("window features need a timestamp column")
    start = F.window("timestamp", f"{minutes} minutes").start.alias("window_start")
    rows = df.where(F.col("timestamp").isNotNull()).withColumn("window_start", start)
    stats = window_stats(df.columns, F.approx_count_distinct if approximate_distinct else F.countDistinct)
    windows = rows.groupBy("window_start").agg(*(c.alias(n) for n, c in stats.items()))
    if "duration_ms" in df.columns:
        p95 = exact_percentiles(rows, ["window_start"], "duration_ms", {"p95_duration": 0.95})
        windows = windows.join(p95, "window_start", "left")
    names = [c for c in windows.columns if c != "window_start"]
    return windows.select("window_start", *(F.coalesce(n, F.lit(0)).alias(n) for n in names))


def extract_features(df: DataFrame, mode: str = "record", **options) -> DataFrame:
    if mode == "record":
        return record_features(df, **options)
    if mode == "window":
        return window_features(df, **options)
    raise ValueError(f"unknown mode {mode!r}: use 'record' or 'window'")
