"""Registered queries: aggregates, features and time windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from loglake import fixed_values as fv
from loglake.functions import columns as c
from loglake.operators import aggregate as agg
from loglake.operators import features as feat
from loglake.operators.anomaly import sanitize, scaling, standardize
from loglake.operators.categories import CategoryDictionary, fit_categories
from loglake.operators.enrich import enrich_logs
from loglake.registry import sql_views as v
from loglake.session import scratch_path
from loglake.sources import test_tables as t


def _enriched(spark, sf_dir):
    return enrich_logs(t.logs(spark, sf_dir))


def _on_logs(operator, *args):
    return lambda spark, sf_dir: operator(_enriched(spark, sf_dir), *args)


def _rounded(df, *names, digits=9):
    return df.withColumns({n: F.round(F.col(n), digits) for n in names if n in df.columns})


def _features(spark, sf_dir, *names):
    names = names or fv.NUMERIC_FEATURES
    rows = feat.record_features(_enriched(spark, sf_dir), keep=["row_id"]).select("row_id", *names)
    return _rounded(rows, "hour_sin", "hour_cos", "uppercase_ratio", "response_size_log", "duration_log")


def _feature_query(*names):
    return lambda spark, sf_dir: _features(spark, sf_dir, *names)


def _feature_sql(*names):
    return v.with_views(f"select row_id, {', '.join(names)} from features", "features")


def gap_features(*names):
    """The same features where values are missing."""

    def query(spark, sf_dir):
        rows = feat.record_features(t.gaps(spark, sf_dir), keep=["row_id"])
        return _rounded(rows.select("row_id", *names), "response_size_log", "duration_log")

    return query


def one_hot(column):
    def query(spark, sf_dir):
        rows = _enriched(spark, sf_dir)
        return rows.select("row_id", *(x.alias(n) for n, x in feat.one_hot(rows, column).items()))

    return query


def one_hot_sql(column, values):
    cells = ", ".join(f"""{column} = '{x}' as "{column}_{x}" """ for x in values)
    return v.with_views(f"select row_id, {cells} from enriched", "enriched")


def human_sizes(spark, sf_dir):
    """Character counts raised to byte, kilobyte, ... scale by the row number."""
    docs = t.table(spark, sf_dir, "documents")
    size = F.col("n_chars") * F.pow(F.lit(1024.0), F.col("doc_id") % 6)
    return docs.select("doc_id", size.alias("size_bytes"), c.human_size(size).alias("size_human"))


def sanitized(spark, sf_dir):
    """Ratios that are infinite or undefined for some rows."""
    ratio = F.when(F.col("row_id") % 5 == 0, F.col("response_size").cast("double") / F.lit(0.5))
    broken = F.when(F.col("row_id") % 3 == 0, F.lit(float("inf"))).when(
        F.col("row_id") % 3 == 1, F.lit(float("nan"))
    ).otherwise(F.col("duration_ms").cast("double"))
    rows = t.logs(spark, sf_dir).select("row_id", ratio.alias("ratio"), broken.alias("broken"))
    return sanitize(rows, ["ratio", "broken"])


SCALED = ("severity", "message_length", "response_size", "duration_ms", "status_code")


def standardized(spark, sf_dir):
    rows = feat.record_features(_enriched(spark, sf_dir), keep=["row_id"]).select("row_id", *SCALED)
    return _rounded(standardize(rows, SCALED, scaling(rows, SCALED)[1]), *SCALED, digits=6)


def aligned(spark, sf_dir):
    rows = t.logs(spark, sf_dir).select("row_id", "duration_ms", "response_size")
    return feat.align_features(rows, ["response_size", "status_code", "duration_ms"], ["row_id"])


def attached(spark, sf_dir):
    """Scores carried along with their record: no join."""
    score = (F.col("duration_ms").cast("double") - 200) / 1000
    rows = t.logs(spark, sf_dir).withColumn("anomaly_score", score)
    severity = c.anomaly_severity(F.col("anomaly_score"))
    return rows.select(
        "row_id", "timestamp", "message", F.round("anomaly_score", 6).alias("anomaly_score"), severity.alias("anomaly_severity")
    )


def metric_classes(spark, sf_dir):
    """Error rate and its colour class per service."""
    rates = agg.error_rate(_enriched(spark, sf_dir), "service", "hour")
    return rates.select("service", "hour", "error_rate", c.rate_class(F.col("error_rate")).alias("class"))


WINDOW_ROUNDED = (
    "error_rate", "avg_message_length", "message_diversity", "avg_status", "avg_response_size", "avg_duration",
    "p95_duration", "avg_severity",
)


def windows(spark, sf_dir):
    return _rounded(feat.window_features(_enriched(spark, sf_dir)), *WINDOW_ROUNDED, digits=6)


def onehot_dictionary(spark, sf_dir):
    """Messages, with a dictionary fitted on every second record, saved and read back: the rest has strange ones."""
    rows = _enriched(spark, sf_dir)
    path = scratch_path(spark, "dictionary")
    fit_categories(rows.where(F.col("row_id") % 2 == 0), "message").save(path)
    dictionary = CategoryDictionary.load(spark, path)
    vectors = feat.record_features(rows, keep=["row_id"], dictionaries={"message": dictionary})
    vector = F.col("message_vector")
    return vectors.select("row_id", vector["size"].alias("width"), F.get(vector["indices"], F.lit(0)).alias("place"))


QUERIES = {
    "level_distribution": _on_logs(agg.value_counts, "level"),
    "hourly_distribution": _on_logs(agg.counts_in_order, "hour"),
    "daily_counts": _on_logs(agg.counts_in_order, "date"),
    "error_rate": _on_logs(agg.error_rate),
    "top_endpoints": _on_logs(agg.top_counts, "endpoint"),
    "top_ips": _on_logs(agg.top_counts, "ip"),
    "service_counts": _on_logs(agg.value_counts, "service"),
    "status_distribution": _on_logs(agg.value_counts, "status_code"),
    "response_size_stats": _on_logs(agg.response_size_stats),
    "duration_stats": _on_logs(agg.duration_stats),
    "time_bucket_distribution": _on_logs(agg.time_bucket_distribution),
    "aggregate_all": _on_logs(agg.aggregate_all),
    "hour_weekday_matrix": _on_logs(agg.hour_weekday_matrix),
    "score_histogram": _on_logs(agg.histogram, "duration_ms"),
    "feature_summary": lambda s, d: feat.feature_summary(feat.record_features(_enriched(s, d))),
    "feat_time": _feature_query("hour", "day_of_week", "is_weekend", "is_night", "minute_of_day"),
    "feat_cyclic": _feature_query("hour_sin", "hour_cos"),
    "feat_message": _feature_query("message_length", "word_count"),
    "feat_keywords": _feature_query("has_error_keyword", "has_number"),
    "feat_chars": _feature_query("uppercase_ratio", "special_char_count"),
    "feat_status": gap_features("status_code", "is_error_status", "is_server_error"),
    "feat_size": gap_features("response_size", "response_size_log"),
    "feat_duration": gap_features("duration_ms", "duration_log", "is_slow"),
    "onehot_dictionary": onehot_dictionary,
    "onehot_service": one_hot("service"),
    "onehot_method": one_hot("method"),
    "record_features": _feature_query(),
    "window_features": windows,
    "human_size": human_sizes,
    "sanitize_features": sanitized,
    "standardize": standardized,
    "align_features": aligned,
    "attach_scores": attached,
    "anomaly_severity": lambda s, d: attached(s, d).select("row_id", "anomaly_severity"),
    "metric_class": metric_classes,
}


def _counts(column, tail=""):
    return v.with_views(
        f"select {column}, count(*) as records from enriched where {column} is not null group by {column} {tail}",
        "enriched",
    )


def _error_rate(keys=""):
    return f"""select {keys} count(*) as total_records, count(*) filter (where level in ('ERROR', 'CRITICAL')) as error_count,
      round(count(*) filter (where level in ('ERROR', 'CRITICAL')) / count(*) * 100, 2) as error_rate from enriched"""


_SECTIONS_SQL = " union all ".join(
    f"select '{section}' as section, cast({column} as string) as key, count(*) as records from enriched "
    f"where {column} is not null group by {column}"
    for section, column in agg.SECTIONS.items()
) + " union all select 'total_records', null, count(*) from enriched"

_SUMMARY_SQL = " union all ".join(
    f"""select '{n}' as feature, round(avg({n}), 4) as mean, round(stddev_samp({n}), 4) as std,
        cast(round(min({n}), 4) as double) as min, cast(round(max({n}), 4) as double) as max,
        round(avg(cast({n} <> 0 as int)) * 100, 2) as non_zero_pct from raw_features"""
    for n in fv.NUMERIC_FEATURES
)

ATTACHED_SQL = """select row_id, timestamp, message, round((duration_ms - 200) / 1000, 6) as anomaly_score,
  case when (duration_ms - 200) / 1000 <= -0.3 then 'critical' when (duration_ms - 200) / 1000 <= -0.1 then 'high'
    when (duration_ms - 200) / 1000 <= 0 then 'medium' else 'normal' end as anomaly_severity from logs"""

_UNIT = "pow(1024.0::double, doc_id % 6)"


def _human(size: str) -> str:
    whens = " ".join(
        f"when {size} < {1024 ** (p + 1)} then printf('%.1f {u}', {size} / {1024.0**p})"
        for p, u in enumerate(fv.SIZE_UNITS)
    )
    return f"case {whens} else printf('%.1f PB', {size} / {1024.0**5}) end"


ORACLES = {
    "level_distribution": _counts("level"),
    "hourly_distribution": _counts("hour"),
    "daily_counts": _counts("date"),
    "error_rate": v.with_views(_error_rate(), "enriched"),
    "top_endpoints": _counts("endpoint", "order by records desc, endpoint limit 10"),
    "top_ips": _counts("ip", "order by records desc, ip limit 10"),
    "service_counts": _counts("service"),
    "status_distribution": _counts("status_code"),
    "response_size_stats": v.with_views(
        """select round(avg(response_size), 2) as mean, round(quantile_cont(response_size, 0.5), 2) as median,
             max(response_size) as max, cast(sum(response_size) as bigint) as total from enriched""",
        "enriched",
    ),
    "duration_stats": v.with_views(
        """select round(avg(duration_ms), 2) as mean, round(quantile_cont(duration_ms, 0.5), 2) as p50,
             round(quantile_cont(duration_ms, 0.95), 2) as p95, round(quantile_cont(duration_ms, 0.99), 2) as p99,
             cast(max(duration_ms) as double) as max from enriched""",
        "enriched",
    ),
    "time_bucket_distribution": v.with_views(
        """select b.time_bucket, count(e.row_id) as records
           from (values ('night'), ('morning'), ('afternoon'), ('evening')) b(time_bucket)
           left join enriched e on e.time_bucket = b.time_bucket group by b.time_bucket""",
        "enriched",
    ),
    "aggregate_all": v.with_views(_SECTIONS_SQL, "enriched"),
    "hour_weekday_matrix": v.with_views(
        "select day_of_week, "
        + ", ".join(f"count(*) filter (where hour = {h}) as h{h}" for h in range(24))
        + " from enriched group by day_of_week",
        "enriched",
    ),
    "score_histogram": v.with_views(
        """select cast(case when lo < hi then least(floor((duration_ms - lo) / ((hi - lo) / 50)) + 1, 50) else 1 end as int) as bin,
             count(*) as records
           from enriched, (select min(duration_ms) as lo, max(duration_ms) as hi from enriched)
           group by 1""",
        "enriched",
    ),
    "feature_summary": v.with_views(_SUMMARY_SQL, "raw_features"),
    "feat_time": _feature_sql("hour", "day_of_week", "is_weekend", "is_night", "minute_of_day"),
    "feat_cyclic": _feature_sql("hour_sin", "hour_cos"),
    "feat_message": _feature_sql("message_length", "word_count"),
    "feat_keywords": _feature_sql("has_error_keyword", "has_number"),
    "feat_chars": _feature_sql("uppercase_ratio", "special_char_count"),
    "feat_status": v.with_views(
        """select row_id, coalesce(status_code, 200) as status_code, cast(coalesce(status_code >= 400, false) as int) as is_error_status,
             cast(coalesce(status_code >= 500, false) as int) as is_server_error from gaps""",
        "gaps",
    ),
    "feat_size": v.with_views(
        """select row_id, coalesce(response_size, 0) as response_size,
             round(ln(1 + coalesce(response_size, 0)), 9) as response_size_log from gaps""",
        "gaps",
    ),
    "feat_duration": v.with_views(
        """select row_id, coalesce(duration_ms, 0) as duration_ms, round(ln(1 + coalesce(duration_ms, 0)), 9) as duration_log,
             cast(coalesce(duration_ms > 1000, false) as int) as is_slow from gaps""",
        "gaps",
    ),
    "onehot_dictionary": v.with_views(
        """select row_id, (select count(*) + 1 from (select distinct message from logs where row_id % 2 = 0)) as width,
             coalesce(place, (select count(*) from (select distinct message from logs where row_id % 2 = 0))) as place
           from logs left join (select message as value, row_number() over (order by message) - 1 as place
             from (select distinct message from logs where row_id % 2 = 0)) on message = value""",
        "logs",
    ),
    "onehot_service": one_hot_sql("service", [f"svc-{i}" for i in range(8)]),
    "onehot_method": one_hot_sql("method", ["DELETE", "GET", "POST", "PUT"]),
    "record_features": _feature_sql(*fv.NUMERIC_FEATURES),
    "window_features": v.with_views(
        """select time_bucket(interval 1 hour, timestamp) as window_start, count(*) as log_count,
             count(*) filter (where level = 'DEBUG') as count_debug, count(*) filter (where level = 'INFO') as count_info,
             count(*) filter (where level = 'WARNING') as count_warning, count(*) filter (where level = 'ERROR') as count_error,
             count(*) filter (where level = 'CRITICAL') as count_critical,
             round(count(*) filter (where level in ('ERROR', 'CRITICAL')) / count(*), 6) as error_rate,
             round(avg(length(message)), 6) as avg_message_length, cast(max(length(message)) as int) as max_message_length,
             count(distinct message) as unique_messages, round(count(distinct message) / count(*), 6) as message_diversity,
             count(distinct ip) as unique_ips, count(distinct service) as unique_services,
             round(avg(status_code), 6) as avg_status, count(*) filter (where status_code >= 400) as error_status_count,
             count(*) filter (where status_code >= 500) as server_error_count,
             round(avg(response_size), 6) as avg_response_size, cast(sum(response_size) as bigint) as total_response_size,
             round(avg(duration_ms), 6) as avg_duration, max(duration_ms) as max_duration,
             round(quantile_cont(duration_ms, 0.95), 6) as p95_duration,
             round(avg(severity_num), 6) as avg_severity, max(severity_num) as max_severity
           from enriched group by 1""",
        "enriched",
    ),
    "human_size": f"select doc_id, n_chars * {_UNIT} as size_bytes, {_human(f'(n_chars * {_UNIT})')} as size_human from documents",
    "sanitize_features": v.with_views(
        """select row_id, cast(case when row_id % 5 = 0 then response_size * 2 else 0 end as double) as ratio,
             cast(case when row_id % 3 = 2 then duration_ms else 0 end as double) as broken from logs""",
        "logs",
    ),
    "standardize": v.with_views(
        "select row_id, "
        + ", ".join(
            f"round(({n} - (select avg({n}) from features)) / (select stddev_pop({n}) from features), 6) as {n}" for n in SCALED
        )
        + " from features",
        "features",
    ),
    "align_features": v.with_views(
        """select row_id, cast(response_size as double) as response_size, cast(0 as double) as status_code,
             cast(duration_ms as double) as duration_ms from logs""",
        "logs",
    ),
    "attach_scores": v.with_views(ATTACHED_SQL, "logs"),
    "anomaly_severity": v.with_views(f"select row_id, anomaly_severity from ({ATTACHED_SQL})", "logs"),
    "metric_class": v.with_views(
        f"""select service, hour, error_rate, case when error_rate > 10 then 'danger' when error_rate > 5 then 'warning'
              else 'normal' end as class from ({_error_rate('service, hour,')} group by service, hour)""",
        "enriched",
    ),
}
