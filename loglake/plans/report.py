"""Report tables: headline numbers, chart series and the assembled document."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loglake.functions.columns import is_error, percent, rate_class, status_class
from loglake.operators import aggregate, anomaly


def headline_metrics(labelled: DataFrame, patterns: Column | int = 0) -> DataFrame:
    """One row: records, error and anomaly counts, rates and colours, pattern count."""
    n = F.count("*")
    errors, odd = F.count_if(is_error(F.col("level"))), F.count_if(F.col("is_anomaly") == 1)
    metrics = labelled.agg(
        n.alias("total_records"),
        errors.alias("error_count"),
        percent(errors, n).alias("error_rate"),
        odd.alias("anomaly_count"),
        percent(odd, n).alias("anomaly_rate"),
    )
    return metrics.withColumns(
        {
            "error_class": rate_class(F.col("error_rate")),
            "anomaly_class": rate_class(F.col("anomaly_rate")),
            "pattern_count": F.lit(patterns),
        }
    )


CHARTS = {
    "level_distribution": "levels",
    "hourly_distribution": "hours",
    "daily_counts": "days",
    "status_distribution": "statuses",
}


def chart_series(labelled: DataFrame) -> DataFrame:
    """(chart, x, y, class) for the level, hour, day, status and anomaly charts.

    The four counts come from one scan, the anomaly severities from a second.
    """
    counts = aggregate.aggregate_all(labelled).where(F.col("section").isin(*CHARTS))
    colour = F.when(F.col("section") == "status_distribution", status_class(F.col("key").try_cast("int")))
    bars = counts.select(
        aggregate_chart(F.col("section")).alias("chart"), F.col("key").alias("x"), F.col("records").alias("y"),
        colour.alias("class"),
    )
    severities = anomaly.severity_distribution(labelled).where(F.col("records") > 0)
    return bars.unionByName(
        severities.select(
            F.lit("anomaly_severity").alias("chart"), F.col("severity").alias("x"), F.col("records").alias("y"),
            F.col("severity").alias("class"),
        )
    )


def aggregate_chart(section: Column) -> Column:
    return reduce(lambda chain, kv: chain.when(section == kv[0], kv[1]), CHARTS.items(), F)


METRICS = ("total_records", "error_count", "error_rate", "anomaly_count", "anomaly_rate")
TOP_SECTIONS = ("top_endpoints", "top_ips")


def top_of_sections(counts: DataFrame, k: int = 10) -> DataFrame:
    """Counts of ``aggregate_all`` with the top-k sections cut to their k largest entries."""
    place = F.row_number().over(Window.partitionBy("section").orderBy(F.desc("records"), "key"))
    top = counts.where(F.col("section").isin(*TOP_SECTIONS)).withColumn("place", place)
    whole = counts.where(~F.col("section").isin(*TOP_SECTIONS))
    return whole.unionByName(top.where(F.col("place") <= k).drop("place"))


def report_sections(labelled: DataFrame, severities: DataFrame) -> DataFrame:
    """All numbers of the report as (section, key, value): metrics, counts, anomaly
    severities and hits of severity words."""
    metrics = headline_metrics(labelled)
    numbers = F.array(*(F.struct(F.lit(m).alias("key"), F.col(m).cast("double").alias("value")) for m in METRICS))
    counts = top_of_sections(aggregate.aggregate_all(labelled)).where(F.col("key").isNotNull())

    def section(table: DataFrame, name: Column, key: str, value: str) -> DataFrame:
        return table.select(name.alias("section"), F.col(key).alias("key"), F.col(value).cast("double").alias("value"))

    parts = [
        metrics.select(F.lit("metrics").alias("section"), F.inline(numbers)),
        section(counts, F.col("section"), "key", "records"),
        section(anomaly.severity_distribution(labelled), F.lit("anomaly_severity"), "severity", "records"),
        section(severities, F.lit("severity_words"), "severity", "hits"),
    ]
    return reduce(DataFrame.unionByName, parts)


def report_document(sections: DataFrame) -> DataFrame:
    """The report as one JSON text, from sections of a few entries each."""
    entries = F.sort_array(F.collect_list(F.struct("key", "value")))
    per_section = sections.groupBy("section").agg(F.map_from_entries(entries).alias("entries"))
    whole = F.sort_array(F.collect_list(F.struct("section", F.to_json("entries").alias("content"))))
    return per_section.agg(F.to_json(F.map_from_entries(whole)).alias("report"))
