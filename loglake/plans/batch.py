"""Whole jobs: lines to enriched table, and the analyses on top of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loglake import fixed_values as fv
from loglake.operators import aggregate, anomaly, patterns, text
from loglake.operators.clean import clean_logs, first_copies
from loglake.operators.enrich import enrich_logs
from loglake.operators.features import record_features
from loglake.operators.parse import parse_lines, records_of, with_format
from loglake.operators.position import with_position
from loglake.session import job
from loglake.sources import lake, line_store, test_tables


def process(
    lines: DataFrame,
    ingest_ts: Column | str,
    default_year: int,
    mode: str = "file",
    dedup: bool = True,
    null_handling: str = "drop",
    message_length: int = 5,
    known_lines: str | None = None,
    run: int = 0,
) -> DataFrame:
    """Parse, clean and enrich raw lines. Duplicates go before the lines are parsed.

    ``known_lines`` is a store of the lines of runs before ``run`` (``line_store``):
    lines that stand there are duplicates too, and the new ones are added to it.
    """
    if not dedup:
        formatted = with_format(lines, mode)
    elif known_lines:
        formatted = line_store.take_new(first_copies(lines, mode), known_lines, run)
    else:
        formatted = first_copies(lines, mode)
    records = records_of(parse_lines(formatted, ingest_ts, default_year))
    return enrich_logs(clean_logs(records, False, null_handling, message_length))


def process_to_lake(lines: DataFrame, root: str, ingest_ts: str, default_year: int, run_date: str) -> DataFrame:
    """Process lines into the lake once and return the stored batch, which every later
    step scans. The table is partitioned by run and by day."""
    with job(lines.sparkSession):
        batch = process(lines, ingest_ts, default_year)
        lake.store_batch(batch, root, "processed", "logs", run_date, partition_by=("date",))
    return lake.read_latest(lines.sparkSession, root, "processed", "logs")


def with_row_id(df: DataFrame) -> DataFrame:
    """A row id that orders records by file name and line, and is unique and the same in every run."""
    return with_position(df, "row_id")


def batch_stats(df: DataFrame) -> DataFrame:
    """Rows, column names and time range of a batch."""
    return df.agg(
        F.count("*").alias("total_records"),
        F.lit(",".join(df.columns)).alias("columns"),
        F.min("timestamp").alias("start"),
        F.max("timestamp").alias("end"),
    )


def analyze(df: DataFrame, root: str, key: str = "row_id") -> dict[str, DataFrame]:
    """Anomalies, patterns and text mining of an enriched table; models go to the lake."""
    spark = df.sparkSession
    features = record_features(df, keep=[key, "timestamp", "message"])
    detector = anomaly.AnomalyDetector().fit(features, fv.NUMERIC_FEATURES, key)
    detector.save(spark, lake.zone_path(root, "models", "anomaly"))
    scored = detector.predict(features)
    slim = scored.select(
        key, "timestamp", "message", "is_anomaly", "anomaly_score", "anomaly_severity"
    )
    lake.store_table(slim, root, "processed", "anomaly_results")

    model, labelled = patterns.fit_patterns(df.select(F.col(key).alias("row_id"), "message"))
    model.save(spark, lake.zone_path(root, "models", "patterns"))
    return {
        "scored": scored,
        "patterns": model.summary(),
        "pattern_labels": labelled,
        **text.analyze(df),
    }


def error_rate_by_service_and_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship query: raw lines of four formats, parsed, cleaned, enriched, counted."""
    lines = test_tables.log_lines(spark, sf_dir)
    enriched = process(lines, test_tables.INGEST_TS, test_tables.DEFAULT_YEAR)
    rates = aggregate.error_rate(enriched.where(F.col("service").isNotNull()), "service", "hour")
    return rates.orderBy("service", "hour")
