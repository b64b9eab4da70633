"""Enrichment: derived columns of a cleaned record, one projection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglake.functions import columns as c


def enrich_logs(df: DataFrame) -> DataFrame:
    hour = F.hour("timestamp")
    level = c.normalize_level(F.col("level"))
    derived = {
        "level": level,
        "hour": hour,
        "day_of_week": F.weekday("timestamp"),
        "date": c.date_text(F.col("timestamp")),
        "is_business_hours": c.is_business_hours(hour),
        "time_bucket": c.time_bucket(hour),
        "severity_num": c.severity_num(level),
        "message_length": F.length("message"),
    }
    if "status_code" in df.columns:
        derived["status_category"] = c.status_category(F.col("status_code"))
    return df.withColumns(derived)
