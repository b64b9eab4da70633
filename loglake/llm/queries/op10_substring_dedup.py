"""op10: spans of twenty words and more that repeat, removed from every document but the first."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loglake.llm import substring_dedup as dedup


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    removed = dedup.remove(docs, dedup.factors(docs))
    return removed.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {"op10_substring_dedup": op10_substring_dedup}
