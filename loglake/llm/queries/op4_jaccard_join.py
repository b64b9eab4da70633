"""op4: documents whose five-word shingle sets overlap by 80 percent and more."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loglake.llm import jaccard_join


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op4_jaccard_join": op4_jaccard_join}
