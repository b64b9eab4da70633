"""op1: mixing all documents to target weights."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loglake.llm import mixing


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op1_mixing": op1_mixing}
