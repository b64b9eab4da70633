"""op9: nearest neighbours of every fiftieth embedding among all."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loglake.llm import ann

EVERY = 50


def op9_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return ann.search(vectors, vectors.where(F.col("vec_id") % EVERY == 0), "vec_id", "embedding")


QUERIES = {"op9_ann": op9_ann}
