"""op5: quality of every document, learned from the labels outside the held-out fold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loglake.llm import quality_model


def held_out() -> Column:
    """The fold whose labels are never learned; a null id is in no fold."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def op5_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = quality_model.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), ~held_out())
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return quality_model.score(docs, model).select("doc_id", held_out().alias("held_out"), "score", predicted)


QUERIES = {"op5_quality_model": op5_quality_model}
