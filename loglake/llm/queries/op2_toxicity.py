"""op2: toxicity of every document, learned from the labels outside the held-out fold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loglake.llm import toxicity

FOLDS = 5


def held_out() -> Column:
    """The fold whose labels are never learned; a null id is in no fold."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == 0, F.lit(False))


def scores(docs: DataFrame, labels: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    return toxicity.score(docs, toxicity.train(docs, labels, ~held_out()), keep)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scored = scores(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return scored.select("doc_id", held_out().alias("held_out"), "score", predicted)


QUERIES = {"op2_toxicity": op2_toxicity}
