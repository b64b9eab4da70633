"""op8: personal data in every document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loglake.llm import pii


def _count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = pii.detect(docs, pii.train(docs))
    base = F.filter("spans", lambda s: s["base"])
    counts = [_count(base, kind).alias(f"n_{kind}") for kind in pii.KINDS]
    digest = F.sha2(pii.joined(base).cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", *counts, digest, pii.joined(F.col("spans")).alias("spans"))


QUERIES = {"op8_pii": op8_pii}
