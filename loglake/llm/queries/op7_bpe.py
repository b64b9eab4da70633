"""op7: BPE encoding and decoding of every document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loglake.llm import bpe

FILE = "word_bpe_49k.json"


def tokenizer_path(name: str = FILE) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), tokenizer_path())


QUERIES = {"op7_bpe": op7_bpe}
