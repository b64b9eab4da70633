"""op12: every document as token ids in ORC files, read back from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loglake.llm import token_files
from loglake.llm.queries.op7_bpe import tokenizer_path
from loglake.session import scratch_path


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write(spark.read.parquet(f"{sf_dir}/documents.parquet"), path, tokenizer_path())
    rows = token_files.with_crc(token_files.read(spark, path))
    return token_files.placed(spark, rows, path).select("doc_id", "start", "n_tokens", "ids_crc32")


QUERIES = {"op12_token_files": op12_token_files}
