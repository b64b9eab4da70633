"""The corpus pipeline: every stage works on all that its predecessor kept.

Stages take (spark, docs, sf_dir); all but the last return the columns of documents. Each
result is written and read again, so a lost executor costs a stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loglake.llm import bpe, jaccard_join, mixing, pii
from loglake.llm.queries import op2_toxicity
from loglake.llm.queries.op7_bpe import tokenizer_path
from loglake.session import arrow_rows, job, release_memory, scratch_path, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
TOXIC = 0.5
#: Texts that a Python task gets at once; the JVM holds them as well, beside what earlier stages have left there.
BATCH = 2000


def _in_small_batches(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` written here: the size of batches is a setting of the time at which a plan is run."""
    with arrow_rows(rows.sparkSession, BATCH):
        return written(rows, name)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below ``TOXIC``; empty ones score 0 and stay."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = op2_toxicity.scores(docs, labels, COLUMNS)
    release_memory()
    return _in_small_batches(scored.where(F.col("score") < TOXIC).select(*COLUMNS), "harmless")


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest id of each group of near duplicates, once; rows without an id
    come last, and equal ids are told apart by a hash of the whole row. Empty documents are no
    duplicates of each other: all stay, but for rows repeated as a whole."""
    # a null leaves a hash as it was, so it is told by a flag; the hash stands for the row
    whole = F.xxhash64(*(x for c in COLUMNS for x in (F.col(c), F.col(c).isNull())))
    docs = docs.select(*COLUMNS, whole.alias("row"))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")
    path = scratch_path(spark, "first")
    # the tables of the join go when its result, a number for each group, is written
    with job(spark):
        groups = jaccard_join.groups(docs.select(F.col("row").alias("doc_id"), "text"))
        groups = groups.select(F.col("doc_id").alias("row"), "component_id").distinct()
        first = docs.select("doc_id", "row").distinct().join(groups, "row").groupBy("component_id").agg(F.min(order).alias("first"))
        first.select("first.row").write.parquet(path)
    first = spark.read.schema("row bigint").parquet(path)
    return docs.join(first, "row", "left_semi").dropDuplicates(["row"]).select(*COLUMNS)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their personal data replaced by its kind."""
    model = pii.train(docs)
    release_memory()
    return _in_small_batches(pii.redact(docs.select(*COLUMNS), model), "redacted")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document; a document taken twice in part gives two rows."""
    return mixing.mix(docs, with_text=True).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left, as training shards hold them."""
    encoded = _in_small_batches(bpe.encode(docs, tokenizer_path(), keep=("doc_id", "lang", "source")), "encoded")
    return encoded.withColumn("n_tokens", (F.length("token_ids") / 4).cast("bigint"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", one_of_each_group),
    ("personal data", redact),
    ("mixture", mix),
    ("tokens", encode),
]

#: Training, message passing and merge queues have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        path = scratch_path(spark, "pipeline")
        # the tables of a stage go with it
        with job(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
