"""Recurring runs that process only the files that arrived since the last one.

Where a timer would rerun the whole batch, a stream with an available-now trigger keeps
track of the files already seen, processes the new ones and stops.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from loglake.plans.batch import process
from loglake.session import job
from loglake.sources.raw_text import numbered, with_splits


def process_new_files(
    spark: SparkSession,
    raw_folder: str,
    table: str,
    progress: str,
    ingest_ts: Column | str,
    default_year: int,
    **cleaning,
) -> None:
    """Parse, clean and enrich the new files below ``raw_folder`` into ``table``.

    Every micro-batch writes its own ``batch`` partition and replaces it when it is
    repeated after a failure, so no file counts twice. ``progress`` is the stream's
    checkpoint folder, which also keeps the store of all lines taken in: duplicates of
    lines of earlier runs are removed as well as those within a run, so the table grows
    to what one batch over all files gives. Line numbers count within the file.
    """
    lines = with_splits(spark.readStream.text(raw_folder))

    def write_batch(batch: DataFrame, number: int) -> None:
        with job(spark):
            records = process(numbered(batch), ingest_ts, default_year, known_lines=f"{progress}/lines", run=number, **cleaning)
            records.drop("_raw").write.mode("overwrite").parquet(f"{table}/batch={number}")

    query = (
        lines.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
