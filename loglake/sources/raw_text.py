"""Raw log files as line rows, in a fixed order that does not depend on task timing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loglake.session import spread, written


def scan_raw_lines(spark: SparkSession, folder: str) -> DataFrame:
    """All lines below ``folder``; names starting with ``_`` or ``.`` are skipped.

    ``_line_no`` counts from 0 within the file, however the file is split among tasks.
    ``_block`` is 0, so (_file, _block, _line_no) is the reading order of the files in name order.
    """
    return numbered(with_splits(spark.read.text(folder)))


def with_splits(text: DataFrame) -> DataFrame:
    """The lines of a text scan with the file and the split that each comes from."""
    return text.select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"), "value"
    )


def numbered(scan: DataFrame) -> DataFrame:
    """Lines with their number in their file, in two passes over ``scan``: the first counts the
    lines of every split.

    Both passes must deal the splits out to tasks alike, as two scans of the same files with
    the same settings do. Where they do not, a line's place lies outside its split's count; that is an error.
    """
    seen = scan.withColumn("_seen", F.monotonically_increasing_id())
    # ids grow by one inside a split, from where the task stands when it comes to it
    splits = seen.groupBy("_file", "_start").agg(F.min("_seen").alias("_from"), F.count("*").alias("_lines"))
    splits = written(splits, "splits")
    earlier = Window.partitionBy("_file").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_lines").over(earlier), F.lit(0)).alias("_before")
    place = F.col("_seen") - F.col("_from")
    error = F.raise_error(F.concat(F.lit("the two scans split this file in different ways: "), F.col("_file"))).cast("bigint")
    number = F.when((place >= 0) & (place < F.col("_lines")), F.col("_before") + place).otherwise(error)
    lines = seen.join(splits.select("_file", "_start", "_from", "_lines", before), ["_file", "_start"])
    return spread(lines.select("_file", F.lit(0).cast("bigint").alias("_block"), number.alias("_line_no"), "value"))
