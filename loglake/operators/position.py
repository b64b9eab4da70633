"""Where a line stands in the input, packed into one 64-bit number.

The upper bits are the rank of the line's file among all files in name order, the lower
ones the line's number in its file. Numbers compare like positions, and as they have a fixed width an aggregate that
keeps the first line of a group is a hash aggregate: its buffer is updated in place and
nothing is sorted. Positions that do not fit are an error and never a wrong number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loglake.session import written

#: Bits of a line's number in its file, and of a file's rank.
LINE_BITS, FILE_BITS = 40, 23


def ranked(files: DataFrame) -> DataFrame:
    """``files`` (one row per ``_file``) with ``_rank``, from 0 in the order of names.

    One task ranks them: there are as many rows as files, not as lines.
    """
    return files.withColumn("_rank", (F.row_number().over(Window.orderBy("_file")) - 1).cast("bigint"))


def files_of(lines: DataFrame) -> DataFrame:
    return written(ranked(lines.select("_file").distinct()), "files")


def packed(rank: Column, line: Column) -> Column:
    fits = (rank < (1 << FILE_BITS)) & (line >= 0) & (line < (1 << LINE_BITS))
    error = F.raise_error(F.concat(F.lit("no position for line "), line.cast("string"), F.lit(" of file "), rank.cast("string")))
    return F.when(fits, F.shiftleft(rank, LINE_BITS) + line).otherwise(error.cast("bigint"))


def rank_of(position: Column) -> Column:
    return F.shiftright(position, LINE_BITS)


def line_of(position: Column) -> Column:
    return position.bitwiseAND((1 << LINE_BITS) - 1)


def with_position(lines: DataFrame, name: str = "_position") -> DataFrame:
    """Lines or records with their packed position. Line numbers count within the file:
    every row's ``_block`` must be 0, as the scans of this library make it."""
    line = F.col("_line_no")
    if "_block" in lines.columns:
        line = F.when(F.col("_block") == 0, line).otherwise(-1)
    placed = lines.join(files_of(lines), "_file").withColumn(name, packed(F.col("_rank"), line))
    return placed.select(*lines.columns, name)
