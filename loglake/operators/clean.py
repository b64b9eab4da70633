"""Cleaning: duplicates, nulls, short messages, unreadable times."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from loglake import fixed_values as fv
from loglake.operators.lookup import lookup_join
from loglake.operators.parse import file_formats, nonblank_lines, route_lines, with_format
from loglake.operators.position import files_of, line_of, packed, rank_of, with_position
from loglake.schema import POSITION
from loglake.session import written


def dedup_keep_first(df: DataFrame, key: str = "_raw", order: Sequence[str] = POSITION) -> DataFrame:
    """One row per ``key``: the one that comes first in ``order``.

    For positions, and for a single integer column that is unique per row, a hash aggregate keeps the first
    position of every key, reduced inside each map task, so a line that makes up a third
    of the input is never gathered in one place; the rows at these positions are then fetched by a semi-join
    with numbers alone. No two rows may share a position. By positions, the rows are written once, as files, first
    copies and the rows kept are three passes over them, which would each parse the lines again.
    Any other order may have ties: there an aggregate carries the whole row.
    """
    if tuple(order) == POSITION:
        placed = with_position(written(df, "rows"))
    elif len(order) == 1 and isinstance(df.schema[order[0]].dataType, IntegralType):
        placed = df.withColumn("_position", F.col(order[0]).cast("bigint"))
    else:
        return _first_rows(df, key, order)
    firsts = placed.groupBy(key).agg(F.min("_position").alias("_position")).select("_position")
    return placed.join(firsts, "_position", "left_semi").select(*df.columns)


def _first_rows(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    rest = [c for c in df.columns if c != key and c not in order]
    first = F.min(F.struct(*order, *rest)).alias("_first")
    found = df.groupBy(key).agg(first)
    return found.select(*(key if c == key else F.col(f"_first.{c}") for c in df.columns))


def first_copies(lines: DataFrame, mode: str = "file") -> DataFrame:
    """First copy of every line that its format accepts, with ``_format``, before it is parsed.

    Equal to removing duplicates from the parsed records, but only the line and its packed
    position are shuffled: file, line number and format all follow from those two.
    """
    if mode == "line":
        files = files_of(lines)
        formatted = lookup_join(with_format(lines, mode), files, "_file")
    else:
        files = file_formats(lines)
        formatted = lookup_join(nonblank_lines(lines), files, "_file")
    by = ["value"] if mode == "file" else ["value", "_format"]
    accepted = route_lines(formatted).where(F.col("_outcome") != "dropped")
    line = F.when(F.col("_block") == 0, F.col("_line_no")).otherwise(-1)
    firsts = accepted.groupBy(*by).agg(F.min(packed(F.col("_rank"), line)).alias("_position"))
    placed = firsts.withColumn("_rank", rank_of(F.col("_position")))
    return lookup_join(placed, files, "_rank").select(
        "_file", F.lit(0).cast("bigint").alias("_block"), line_of(F.col("_position")).alias("_line_no"), "value", "_format"
    )


def dedup_rows(df: DataFrame) -> DataFrame:
    """Distinct whole rows, for tables without a raw line."""
    return df.distinct()


def drop_nulls(df: DataFrame) -> DataFrame:
    critical = [c for c in ("timestamp", "message") if c in df.columns]
    return df.na.drop(subset=critical)


def fill_nulls(df: DataFrame) -> DataFrame:
    fill = {"message": "", "level": fv.DEFAULT_LEVEL}
    return df.na.fill({c: v for c, v in fill.items() if c in df.columns})


def min_message_length(df: DataFrame, length: int = 5) -> DataFrame:
    """Messages of at least ``length`` characters; null messages go too."""
    return df.where(F.length("message") >= length)


def valid_timestamps(df: DataFrame) -> DataFrame:
    return df.where(F.col("timestamp").isNotNull())


def clean_logs(
    df: DataFrame,
    dedup: bool = True,
    null_handling: str = "drop",
    message_length: int = 5,
    key: str = "_raw",
    order: Sequence[str] = POSITION,
) -> DataFrame:
    """The whole cleaning job. Rows without a time always go, whatever ``null_handling``.

    Every rule after the first looks at one row only, and equal lines may differ in
    their record (they can stand in files of different formats), so duplicates go first.
    """
    if null_handling not in ("drop", "fill"):
        raise ValueError("null_handling must be 'drop' or 'fill'")
    if dedup:
        df = dedup_keep_first(df, key, order) if key in df.columns else dedup_rows(df)
    df = drop_nulls(df) if null_handling == "drop" else fill_nulls(df)
    return valid_timestamps(min_message_length(df, message_length))


def clean_audit(
    df: DataFrame,
    message_length: int = 5,
    key: str = "_raw",
    order: Sequence[str] = POSITION,
    null_handling: str = "drop",
) -> DataFrame:
    """Rows removed by each rule of the clean-up, each row counted once, in the rules' order.

    When nulls are filled no row goes for a null, a missing message is empty, and rows
    without a time go last.
    """
    if null_handling not in ("drop", "fill"):
        raise ValueError("null_handling must be 'drop' or 'fill'")
    drops = F.lit(null_handling == "drop")
    slim = df.select(
        key, *order, F.col("timestamp").isNull().alias("no_time"), F.length("message").alias("chars")
    )
    # a single number as the order keeps the buffers of fixed width, which a hash aggregate needs
    position = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    lines = slim.groupBy(key).agg(
        F.count("*").alias("copies"),
        F.min_by("no_time", position).alias("no_time"),
        F.min_by(F.coalesce("chars", F.lit(-1)), position).alias("chars"),
    )
    null_row = drops & (F.col("no_time") | (F.col("chars") < 0))
    short = ~null_row & (F.col("chars") < message_length)
    no_time = ~null_row & ~short & F.col("no_time")
    return lines.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("input_rows"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicates"),
        F.count_if(null_row).alias("null_rows"),
        F.count_if(short).alias("short_messages"),
        F.count_if(no_time).alias("invalid_times"),
        F.count_if(~null_row & ~short & ~no_time).alias("output_rows"),
    )


def filter_logs(
    df: DataFrame,
    level: str = "All",
    service: str = "All",
    date: str = "All",
    limit: int = 500,
    order: Sequence[str] = ("timestamp",),
) -> DataFrame:
    """Rows of one level, service and date ("All" for any), without internal columns."""
    for column, wanted in (("level", level), ("service", service), ("date", date)):
        if wanted != "All":
            df = df.where(F.col(column) == wanted)
    shown = [c for c in df.columns if not c.startswith("_")]
    return df.orderBy(*order).select(*shown).limit(limit)


def filter_choices(df: DataFrame, columns: Sequence[str] = ("level", "service", "date")) -> DataFrame:
    """Distinct values of each filter column, from one scan."""
    pairs = F.array(*(F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("choice")) for c in columns))
    return df.select(F.inline(pairs)).na.drop(subset=["choice"]).distinct().orderBy("field", "choice")
