"""Joining a big table to one that is expected to be small."""

from __future__ import annotations

from pyspark.sql import DataFrame

from loglake.session import written


def lookup_join(big: DataFrame, small: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join on ``key``, where ``small`` holds one row per key.

    ``small`` is written once, so its size in bytes is known when the join is planned: below
    the broadcast threshold ``big`` is not shuffled. Beyond it both sides are, and partitions
    of a key that holds a large part of ``big`` are split at run time.
    """
    return big.join(written(small, "lookup"), key, how)
