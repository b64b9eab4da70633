"""One-hot encoding of columns with any number of values, by a fitted dictionary.

Fitting numbers the distinct values in their order; the table of value and number is a model of its
own that is stored and read like one. Encoding joins rows with it by value and gives the place of the
only 1 of a sparse vector. Values that were not there when it was fitted share one place
behind all others, so vectors always have the width of the model.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loglake.operators.lookup import lookup_join
from loglake.session import written


@dataclass
class CategoryDictionary:
    """``table`` has one row per value (``value``, ``place`` from 0), ``size`` is its row count."""

    table: DataFrame
    size: int

    @property
    def width(self) -> int:
        """Places of a vector: one for each value and one for all others."""
        return self.size + 1

    def save(self, path: str) -> None:
        self.table.write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> CategoryDictionary:
        table = spark.read.schema("value string, place bigint").parquet(path)
        return CategoryDictionary(table, table.count())


def fit_categories(df: DataFrame, column: str) -> CategoryDictionary:
    """Numbers the distinct values of a column in their order; nulls are no value.

    Values are sorted by range, and a range's numbers start where the one before it ends, so
    neither the driver nor one task sees them all.
    """
    values = df.select(F.col(column).cast("string").alias("value")).na.drop().distinct()
    # the upper bits of these ids are the number of the sorted range, the lower ones count inside it
    seen = written(values.orderBy("value").withColumn("_seen", F.monotonically_increasing_id()), "values")
    part, inside = F.shiftright("_seen", 33), F.col("_seen").bitwiseAND((1 << 33) - 1)
    held = seen.groupBy(part.alias("_part")).agg(F.count("*").alias("_held"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    held = held.select("_part", F.coalesce(F.sum("_held").over(earlier), F.lit(0)).alias("_before"))
    table = lookup_join(seen.withColumn("_part", part), held, "_part").select("value", (F.col("_before") + inside).alias("place"))
    table = written(table, "dictionary")
    return CategoryDictionary(table, table.count())


def with_place(df: DataFrame, column: str, dictionary: CategoryDictionary, name: str = "") -> DataFrame:
    """Rows with ``<column>_place``: the number of the value, the last place for a strange
    one, null for null. Small dictionaries are broadcast by their size; beside a large one a value that
    many rows hold is split at run time."""
    name = name or f"{column}_place"
    table = dictionary.table.select(F.col("value").alias("_category"), F.col("place").alias("_found"))
    joined = lookup_join(df.withColumn("_category", F.col(column).cast("string")), table, "_category", "left")
    place = F.when(F.col("_category").isNotNull(), F.coalesce("_found", F.lit(dictionary.size)))
    return joined.withColumn(name, place).drop("_category", "_found")


def sparse(place: Column, width: int) -> Column:
    """A one-hot vector in sparse form: its size, the places that are not 0, their values."""
    some = place.isNotNull()
    return F.struct(
        F.lit(width).cast("bigint").alias("size"),
        F.when(some, F.array(place)).otherwise(F.array().cast("array<bigint>")).alias("indices"),
        F.when(some, F.array(F.lit(1.0))).otherwise(F.array().cast("array<double>")).alias("values"),
    )


def with_vector(df: DataFrame, column: str, dictionary: CategoryDictionary) -> DataFrame:
    placed = with_place(df, column, dictionary, "_place")
    return placed.withColumn(f"{column}_vector", sparse(F.col("_place"), dictionary.width)).drop("_place")
