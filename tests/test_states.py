"""Stored states of batches: merging, repeated batches, empty columns."""

import pytest
from pyspark.sql import functions as F

from loglake.operators.aggregate import aggregate_all
from loglake.operators.enrich import enrich_logs
from loglake.plans import states
from loglake.sources import test_tables as t


@pytest.fixture(scope="module")
def rows(spark, sf_dir):
    return enrich_logs(t.logs(spark, sf_dir)).cache()


def test_counts_of_batches_add_up(spark, rows, tmp_path):
    root = str(tmp_path)
    states.store_batch(rows.where("row_id >= 500"), root, "late")
    for _ in range(2):
        states.store_batch(rows.where("row_id < 500"), root, "early")
    got = states.section_counts(spark, root)
    want = aggregate_all(rows)
    assert got.exceptAll(want.select(got.columns)).isEmpty() and got.count() == want.count()


def test_merged_days_equal_one_sketch_of_all(spark, rows):
    """A distinct count does not depend on how its rows were dealt out; ranks stay inside their bound."""
    days = states.daily_states(rows)
    merged = states.merged(days).select(F.hll_sketch_estimate("message_distinct")).first()[0]
    whole = rows.agg(F.hll_sketch_estimate(F.hll_sketch_agg("message", states.DISTINCT_BITS))).first()[0]
    assert merged == whole
    by_month = states.merged(days.withColumn("month", F.substring("date", 1, 7)), ["month"])
    assert {r.month: r.records for r in by_month.collect()} == {
        r.month: r["count"] for r in rows.groupBy(F.substring("date", 1, 7).alias("month")).count().collect()
    }


def test_columns_without_values(spark, tmp_path):
    schema = "date string, duration_ms double, response_size bigint, message string, ip string"
    some = [("2024-01-01", None, None, None, None), ("2024-01-02", float("nan"), 5, "m", None), (None, 1.0, 1, "x", "y")]
    root = str(tmp_path)
    states.lake.store_batch(states.daily_states(spark.createDataFrame(some, schema)), root, "processed", "daily_states", "b", by="batch")
    all_days = states.day_range(spark, root, "2024-01-01", "2024-01-02").first()
    assert (all_days.records, all_days.duration_ms_p50, all_days.response_size_p95) == (2, None, 5.0)
    assert (all_days.message_distinct, all_days.ip_distinct) == (1, 0)
    none = states.day_range(spark, root, "2025-01-01", "2025-12-31").first()
    assert (none.records, none.duration_ms_p99, none.message_distinct) == (0, None, 0)
