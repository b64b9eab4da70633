import datetime as dt

import pytest
from pyspark.sql import functions as F

from loglake.operators.aggregate import duration_stats, error_rate, histogram, time_bucket_distribution
from loglake.operators.enrich import enrich_logs
from loglake.operators.categories import CategoryDictionary, fit_categories, with_place, with_vector
from loglake.operators.features import categories, extract_features, record_features, window_features
from loglake.operators.percentiles import exact_percentiles


@pytest.fixture(scope="module")
def frame(spark):
    n = F.col("id")
    return spark.range(100).select(
        n.alias("row_id"),
        (F.lit("2026-01-01").cast("timestamp_ntz") + F.make_dt_interval(hours=n)).alias("timestamp"),
        F.element_at(F.array(*map(F.lit, ("INFO", "WARNING", "ERROR", "CRITICAL"))), (n % 4 + 1).cast("int")).alias("level"),
        F.concat(F.lit("Sample log message "), n.cast("string"), F.lit(" with error or success")).alias("message"),
        (n % 4 + 1).cast("int").alias("severity_num"),
        F.element_at(F.array(*map(F.lit, ("auth", "api", "payment"))), (n % 3 + 1).cast("int")).alias("service"),
    )


def test_record_features(frame):
    features = record_features(frame, encode=["service"])
    rows = features.toPandas()
    assert rows.shape[0] == 100 and rows.shape[1] > 5
    assert not rows.isnull().any().any()
    assert rows["hour"].between(0, 23).all()
    assert {"day_of_week", "is_weekend", "message_length", "word_count", "has_error_keyword"} <= set(rows)
    assert (rows[["service_auth", "service_api", "service_payment"]].sum(axis=1) == 1).all()
    assert (rows["has_error_keyword"] == 1).all() and (rows["word_count"] == 8).all()


def test_no_shuffle_for_record_features(frame):
    plan = record_features(frame)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_window_features(frame):
    rows = window_features(frame, 120).collect()
    assert len(rows) == 50 and all(r.log_count == 2 for r in rows)
    assert all(r.unique_messages == 2 for r in rows)


def test_modes(frame):
    assert extract_features(frame, "window").count() == 100
    with pytest.raises(ValueError):
        extract_features(frame, "daily")
    with pytest.raises(ValueError):
        window_features(frame.drop("timestamp"))


def test_no_more_columns_than_allowed(spark):
    frame = spark.range(1001).selectExpr("cast(id as string) as message")
    assert len(categories(frame.limit(1000), "message")) == 1000
    with pytest.raises(ValueError, match="dictionary"):
        categories(frame, "message")


def test_dictionary_of_many_values(spark, tmp_path, monkeypatch):
    """10,000 values: nothing is fetched, places follow the values' order, and a model read back
    encodes other rows alike: strange values share the last place, null has none."""
    frame = spark.range(30_000).selectExpr("concat('é', id % 10000) as v", "id").repartition(11)
    sent = []
    for name in ("collect", "toPandas"):
        keep = getattr(type(frame), name)
        monkeypatch.setattr(type(frame), name, lambda self, keep=keep: sent.append(self.columns) or keep(self))
    dictionary = fit_categories(frame, "v")
    assert not sent and dictionary.size == 10_000 and dictionary.width == 10_001
    dictionary.save(str(tmp_path / "d"))
    loaded = CategoryDictionary.load(spark, str(tmp_path / "d"))
    rows = spark.createDataFrame([("é7", 1), ("strange", 2), (None, 3), ("é9999", 4), ("é7", 5), ("", 6)], "v string, id int")
    order = {v: i for i, v in enumerate(sorted(f"é{i}" for i in range(10_000)))}
    want = {1: [order["é7"]], 2: [10_000], 3: [], 4: [order["é9999"]], 5: [order["é7"]], 6: [10_000]}
    for limit in ("10m", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        got = with_vector(rows, "v", loaded).collect()
        assert {r.id: r.v_vector.indices for r in got} == want and {r.v_vector.size for r in got} == {10_001}
        assert all(len(r.v_vector.values) == len(r.v_vector.indices) for r in got)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    places = dictionary.table.agg(F.min("place"), F.max("place"), F.countDistinct("place")).first()
    assert tuple(places) == (0, 9999, 10_000)


def test_dictionary_without_values(spark):
    none = spark.createDataFrame([(None,)], "v string")
    dictionary = fit_categories(none, "v")
    assert dictionary.size == 0
    assert [r.v_place for r in with_place(spark.createDataFrame([("a",), (None,)], "v string"), "v", dictionary).collect()] == [0, None]



@pytest.mark.parametrize(
    "hour, bucket",
    [(0, "night"), (6, "night"), (7, "morning"), (12, "morning"), (13, "afternoon"), (18, "afternoon"), (19, "evening"), (23, "evening")],
)
def test_time_bucket_edges(spark, hour, bucket):
    rows = [(dt.datetime(2026, 2, 2, hour), "warn", "hello")]
    row = enrich_logs(spark.createDataFrame(rows, "timestamp timestamp_ntz, level string, message string")).first()
    assert (row.time_bucket, row.level, row.day_of_week) == (bucket, "WARNING", 0)


@pytest.mark.parametrize("status, category", [(0, None), (1, "1xx"), (199, "1xx"), (200, "2xx"), (599, "5xx"), (600, None), (None, None)])
def test_status_category_edges(spark, status, category):
    schema = "timestamp timestamp_ntz, level string, message string, status_code int"
    row = enrich_logs(spark.createDataFrame([(None, None, None, status)], schema)).first()
    assert row.status_category == category


def test_exact_percentiles_match_the_built_in(spark):
    df = spark.range(5000).select(
        (F.col("id") % 3).alias("k"), F.when(F.col("id") % 11 > 0, F.pow(F.rand(3) * 20 - 5, 3)).alias("x")
    )
    probabilities = {"a": 0.0, "b": 0.5, "c": 0.95, "d": 1.0}
    mine = {r.k: r for r in exact_percentiles(df, ["k"], "x", probabilities).collect()}
    theirs = df.groupBy("k").agg(F.percentile("x", list(probabilities.values())).alias("p")).collect()
    for row in theirs:
        for name, value in zip(probabilities, row.p):
            assert mine[row.k][name] == pytest.approx(value, abs=1e-9)


def test_empty_tables(spark):
    schema = "timestamp timestamp_ntz, level string, message string, duration_ms double"
    empty = enrich_logs(spark.createDataFrame([], schema))
    assert error_rate(empty).first().error_rate == 0
    assert duration_stats(empty).first().p95 is None
    assert time_bucket_distribution(empty).agg(F.sum("records")).first()[0] == 0
    assert histogram(empty, "duration_ms").count() == 0


def test_histogram_of_one_value(spark):
    assert [tuple(r) for r in histogram(spark.range(5).selectExpr("1.5 as x"), "x").collect()] == [(1, 5)]
