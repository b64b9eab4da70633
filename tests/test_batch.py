"""Whole jobs, the lake, and plan shapes that matter at scale."""

import hashlib

import pytest
from pyspark.sql import functions as F

from loglake.operators.clean import clean_audit, clean_logs, dedup_keep_first
from loglake.operators.enrich import enrich_logs
from loglake.operators.lookup import lookup_join
from loglake.operators.parse import parse_logs
from loglake.plans import batch
from loglake.registry import storage
from loglake.schema import LINE_SCHEMA
from loglake.sources import lake, render, test_tables as t
from loglake.sources.raw_text import scan_raw_lines

NOW = "2026-01-01 00:00:00"
APACHE = '10.0.0.1 - - [09/Mar/2026:10:15:30 +0000] "GET /a HTTP/1.1" 200 1 "-" "x"'
SYSLOG = "Mar 09 10:15:30 h s[1]: [ERROR] failed hard"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_duplicates_before_parsing_equal_duplicates_after(spark):
    # the syslog line is dropped in the apache file and kept in its own
    rows = [("f0", 0, 0, APACHE), ("f0", 0, 1, SYSLOG), ("f1", 0, 0, SYSLOG), ("f1", 0, 1, SYSLOG), ("f2", 0, 0, APACHE)]
    lines = spark.createDataFrame(rows, LINE_SCHEMA)
    before = batch.process(lines, NOW, 2026).select("_file", "_line_no", "_raw", "level").collect()
    after = enrich_logs(clean_logs(parse_logs(lines, NOW, 2026))).select("_file", "_line_no", "_raw", "level").collect()
    assert sorted(map(tuple, before)) == sorted(map(tuple, after))
    assert sorted((r._file, r._line_no) for r in before) == [("f0", 0), ("f1", 0)]


def test_null_handling(spark, sf_dir):
    gaps = t.gaps(spark, sf_dir)
    options = {"key": "row_id", "order": ("timestamp",)}
    dropped = clean_logs(gaps, dedup=False, **options)
    filled = clean_logs(gaps, dedup=False, null_handling="fill", message_length=0, **options)
    assert dropped.where("message is null or timestamp is null").isEmpty()
    assert filled.where("level is null or timestamp is null").isEmpty()
    assert filled.count() == gaps.where("timestamp is not null").count()
    with pytest.raises(ValueError):
        clean_logs(gaps, null_handling="keep")


def test_duplicates_are_reduced_before_the_shuffle(spark):
    lines = spark.range(1000).selectExpr("'f' as _file", "0L as _block", "id as _line_no", "'same' as _raw")
    unique = dedup_keep_first(lines)
    assert "partial_min" in plan(unique) and "Window" not in plan(unique)
    assert unique.collect()[0]._line_no == 0


def test_filters_reach_the_scan(spark, sf_dir):
    text = plan(enrich_logs(t.logs(spark, sf_dir)).where(F.col("timestamp") < F.lit("2024-01-05").cast("timestamp_ntz")).select("hour"))
    assert "PushedFilters: [IsNotNull(ts), LessThan(ts" in text
    assert "ReadSchema: struct<ts:timestamp_ntz>" in text


@pytest.mark.parametrize("limit", ["10m", "-1"])
def test_lookup_join_gives_the_same_either_way(spark, limit):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        _lookups(spark)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _lookups(spark):
    big = spark.range(300).selectExpr("id", "case when id < 200 then 'hot' else concat('k', id % 5) end as key")
    small = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3)], "key string, v int")
    assert lookup_join(big, small, "key").count() == 240
    assert lookup_join(big, small, "key", "left").count() == 300


def test_lake_zones(spark, sf_dir, tmp_path):
    root = str(tmp_path)
    docs = t.table(spark, sf_dir, "documents").select("doc_id", F.lit("x").alias("_raw"))
    for zone in ("raw", "processed", "models", "reports"):
        lake.store_table(docs, root, zone, "docs", fmt="json")
    stored = spark.read.json(lake.zone_path(root, "models", "docs"))
    assert stored.columns == ["doc_id"] and stored.count() == docs.count()
    stats = {r.zone: r for r in lake.zone_stats(lake.lake_files(spark, root)).collect()}
    manifest = lake.file_manifest(spark, root, "raw").collect()
    assert stats["raw"].file_count == len(manifest) == lake.list_files(spark, root, "raw").count()
    assert stats["raw"].total_size_bytes == sum(m.size_bytes for m in manifest)
    assert lake.list_files(spark, root, "raw", "*.parquet").isEmpty()
    content = lake.retrieve(spark, root, "raw", "docs").agg(F.sum(F.length("content"))).first()[0]
    assert content == stats["raw"].total_size_bytes
    with pytest.raises(ValueError):
        lake.zone_path(root, "attic")


def test_latest_run_only(spark, sf_dir, tmp_path):
    rows = t.logs(spark, sf_dir).withColumn("run_date", F.when(F.col("row_id") < 600, "2024-01-01").otherwise("2024-01-02"))
    lake.store_table(rows, str(tmp_path), "processed", "logs", partition_by=("run_date",))
    assert lake.read_latest(spark, str(tmp_path), "processed", "logs").count() == rows.where("row_id >= 600").count()


def test_runs_keep_each_other(spark, sf_dir, tmp_path):
    lines = t.log_lines(spark, sf_dir).where("_file < 'f2'")
    for run in ("2024-02-01", "2024-02-02"):
        latest = batch.process_to_lake(lines, str(tmp_path), t.INGEST_TS, t.DEFAULT_YEAR, run)
    stored = spark.read.parquet(lake.zone_path(str(tmp_path), "processed", "logs"))
    counts = {str(r.run_date): r["count"] for r in stored.groupBy("run_date").count().collect()}
    assert counts == {"2024-02-01": latest.count(), "2024-02-02": latest.count()}
    assert {str(r.run_date) for r in latest.select("run_date").distinct().collect()} == {"2024-02-02"}


def test_line_numbers_do_not_depend_on_splits(spark, tmp_path):
    for name in ("a.log", "b.log"):
        (tmp_path / name).write_text("".join(f"{name} line {i}\n" for i in range(3000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("4k", "1m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            rows = batch.with_row_id(scan_raw_lines(spark, str(tmp_path))).orderBy("row_id").collect()
            assert [r.value for r in rows] == [f"{n} line {i}" for n in ("a.log", "b.log") for i in range(3000)]
            assert [r._line_no for r in rows] == [*range(3000)] * 2
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_audit_of_filled_rows_counts_those_without_a_time(spark, sf_dir):
    gaps = t.gaps(spark, sf_dir)
    audit = clean_audit(gaps, key="row_id", order=("row_id",), null_handling="fill").first()
    kept = clean_logs(gaps, False, "fill").count()
    assert audit.output_rows == kept and audit.invalid_times > 0 and audit.null_rows == 0
    assert "SortAggregate" not in plan(clean_audit(gaps, key="message", order=("row_id",)))


def test_whole_analysis(spark, sf_dir, tmp_path):
    lines = t.log_lines(spark, sf_dir)
    stored = batch.process_to_lake(lines, str(tmp_path), t.INGEST_TS, t.DEFAULT_YEAR, "2024-02-01")
    tables = batch.analyze(batch.with_row_id(stored), str(tmp_path))
    assert tables["scored"].count() == stored.count() == 1000
    assert tables["patterns"].count() == 10
    assert tables["total_messages"].first().total_messages == 1000
    assert (tmp_path / "models" / "anomaly" / "nodes").exists()


def test_render_rejects_unknown_formats(spark, sf_dir):
    with pytest.raises(ValueError):
        render.render(t.logs(spark, sf_dir), "csv")


def test_catalog_keeps_what_was_recorded(spark, tmp_path):
    root = str(tmp_path)
    for version, n in ((1, 10), (2, 500)):
        lake.store_recorded(spark.range(n).coalesce(1).selectExpr("cast(id as string) as value"), root, "raw", "a", version, fmt="text")
    lake.store_recorded(spark.range(8).repartition(2).selectExpr("cast(id as string) as value"), root, "reports", "a", 1, fmt="text")
    lake.store_table(spark.range(3).coalesce(1).selectExpr("'x' as value"), root, "raw", "b", fmt="text")
    found = {r.name: r for r in lake.file_metadata(spark, root, "raw", ["a", "b", "c"]).collect()}
    assert {n: (r.status, r.files, r.size_bytes) for n, r in found.items()} == {
        "a": ("recorded", 1, sum(len(str(i)) + 1 for i in range(500))), "b": ("listed", 1, 6), "c": ("missing", None, None),
    }
    assert found["a"].md5 == hashlib.md5("".join(f"{i}\n" for i in range(500)).encode()).hexdigest() and found["b"].md5 is None
    # files beyond the bound are listed, not read
    bounded = {r.name.split("/")[0]: r for r in lake.file_manifest(spark, root, "raw", largest=100).collect()}
    assert bounded["a"].md5 is None and bounded["a"].size_bytes > 100 and bounded["b"].md5 is not None
    stats = {r.zone: (r.file_count, r.total_size_bytes) for r in lake.zone_stats(lake.lake_files(spark, root)).collect()}
    assert stats["reports"] == (2, 16) and stats["processed"] == stats["models"] == (0, 0) and stats["raw"][0] == 2


def test_newest_batch_by_number(spark, tmp_path):
    for batch_no in (2, 9, 10):
        lake.store_batch(spark.range(batch_no).withColumnRenamed("id", "n"), str(tmp_path), "processed", "t", str(batch_no), by="batch")
    assert lake.read_latest(spark, str(tmp_path), "processed", "t", by="batch").count() == 10


def test_first_of_cluster_parses_lines_once(spark, sf_dir):
    """Files and positions come from written records, not from the lines again."""
    plan = storage.first_of_cluster(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace" not in plan


def test_a_batch_has_few_files_a_day(spark, tmp_path):
    rows = spark.range(800, numPartitions=8).select("id", (F.col("id") % 5).alias("date"))
    path = lake.store_batch(rows, str(tmp_path), "processed", "logs", "1", partition_by=("date",))
    assert len(list(tmp_path.glob("processed/logs/run_date=1/date=*/part-*.parquet"))) == 5
    got = spark.read.parquet(path).select("id", "date")
    assert sorted(map(tuple, got.collect())) == [(i, i % 5) for i in range(800)]
