"""Packed positions: order, bounds, and plans that sort no raw text."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from loglake.operators import clean, parse, position
from loglake.plans import batch
from loglake.schema import LINE_SCHEMA
from loglake.sources import raw_text
from loglake.sources import test_tables as t


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_positions_order_like_file_and_line(spark):
    rows = [("b", 0, 7), ("a", 0, 1 << 39), ("b", 0, 0), ("c", 0, 3), ("a", 0, 2)]
    df = position.with_position(spark.createDataFrame(rows, "_file string, _block bigint, _line_no bigint"))
    got = [(r._file, r._line_no) for r in df.orderBy("_position").collect()]
    assert got == sorted((f, n) for f, _, n in rows)
    back = df.select("_line_no", position.line_of(F.col("_position")).alias("n"), position.rank_of(F.col("_position")).alias("r"), "_file")
    assert all(r.n == r._line_no and "abc"[r.r] == r._file for r in back.collect())


@pytest.mark.parametrize("row", [("a", 0, 1 << 40), ("a", 0, -1), ("a", 5, 1)])
def test_positions_that_do_not_fit_are_errors(spark, row):
    df = spark.createDataFrame([row], "_file string, _block bigint, _line_no bigint")
    with pytest.raises(PySparkException):
        position.with_position(df).collect()


def test_too_many_files_are_an_error(spark):
    df = spark.range(1).select(position.packed(F.lit(1 << position.FILE_BITS).cast("bigint"), F.col("id")).alias("p"))
    with pytest.raises(PySparkException):
        df.collect()


@pytest.mark.parametrize("mode", ["file", "line"])
def test_no_plan_sorts_raw_lines(spark, sf_dir, mode):
    lines = t.log_lines(spark, sf_dir)
    parsed = parse.parse_logs(lines, t.INGEST_TS, t.DEFAULT_YEAR, mode)
    plans = [
        plan(clean.dedup_keep_first(lines, "value")),
        plan(clean.clean_logs(parsed)),
        plan(parse.file_formats(lines)),
        plan(clean.first_copies(lines, mode)),
        plan(batch.process(lines, t.INGEST_TS, t.DEFAULT_YEAR, mode)),
    ]
    assert all("SortAggregate" not in p for p in plans)
    assert "partial_min(_position" in plans[0] and "HashAggregate(keys=[value" in plans[3]


@pytest.mark.parametrize("mode", ["file", "line"])
def test_first_copies_equal_a_loop(spark, mode):
    apache = '10.9.8.7 - - [02/Feb/2025:01:02:03 +0000] "PUT /x HTTP/1.1" 204 8 "-" "agent"'
    syslog = "Feb 02 01:02:03 box cron[77]: [INFO] nightly job done"
    rows = [("f1", 0, 0, "  "), ("f1", 0, 1, apache), ("f1", 0, 2, syslog), ("f0", 0, 5, syslog), ("f0", 0, 3, syslog), ("f0", 0, 9, apache),
            ("f2", 0, 0, "free text"), ("f2", 0, 1, apache), ("f2", 0, 2, syslog), ("f2", 0, 4, "free text"), ("f3", 0, 0, "")]
    lines = spark.createDataFrame(rows, LINE_SCHEMA)
    accepted = parse.route_lines(parse.with_format(lines, mode)).where("_outcome <> 'dropped'").collect()
    want = {}
    for r in sorted(accepted, key=lambda r: (r._file, r._line_no)):
        want.setdefault(r.value, (r._file, r._line_no, r._format))
    got = {r.value: (r._file, r._line_no, r._format) for r in clean.first_copies(lines, mode).collect()}
    assert got == want


def test_null_keys_and_one_hot_line(spark):
    rows = [("f", 0, i, None if i % 5 == 0 else "hot" if i % 3 else f"v{i % 7}") for i in range(1000)]
    df = spark.createDataFrame(rows, LINE_SCHEMA).repartition(7)
    got = {r.value: r._line_no for r in clean.dedup_keep_first(df, "value").collect()}
    want = {}
    for _, _, i, v in rows:
        want.setdefault(v, i)
    assert got == want


def test_ids_are_unique_with_many_partitions(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    for f in range(4):
        (folder / f"{f}.log").write_text("".join(f"{f} line {i}\n" for i in range(2000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "500b")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        scan = raw_text.with_splits(spark.read.text(str(folder)))
        assert scan.rdd.getNumPartitions() >= 150
        rows = batch.with_row_id(raw_text.numbered(scan)).orderBy("row_id").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [r.value for r in rows] == [f"{f} line {i}" for f in range(4) for i in range(2000)]
    assert len({r.row_id for r in rows}) == 8000


def test_rows_are_made_once(spark):
    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(value):
        made.add(1)
        return value

    rows = [("f1", 0, n, value) for n, value in enumerate("abcab")]
    df = spark.createDataFrame(rows, "_file string, _block bigint, _line_no bigint, value string")
    got = clean.dedup_keep_first(df.withColumn("value", seen("value")), "value").collect()
    assert sorted((r.value, r._line_no) for r in got) == [("a", 0), ("b", 1), ("c", 2)]
    assert made.value == len(rows)
