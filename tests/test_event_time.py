"""Event-time streams: late rows, complete windows, forgotten keys, restarts."""

import datetime as dt

from loglake.streaming import event_time

SCHEMA = "id int, timestamp timestamp_ntz, level string, duration_ms double"


def at(hour, minute=0):
    return dt.datetime(2026, 3, 1) + dt.timedelta(hours=hour, minutes=minute)


def _feed(spark, root, rows):
    spark.createDataFrame(rows, SCHEMA).write.mode("append").parquet(f"{root}/in")
    return spark.readStream.schema(SCHEMA).parquet(f"{root}/in")


def test_windows_are_written_once_and_late_rows_do_not_count(spark, tmp_path):
    root = str(tmp_path)

    def run(rows):
        event_time.append_window_features(_feed(spark, root, rows), f"{root}/out", f"{root}/progress", 60, "2 hours")
        return {r.window_start.hour: (r.log_count, r.avg_duration) for r in spark.read.parquet(f"{root}/out").collect()}

    first = run([(1, at(0, 5), "ERROR", 10.0), (2, at(1, 5), "INFO", None), (3, at(4, 10), "INFO", 2.0), (4, None, "INFO", 1.0)])
    assert first == {0: (1, 10.0), 1: (1, 0.0)}
    # the watermark is 02:10: hours 0 and 1 are complete, 2 is still open
    second = run([(5, at(1, 50), "INFO", 7.0), (6, at(2, 30), "INFO", 4.0), (7, at(6, 0), "INFO", 8.0)])
    assert second == {0: (1, 10.0), 1: (1, 0.0), 2: (1, 4.0)}
    assert run([]) == second


def test_copies_are_forgotten_behind_the_watermark(spark, tmp_path):
    root = str(tmp_path)

    def run(rows):
        event_time.append_first_copies(_feed(spark, root, rows), f"{root}/out", f"{root}/progress", ["id"], delay="2 hours")
        return sorted((r.id, r.timestamp.hour) for r in spark.read.parquet(f"{root}/out").collect())

    assert run([(1, at(0), "INFO", 1.0), (1, at(0), "INFO", 1.0), (2, at(1), "INFO", 1.0)]) == [(1, 0), (2, 1)]
    # within the delay it is a copy; the same key ten hours later is taken again, once
    assert run([(2, at(2), "INFO", 1.0), (3, at(10), "INFO", 1.0)]) == [(1, 0), (2, 1), (3, 10)]
    assert run([(1, at(11), "INFO", 1.0), (1, at(11), "INFO", 1.0), (3, at(11), "INFO", 1.0), (9, at(1), "INFO", 1.0)]) == [
        (1, 0), (1, 11), (2, 1), (3, 10),
    ]
