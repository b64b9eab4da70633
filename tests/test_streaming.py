from loglake.sources import test_tables as t
from loglake.streaming.incremental import process_new_files


def _write(lines, folder, name):
    lines.where(lines._file == name).select("value").coalesce(1).write.mode("append").text(folder)


def test_each_run_adds_only_new_files(spark, sf_dir, tmp_path):
    raw, table, progress = (str(tmp_path / n) for n in ("raw", "table", "progress"))
    lines = t.log_lines(spark, sf_dir, duplicates=False)

    def run():
        process_new_files(spark, raw, table, progress, t.INGEST_TS, t.DEFAULT_YEAR)
        return spark.read.parquet(table).groupBy("_format").count().collect()

    _write(lines, raw, "f4")
    apache = lines.where("_file = 'f4'").count()
    assert {r._format: r["count"] for r in run()} == {"apache": apache}

    _write(lines, raw, "f2")
    json = lines.where("_file = 'f2'").count()
    assert {r._format: r["count"] for r in run()} == {"apache": apache, "json": json}
    assert {r._format: r["count"] for r in run()} == {"apache": apache, "json": json}


def test_lines_of_earlier_runs_are_not_taken_in_again(spark, sf_dir, tmp_path):
    raw, table, progress = (str(tmp_path / n) for n in ("raw", "table", "progress"))
    lines = t.log_lines(spark, sf_dir, duplicates=False)
    for _ in range(2):
        _write(lines, raw, "f4")
        process_new_files(spark, raw, table, progress, t.INGEST_TS, t.DEFAULT_YEAR)
    assert spark.read.parquet(table).count() == lines.where("_file = 'f4'").count()
