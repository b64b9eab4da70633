"""Lines known from earlier runs: what is read, and what is new."""

from pyspark.sql import functions as F

from loglake.sources import line_store as store
from loglake.sources import test_tables as t
from loglake.streaming.incremental import process_new_files


def _lines(spark, first, last):
    return spark.range(first, last).selectExpr("'f' as _file", "0L as _block", "id as _line_no", "concat('line ', id) as value")


def _values(df):
    return sorted(r.value for r in df.select("value").collect())


def test_takes_each_line_once(spark, tmp_path):
    path = str(tmp_path / "store")
    first = store.take_new(_lines(spark, 0, 3000), path, 0)
    second = store.take_new(_lines(spark, 2000, 5000), path, 1)
    third = store.take_new(_lines(spark, 0, 5100), path, 2)
    assert first.count() == 3000 and first.columns == ["_file", "_block", "_line_no", "value"]
    assert _values(second) == _values(_lines(spark, 3000, 5000))
    assert _values(third) == _values(_lines(spark, 5000, 5100))


def test_a_repeated_run_gives_the_same(spark, tmp_path):
    path = str(tmp_path / "store")
    store.take_new(_lines(spark, 0, 100), path, 0)
    for _ in range(2):
        assert _values(store.take_new(_lines(spark, 50, 200), path, 1)) == _values(_lines(spark, 100, 200))
    assert store.take_new(_lines(spark, 0, 200), path, 2).isEmpty()
    assert store.take_new(_lines(spark, 0, 0), path, 3).isEmpty()


def test_only_ranges_with_hits_are_read(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "store")
    store.take_new(_lines(spark, 0, 5000), path, 0)
    asked = []
    known = store.known_lines
    monkeypatch.setattr(store, "known_lines", lambda s, p, r, ranges: asked.append(known(s, p, r, ranges)) or asked[-1])
    # no copies: filters rule nearly all lines out; three copies: the three ranges they are in
    assert store.take_new(_lines(spark, 10_000, 10_500), path, 1).count() == 500
    copies = _lines(spark, 7, 10)
    assert store.take_new(copies.unionByName(_lines(spark, 20_000, 20_001)), path, 2).count() == 1
    held = {r.range for r in store.with_keys(copies).collect()}
    read = asked[-1]
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "range#" in plan.split("PartitionFilters")[1].split("]")[0]
    files = [r[0] for r in read.select(F.input_file_name()).distinct().collect()]
    assert len({f.split("range=")[1].split("/")[0] for f in files}) <= len(held) + 1 < 1 << store.RANGE_BITS
    assert all("/run=0/" in f or "/run=1/" in f for f in files)


def test_filters_never_miss_and_merge_by_or(spark):
    one, two, other = (store.with_keys(_lines(spark, *x)) for x in ((0, 4000), (4000, 8000), (100_000, 108_000)))
    both = store.merged(store.filter_of(one, 1).unionByName(store.filter_of(two, 1)))
    whole = store.filter_of(one.unionByName(two), 1)
    assert both.exceptAll(whole).isEmpty() and whole.exceptAll(both).isEmpty()
    assert store.possible(one.unionByName(two), both).count() == 8000
    assert store.possible(other, both).count() < 80
    # filters of several sizes: a line is tested on each
    mixed = store.filter_of(one, 0).unionByName(store.filter_of(two, 3))
    assert store.possible(one.unionByName(two), mixed).count() == 8000


def test_pages_grow_with_the_lines():
    assert [store.page_bits(n) for n in (0, 1000, 64 * 4096, 10 * 64 * 4096, 10**15)] == [0, 0, 1, 4, store.PAGE_BITS]


def test_runs_give_what_one_batch_gives(spark, sf_dir, tmp_path):
    raw, table, progress = (str(tmp_path / n) for n in ("raw", "table", "progress"))
    lines = t.log_lines(spark, sf_dir)
    for names in (("f1", "f4"), ("f9", "f0"), ("f2", "f3", "f5")):
        for name in names:
            lines.where(F.col("_file") == name).select("value").coalesce(1).write.mode("append").text(raw)
        process_new_files(spark, raw, table, progress, t.INGEST_TS, t.DEFAULT_YEAR)
    rows = spark.read.parquet(table)
    assert rows.count() == rows.select("message", "timestamp", "service", "level", "_format").distinct().count() == 1000


def test_pages_are_built_where_their_range_is(spark):
    """Lines are shuffled, not a page for every task that holds one of its lines."""
    plan = store.filter_of(store.with_keys(_lines(spark, 0, 100)), 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(") == 1 and "REPARTITION_BY_COL" in plan
