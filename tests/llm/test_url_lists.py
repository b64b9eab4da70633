import datetime as dt

import oracle
from loglake.llm import url_lists
from loglake.llm.queries import op6_url_lists as op6


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def test_same_rows_as_sql(spark, small_dir):
    con = oracle.connect(small_dir)
    assert oracle.difference(spark, small_dir, op6.op6_url_lists, op6.SQL, con) is None


def test_entries_hold_from_their_day_to_the_next_action(spark):
    entries = [
        ("spam", "bad.example", day(10), "add"), ("spam", "bad.example", day(20), "remove"),
        ("spam", "bad.example", day(20), "remove"), ("spam", "bad.example", day(300), "add"),
        ("ads", "Example.org/Ads/", day(5), "add"), ("ads", None, day(5), "add"), ("ads", "x.y", None, "add"),
        ("both", "same.day", day(7), "remove"), ("both", "same.day", day(7), "add"),
    ]
    rows = [
        (1, "http://bad.example/x", day(9)), (2, "http://bad.example/x", day(10)), (3, "https://a.BAD.example:80?q", day(19)),
        (4, "http://u@bad.example", day(20)), (5, "http://bad.example", day(900)), (6, "http://notbad.example", day(12)),
        (7, "http://www.example.org/ads/x.html#a", day(6)), (8, "http://example.org/adsense", day(6)), (9, "http://example.org/ads", day(6)),
        (10, None, day(6)), (11, "http://bad.example", None), (12, "no address", day(12)), (13, "http://same.day", day(7)),
        (2, "http://bad.example/x", day(10)), (14, "http://" + "a." * 50 + "bad.example/" + "p/" * 3000, day(12)),
    ]
    captures = spark.createDataFrame([(*r, "b", "k", 1) for r in rows], "id int, url string, day date, blocked string, pattern string, bucket int")
    listed = spark.createDataFrame(entries, "list string, pattern string, day date, action string")
    got = url_lists.evaluate(captures, listed)
    assert sorted(got.columns) == sorted(["id", "url", "day", "blocked", "pattern", "bucket", "entries", "lists", "listed_since"])
    out = got.collect()
    assert len(out) == len(rows)
    assert sorted(r.id for r in out if r.blocked) == [2, 2, 3, 5, 7, 9, 13, 14]
    assert {r.id: r.listed_since for r in out if r.blocked}[5] == day(300)
    assert url_lists.evaluate(captures, listed.limit(0)).where("blocked").isEmpty()
    assert url_lists.evaluate(captures.limit(0), listed).isEmpty()
