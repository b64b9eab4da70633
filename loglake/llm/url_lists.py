"""Temporal join of captures with dated URL lists.

Dated additions and removals of a list become validity intervals. Every capture is joined
as of its fetch time with the entries active then, by the domains above its host and the
path prefixes of its address. The join is an equality on (key, time bucket), so a host
that holds a third of all captures is spread over time and its partitions can be split;
no task sees a whole host.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loglake.session import written

BUCKET_DAYS = 32
_ADDRESS = r"^[A-Za-z][A-Za-z0-9+.-]*://"
HOST = _ADDRESS + r"(?:[^/?#@]*@)?([^/?#:]*)"
PATH = _ADDRESS + r"[^/?#]*([^?#]*)"


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, HOST, 1))


def path(url: Column) -> Column:
    return F.regexp_extract(url, PATH, 1)


def bucket(day: Column) -> Column:
    return F.floor(F.unix_date(day) / BUCKET_DAYS).cast("int")


def intervals(entries: DataFrame) -> DataFrame:
    """``entries(list, pattern, day, action)`` as rows of list, pattern, from_day and to_day.

    A pattern is a domain (``example.com``, with all below it) or a domain with a path
    prefix (``example.com/ads``, up to a slash). It is active from an ``add`` until the next
    dated action, exclusive; without one ``to_day`` is null. Of actions of one day the
    addition holds. Repeated rows say the same again; rows with a null are left out.
    """
    clean = entries.select("list", "pattern", "day", "action").na.drop().distinct()
    daily = clean.groupBy("list", "pattern", "day").agg(F.max(F.col("action") == "add").alias("adds"))
    after = F.lead("day").over(Window.partitionBy("list", "pattern").orderBy("day"))
    spans = daily.withColumn("to_day", after).where("adds")
    return spans.select("list", F.trim(F.lower("pattern"), F.lit("/")).alias("pattern"), F.col("day").alias("from_day"), "to_day")


def keys(url: Column, labels: int, segments: int) -> Column:
    """Domains above the host and path prefixes, as deep as any pattern goes."""
    parts = F.split(host(url), r"\.")
    count = F.size(parts)
    domains = F.transform(
        F.sequence(F.lit(1), F.least(count, F.lit(labels))), lambda n: F.array_join(F.slice(parts, count - n + 1, n), ".")
    )
    steps = F.filter(F.split(F.lower(path(url)), "/"), lambda s: s != "")
    prefixes = F.transform(
        F.when(F.size(steps) > 0, F.sequence(F.lit(1), F.least(F.size(steps), F.lit(segments)))).otherwise(F.array().cast("array<int>")),
        lambda n: F.concat(F.lit("/"), F.array_join(F.slice(steps, F.lit(1), n), "/")),
    )
    if segments <= 0:
        return domains
    deep = F.flatten(F.transform(domains, lambda d: F.transform(prefixes, lambda p: F.concat(d, p))))
    return F.concat(domains, deep)


def evaluate(captures: DataFrame, entries: DataFrame, url: str = "url", day: str = "day") -> DataFrame:
    """Every row of ``captures`` with blocked, entries (active entries that match), lists
    (comma-joined, in order) and listed_since (the latest beginning of a match).

    Rows without a readable address or day match nothing; repeated rows are judged alike;
    an empty list or table blocks nothing. The four result columns replace columns of the same name.
    """
    active = written(intervals(entries), "intervals")
    depth = active.agg(
        F.max(F.size(F.split(F.substring_index("pattern", "/", 1), r"\."))),
        F.max(F.size(F.split("pattern", "/")) - 1),
        F.min("from_day"),
    ).first()
    ends = captures.agg(F.max(F.col(day)).alias("last")).first()
    results = ["blocked", "entries", "lists", "listed_since"]
    kept = [c for c in captures.columns if c not in results]
    if depth[0] is None or ends[0] is None:
        nothing = {"blocked": F.lit(False), "entries": F.lit(0).cast("bigint"), "lists": F.lit(""), "listed_since": F.lit(None).cast("date")}
        return captures.select(*kept).withColumns(nothing)
    until = F.coalesce(F.date_sub("to_day", 1), F.lit(ends[0]))
    reach = active.where(F.col("from_day") <= until).withColumn(
        "bucket", F.explode(F.sequence(bucket(F.col("from_day")), bucket(until)))
    )
    asked = captures.select(F.col(url).alias("_url"), F.col(day).alias("_day")).na.drop().distinct()
    asked = asked.where(host(F.col("_url")) != "").withColumns(
        {"pattern": F.explode(keys(F.col("_url"), depth[0], depth[1])), "bucket": bucket(F.col("_day"))}
    )
    hits = asked.join(reach, ["pattern", "bucket"]).where(
        (F.col("_day") >= F.col("from_day")) & (F.col("to_day").isNull() | (F.col("_day") < F.col("to_day")))
    )
    found = hits.groupBy("_url", "_day").agg(
        F.count("*").alias("entries"),
        F.array_join(F.array_sort(F.collect_set("list")), ",").alias("lists"),
        F.max("from_day").alias("listed_since"),
    )
    rows = captures.select(*kept).alias("c")
    same = (F.col(f"c.{url}") == F.col("f._url")) & (F.col(f"c.{day}") == F.col("f._day"))
    return rows.join(found.alias("f"), same, "left").select(
        *(f"c.{c}" for c in kept),
        F.col("f.entries").isNotNull().alias("blocked"),
        F.coalesce("f.entries", F.lit(0)).cast("bigint").alias("entries"),
        F.coalesce("f.lists", F.lit("")).alias("lists"),
        "f.listed_since",
    )
