"""op6: every page against lists of dated entries. The test tables hold neither fetch times nor
lists, so both follow from page ids and from the hosts and directories of the pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loglake.llm import url_lists

CAPTURES = "select page_id, url, date_add(date '2024-01-01', cast((page_id * 7919) % 900 as int)) as day from {pages}"

# The same text serves Spark and the SQL check, but for the reading of a hexadecimal number.
ENTRIES = """
with addresses as (
  select distinct lower(regexp_extract(url, '^[A-Za-z]+://([^/?#:]*)', 1)) as host,
    regexp_extract(url, '^[A-Za-z]+://[^/?#]*/([^/?#]+)', 1) as dir from {pages}),
patterns as (
  select regexp_extract(host, '([^.]+[.][^.]+[.][^.]+)$', 1) as pattern from addresses
  union select concat(host, '/', dir) as pattern from addresses where dir <> ''),
numbered as (select pattern, HEX as h from patterns where pattern <> ''),
listed as (
  select case h % 3 when 0 then 'adult' when 1 then 'malware' else 'spam' end as list, pattern, h, h % 500 as a
  from numbered where h % 4 < 2)
select list, pattern, date_add(date '2024-01-01', cast(a as int)) as day, 'add' as action from listed
union all
select list, pattern, date_add(date '2024-01-01', cast(a + 30 + h % 90 as int)) as day, 'remove' as action from listed
union all
select list, pattern, date_add(date '2024-01-01', cast(a + 165 + h % 90 as int)) as day, 'add' as action
from listed where h % 8 < 2
"""


def op6_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    entries = spark.sql(ENTRIES.replace("HEX", "cast(conv(substring(md5(pattern), 1, 6), 16, 10) as bigint)"), pages=pages)
    return url_lists.evaluate(spark.sql(CAPTURES, pages=pages), entries)


_DUCK_ENTRIES = ENTRIES.replace("HEX", "cast('0x' || substring(md5(pattern), 1, 6) as bigint)").replace("{pages}", "pages")
SQL = f"""
with captures as ({CAPTURES.replace('{pages}', 'pages')}),
entries as ({_DUCK_ENTRIES}),
spans as (
  select *, lead(cast(day as date)) over (partition by list, pattern order by day) as to_day from entries),
places as (
  select *, lower(regexp_extract(url, '^[A-Za-z]+://([^/?#:]*)', 1)) as host,
    lower(regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1)) as path from captures),
hits as (
  select page_id, p.url, p.day, count(*) as n, string_agg(distinct list, ',' order by list) as lists, max(s.day) as since
  from places p join spans s on s.action = 'add' and p.day >= s.day and (s.to_day is null or p.day < s.to_day)
    and case when contains(s.pattern, '/') then
        starts_with(concat(host, path, '/'), concat(s.pattern, '/'))
        or contains(concat('.', host, path, '/'), concat('.', s.pattern, '/'))
      else host = s.pattern or ends_with(host, concat('.', s.pattern)) end
  group by all)
select c.page_id, c.url, cast(c.day as date) as day, h.page_id is not null as blocked,
  cast(coalesce(n, 0) as bigint) as entries, coalesce(lists, '') as lists, cast(since as date) as listed_since
from captures c left join hits h on c.page_id = h.page_id and c.url = h.url and c.day = h.day
"""

QUERIES = {"op6_url_lists": op6_url_lists}
ORACLES = {"op6_url_lists": SQL}
