"""Registered queries: the data lake, stored documents, batches and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from loglake.functions.columns import anomaly_severity, human_size
from loglake.operators import aggregate
from loglake.operators.percentiles import exact_percentiles
from loglake.operators.enrich import enrich_logs
from loglake.operators.text import severity_counts
from loglake.plans import batch, report, states
from loglake.registry import models
from loglake.registry import sql_views as v
from loglake.registry.aggregates import _SECTIONS_SQL, _human
from loglake.registry.cleaning import CLEAN_COLUMNS
from loglake.registry.models import _SEVERITY_BINS
from loglake.registry.text_mining import _HITS
from loglake.session import scratch_path, written
from loglake.sources import lake, test_tables as t
from loglake.streaming.incremental import process_new_files


def _enriched(spark, sf_dir):
    return enrich_logs(t.logs(spark, sf_dir))


def _labelled(spark, sf_dir):
    """Records with a given label and score in the place of the model's."""
    score = (F.lit(300) - F.col("duration_ms")) / 1000
    return _enriched(spark, sf_dir).withColumns(
        {
            "is_anomaly": (F.col("level") == "CRITICAL").cast("int"),
            "anomaly_score": score,
            "anomaly_severity": anomaly_severity(score),
        }
    )


def _lake(spark, sf_dir):
    """A lake whose raw zone holds all documents as text, one folder per source."""
    root = scratch_path(spark, "lake")
    docs = t.table(spark, sf_dir, "documents").select("source", F.to_json(F.struct("doc_id", "lang", "text")).alias("value"))
    docs.write.partitionBy("source").text(lake.zone_path(root, "raw", "documents"))
    return root


def latest_batch(spark, sf_dir):
    """One batch per day, of which only the newest is read."""
    root = scratch_path(spark, "lake")
    rows = _enriched(spark, sf_dir).withColumn("run_date", F.col("date"))
    lake.store_table(rows, root, "processed", "logs", partition_by=("run_date",))
    latest = lake.read_latest(spark, root, "processed", "logs")
    return latest.select("row_id", "timestamp", "level", F.col("run_date").cast("string").alias("run_date"))


def processed(spark, sf_dir):
    """Lines processed into the lake and read back without the raw line."""
    lines = t.log_lines(spark, sf_dir)
    stored = batch.process_to_lake(lines, scratch_path(spark, "lake"), t.INGEST_TS, t.DEFAULT_YEAR, "2024-02-01")
    assert "_raw" not in stored.columns
    return stored.select(
        F.col("_file").alias("file"), F.col("_line_no").alias("line_no"), *CLEAN_COLUMNS, "hour", "time_bucket"
    )


def stored_runs(spark, sf_dir):
    """Two runs into one lake: the second leaves the first alone, and a repeated run replaces its own batch."""
    root = scratch_path(spark, "lake")
    # three runs of three passes each
    lines = written(t.log_lines(spark, sf_dir), "lines")
    for run, part in (("2024-02-01", "f2"), ("2024-02-02", "f9"), ("2024-02-01", "f9")):
        batch.process_to_lake(lines.where(F.col("_file") < part), root, t.INGEST_TS, t.DEFAULT_YEAR, run)
    table = spark.read.parquet(lake.zone_path(root, "processed", "logs"))
    newest = lake.read_latest(spark, root, "processed", "logs").agg(F.count("*").alias("latest"))
    counts = table.groupBy(F.col("run_date").cast("string").alias("run_date")).agg(F.count("*").alias("records"))
    return counts.withColumn("latest", newest.scalar())


def first_of_cluster(spark, sf_dir):
    """First message by file and line of each given cluster of the processed records."""
    rows = batch.process(t.log_lines(spark, sf_dir), t.INGEST_TS, t.DEFAULT_YEAR)
    # files and positions are two passes over the records
    rows = batch.with_row_id(written(rows.select("_file", "_block", "_line_no", "status_code", "message"), "records"))
    given = rows.select(F.col("status_code").alias("cluster"), "message", "row_id").na.drop(subset=["cluster"])
    return given.groupBy("cluster").agg(F.min_by("message", "row_id").alias("message"))


def summary_json(spark, sf_dir):
    """The counts written as a JSON document and read again."""
    root = scratch_path(spark, "lake")
    counts = aggregate.aggregate_all(_enriched(spark, sf_dir))
    lake.store_table(counts, root, "processed", "aggregations", fmt="json")
    return lake.retrieve_json(spark, root, "processed", "aggregations", "section string, key string, records bigint")


def aggregates_json(spark, sf_dir):
    """The aggregate document: one JSON text with a map per section."""
    counts = report.top_of_sections(aggregate.aggregate_all(_enriched(spark, sf_dir)))
    sections = counts.select("section", F.coalesce("key", F.lit("all")).alias("key"), F.col("records").alias("value"))
    return report.report_document(sections).withColumnRenamed("report", "aggregations")


def content_manifest(spark, sf_dir):
    docs = t.table(spark, sf_dir, "documents")
    return docs.select(
        "doc_id", F.octet_length("text").cast("bigint").alias("size_bytes"),
        human_size(F.octet_length("text")).alias("size_human"), F.md5("text").alias("md5"),
    )


#: One line per document; the same text in both engines.
_LINE = "concat(doc_id, ' ', lang, ' ', source, ' ', n_chars)"


def _documents_lake(spark, sf_dir):
    """Three documents of one file each: d0 recorded, d1 recorded twice (at first with d0's lines), d2 not recorded."""
    root = scratch_path(spark, "lake")
    docs = t.table(spark, sf_dir, "documents")

    def lines(part):
        return docs.where(F.col("doc_id") % 3 == part).orderBy("doc_id").coalesce(1).select(F.expr(_LINE).alias("value"))

    lake.store_recorded(lines(0), root, "raw", "d0", 1, fmt="text")
    lake.store_recorded(lines(0), root, "raw", "d1", 1, fmt="text")
    lake.store_recorded(lines(1), root, "raw", "d1", 2, fmt="text")
    lake.store_table(lines(2), root, "raw", "d2", fmt="text")
    return root


def zone_stats(spark, sf_dir):
    return lake.zone_stats(lake.lake_files(spark, _documents_lake(spark, sf_dir)))


def manifest(spark, sf_dir):
    files = lake.file_manifest(spark, _documents_lake(spark, sf_dir), "raw")
    return files.select("zone", F.substring_index("name", "/part-", 1).alias("name"), "size_bytes", "size_human", "md5")


def listed(spark, sf_dir):
    files = lake.list_files(spark, _documents_lake(spark, sf_dir), "raw", "*.txt")
    return files.select(F.regexp_replace("name", "/part-.*", "").alias("name"))


def metadata(spark, sf_dir):
    """Recorded, listed only, and missing."""
    return lake.file_metadata(spark, _documents_lake(spark, sf_dir), "raw", ["d0", "d1", "d2", "d9"])


def stored(spark, sf_dir):
    root = scratch_path(spark, "lake")
    docs = t.table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    return spark.read.parquet(lake.store_table(docs, root, "processed", "documents"))


def retrieved(spark, sf_dir):
    """Content of the stored files, split into its lines again."""
    files = lake.retrieve(spark, _lake(spark, sf_dir), "raw", "documents")
    lines = files.select(F.explode(F.split("content", "\n")).alias("line")).where(F.col("line") != "")
    doc = F.from_json("line", "doc_id bigint, lang string, text string").alias("doc")
    return lines.select(doc).select("doc.*")


def anomaly_results(spark, sf_dir):
    detector, features = models._fitted(spark, sf_dir)
    root = scratch_path(spark, "lake")
    columns = ("row_id", "timestamp", "message", "is_anomaly", "anomaly_score", "anomaly_severity")
    path = lake.store_table(detector.predict(features).select(*columns), root, "processed", "anomaly_results")
    return spark.read.parquet(path)


def sections(spark, sf_dir):
    return report.report_sections(_labelled(spark, sf_dir), severity_counts(t.messages(spark, sf_dir)))


def incremental(spark, sf_dir):
    """All lines written as files and taken in by one recurring run."""
    root = scratch_path(spark, "incremental")
    lines = t.log_lines(spark, sf_dir).select(F.col("_file").alias("source"), "value")
    lines.write.partitionBy("source").text(f"{root}/raw")
    process_new_files(spark, f"{root}/raw", f"{root}/table", f"{root}/progress", t.INGEST_TS, t.DEFAULT_YEAR)
    source = F.regexp_extract("_file", "source=([^/]+)", 1)
    return spark.read.parquet(f"{root}/table").select(
        source.alias("file"), "timestamp", "level", "message", "service", "status_code"
    )


_FIRST_DAY, _LAST_DAY = "2024-01-05", "2024-01-20"


def _with_states(spark, sf_dir):
    """States of three batches; the first run of the second one held other records."""
    root = scratch_path(spark, "states")
    rows = _enriched(spark, sf_dir)
    for name, part in (("b1", 0), ("b2", 0), ("b3", 2), ("b2", 1)):
        states.store_batch(rows.where(F.col("row_id") % 3 == part), root, name)
    return root


def merged_counts(spark, sf_dir):
    return states.section_counts(spark, _with_states(spark, sf_dir))


def merged_states(spark, sf_dir):
    """Sixteen days of three batches, merged from their sketches: exact figures, and whether the
    merged ones are inside their error bounds (1 % of the ranks, 4 % of the distinct values)."""
    found = states.day_range(spark, _with_states(spark, sf_dir), _FIRST_DAY, _LAST_DAY).first()
    rows = _enriched(spark, sf_dir).where(F.col("date").between(F.lit(_FIRST_DAY), F.lit(_LAST_DAY)))
    result = None
    for measure in states.MEASURES:
        value, inside = F.col(measure), []
        for p in (50, 95, 99):
            estimate = F.lit(found[f"{measure}_p{p}"])
            below, upto = F.count_if(value < estimate) / F.count(value), F.count_if(value <= estimate) / F.count(value)
            inside.append(((below <= p / 100 + 0.01) & (upto >= p / 100 - 0.01)).alias(f"p{p}_inside"))
        distinct = [
            (F.abs(F.countDistinct(c) - found[f"{c}_distinct"]) <= 0.04 * F.countDistinct(c)).alias(f"{c}_inside")
            for c in states.IDENTITIES
        ]
        row = rows.agg(
            F.lit(measure).alias("measure"), F.count("*").alias("records"), (F.count("*") == found.records).alias("records_equal"),
            *inside, *distinct,
        )
        exact = exact_percentiles(rows, [], measure, {"p95": 0.95}).select(F.round("p95", 6).alias("p95"))
        row = row.withColumn("p95", exact.scalar())
        result = row if result is None else result.unionByName(row)
    return result


def incremental_runs(spark, sf_dir):
    """The same files taken in by three runs; the first brings copies of lines that come later."""
    root = scratch_path(spark, "incremental")
    lines = written(t.log_lines(spark, sf_dir), "lines")
    for names in (("f9", "f1"), ("f0", "f4"), ("f2", "f3", "f5")):
        part = lines.where(F.col("_file").isin(*names)).select(F.col("_file").alias("source"), "value")
        part.write.mode("append").partitionBy("source").text(f"{root}/raw")
        process_new_files(spark, f"{root}/raw", f"{root}/table", f"{root}/progress", t.INGEST_TS, t.DEFAULT_YEAR)
    return spark.read.parquet(f"{root}/table").select("timestamp", "level", "message", "service", "status_code")


QUERIES = {
    "incremental_run": incremental,
    "incremental_runs": incremental_runs,
    "merged_counts": merged_counts,
    "merged_states": merged_states,
    "scan_latest_batch": latest_batch,
    "processed_projection": processed,
    "stored_runs": stored_runs,
    "cluster_first_message": first_of_cluster,
    "batch_stats": lambda s, d: batch.batch_stats(_enriched(s, d)),
    "read_summary_json": summary_json,
    "aggregates_json": aggregates_json,
    "content_manifest": content_manifest,
    "zone_stats": zone_stats,
    "file_manifest": manifest,
    "list_zone_files": listed,
    "file_metadata": metadata,
    "store_zone": stored,
    "retrieve_zone": retrieved,
    "anomaly_results": anomaly_results,
    "headline_metrics": lambda s, d: report.headline_metrics(_labelled(s, d)),
    "chart_series": lambda s, d: report.chart_series(_labelled(s, d)),
    "report_sections": sections,
    "report_document": lambda s, d: report.report_document(sections(s, d)),
}


_SCORED = "select *, (300 - duration_ms) / 1000 as score from labelled"
_HEADLINE = """select count(*) as total_records, count(*) filter (where level in ('ERROR', 'CRITICAL')) as error_count,
  round(count(*) filter (where level in ('ERROR', 'CRITICAL')) / count(*) * 100, 2) as error_rate,
  count(*) filter (where is_anomaly = 1) as anomaly_count,
  round(count(*) filter (where is_anomaly = 1) / count(*) * 100, 2) as anomaly_rate from labelled"""
_SEVERITY_ROWS = " union all ".join(
    f"select '{s}' as severity, count(*) filter (where is_anomaly = 1 and {b}) as records from ({_SCORED})"
    for s, b in _SEVERITY_BINS.items()
)


def _class(column: str) -> str:
    return f"case when {column} > 10 then 'danger' when {column} > 5 then 'warning' else 'normal' end"


_NORMAL_LEVEL = "case level when 'WARN' then 'WARNING' when 'FATAL' then 'CRITICAL' else level end as level"

_FILES_SQL = f"""select concat('d', doc_id % 3) as name, cast(sum(octet_length(encode({_LINE})) + 1) as bigint) as size_bytes,
    md5(string_agg({_LINE} || chr(10), '' order by doc_id)) as md5 from documents group by 1"""

ORACLES = {
    "incremental_run": v.with_views(
        f"select file, timestamp, {_NORMAL_LEVEL}, message, service, status_code from cleaned", "cleaned"
    ),
    "incremental_runs": v.with_views(
        f"select timestamp, {_NORMAL_LEVEL}, message, service, status_code from cleaned", "cleaned"
    ),
    "merged_counts": v.with_views(_SECTIONS_SQL, "enriched"),
    "merged_states": v.with_views(
        " union all ".join(
            f"""select '{m}' as measure, count(*) as records, true as records_equal, true as p50_inside, true as p95_inside,
                  true as p99_inside, true as message_inside, true as ip_inside, round(quantile_cont({m}, 0.95), 6) as p95
                from enriched where date between '{_FIRST_DAY}' and '{_LAST_DAY}'"""
            for m in states.MEASURES
        ),
        "enriched",
    ),
    "scan_latest_batch": v.with_views(
        """select row_id, timestamp, level, date as run_date from enriched where date = (select max(date) from enriched)""",
        "enriched",
    ),
    "processed_projection": v.with_views(
        f"""select file, line_no, {', '.join(c if c != 'level' else
            "case level when 'WARN' then 'WARNING' when 'FATAL' then 'CRITICAL' else level end as level" for c in CLEAN_COLUMNS)},
             cast(hour(timestamp) as int) as hour, case when hour(timestamp) <= 6 then 'night' when hour(timestamp) <= 12 then 'morning'
             when hour(timestamp) <= 18 then 'afternoon' else 'evening' end as time_bucket from cleaned""",
        "cleaned",
    ),
    "stored_runs": v.with_views(
        """select run_date, records, records as latest from (select count(*) as records from cleaned where file <> 'f9'),
             (select unnest(['2024-02-01', '2024-02-02']) as run_date)""",
        "cleaned",
    ),
    "cluster_first_message": v.with_views(
        """select status_code as cluster, arg_min(message, file || lpad(cast(line_no as string), 12, '0')) as message
           from cleaned where status_code is not null group by status_code""",
        "cleaned",
    ),
    "batch_stats": v.with_views(
        """select count(*) as total_records, 'row_id,timestamp,level,service,ip,method,endpoint,status_code,response_size,duration_ms,message,hour,day_of_week,date,is_business_hours,time_bucket,severity_num,message_length,status_category' as columns,
             min(timestamp) as start, max(timestamp) as "end" from enriched""",
        "enriched",
    ),
    "read_summary_json": v.with_views(_SECTIONS_SQL, "enriched"),
    "content_manifest": f"""select doc_id, octet_length(encode(text)) as size_bytes,
        {_human("octet_length(encode(text))")} as size_human, md5(text) as md5 from documents""",
    "zone_stats": f"""select zone, file_count, total_size_bytes, {_human("total_size_bytes")} as total_size_human
        from (select 'raw' as zone, count(*) as file_count, cast(sum(size_bytes) as bigint) as total_size_bytes from ({_FILES_SQL})
          union all select unnest(['processed', 'models', 'reports']), 0, 0)""",
    "file_manifest": f"select 'raw' as zone, name, size_bytes, {_human('size_bytes')} as size_human, md5 from ({_FILES_SQL})",
    "list_zone_files": f"select name from ({_FILES_SQL})",
    "file_metadata": f"""select w.name, case when w.name in ('d0', 'd1') then 'recorded' when w.name = 'd2' then 'listed' else 'missing' end as status,
          case when f.name is not null then 1 end as files, size_bytes, case when size_bytes is not null then {_human("size_bytes")} end as size_human,
          case when w.name in ('d0', 'd1') then md5 end as md5
        from (select unnest(['d0', 'd1', 'd2', 'd9']) as name) w left join ({_FILES_SQL}) f on w.name = f.name""",
    "store_zone": "select doc_id, lang, source, text from documents",
    "retrieve_zone": "select doc_id, lang, text from documents",
    "headline_metrics": v.with_views(
        f"""select *, {_class('error_rate')} as error_class, {_class('anomaly_rate')} as anomaly_class, 0 as pattern_count
            from ({_HEADLINE})""",
        "labelled",
    ),
    "chart_series": v.with_views(
        f"""select case section when 'level_distribution' then 'levels' when 'hourly_distribution' then 'hours'
              when 'daily_counts' then 'days' else 'statuses' end as chart, key as x, records as y,
              case when section = 'status_distribution' then case when key::int < 300 then 'success' when key::int < 400 then 'redirect'
                when key::int < 500 then 'client_error' else 'server_error' end end as class
            from ({_SECTIONS_SQL})
            where section in ('level_distribution', 'hourly_distribution', 'daily_counts', 'status_distribution')
            union all select 'anomaly_severity', severity, records, severity from ({_SEVERITY_ROWS}) where records > 0""",
        "labelled",
    ),
    "report_sections": v.with_views(
        f"""select 'metrics' as section, key, value from (unpivot (select total_records::double as total_records,
                error_count::double as error_count, error_rate, anomaly_count::double as anomaly_count, anomaly_rate from ({_HEADLINE}))
              on columns(*) into name key value value)
            union all select section, key, cast(records as double) from ({_SECTIONS_SQL})
              where section not in ('top_endpoints', 'top_ips', 'total_records')
            union all select section, key, cast(records as double) from (
              select *, row_number() over (partition by section order by records desc, key) as place from ({_SECTIONS_SQL})
              where section in ('top_endpoints', 'top_ips')) where place <= 10
            union all select 'anomaly_severity', severity, cast(records as double) from ({_SEVERITY_ROWS})
            union all select 'severity_words', severity, cast(sum(hits) as double) from ({_HITS}) group by severity""",
        "labelled",
    ),
}
