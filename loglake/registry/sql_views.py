"""Views the SQL checks build on, as common table expressions for DuckDB.

They restate the derived inputs and the operators' results independently, in another
engine's SQL. ``with_views`` puts a body behind the views it needs.
"""

from __future__ import annotations

from loglake import fixed_values as fv
from loglake.sources.test_tables import DEFAULT_YEAR, GAPS_SQL, INGEST_TS, LOGS_SQL

APACHE, SYSLOG, APPLICATION = (
    "(?s)" + p for p in (fv.APACHE_PATTERN, fv.SYSLOG_PATTERN, fv.APPLICATION_PATTERN)
)


def quoted(words) -> str:
    return ", ".join(f"'{w}'" for w in words)


def severity_case(column: str, table: dict = fv.LEVEL_SEVERITY) -> str:
    whens = " ".join(f"when '{k}' then {v}" for k, v in table.items())
    return f"case {column} {whens} else {fv.DEFAULT_SEVERITY} end"


LOG_LINES = """
select row_id, concat('f', cast(row_id % 5 as string)) as file, row_id as line_no,
 case row_id % 5
  when 0 then concat(strftime(timestamp, '%b %d %H:%M:%S'), ' prod-01 ', service, '[', cast(1000 + row_id as string), ']: [', level, '] ', message)
  when 1 then concat(strftime(timestamp, '%Y-%m-%d %H:%M:%S,%g'), ' [thread-', cast(row_id % 50 as string), '] ', rpad(level, 8, ' '), ' ', service, ' - ', message)
  when 2 then concat('{"timestamp": "', strftime(timestamp, '%Y-%m-%dT%H:%M:%S.%f'), '", "level": "', level, '", "service": "', service, '", "message": "', message, '", "duration_ms": ', cast(duration_ms as string), '}')
  when 3 then concat('# ', level, ' ', strftime(timestamp, '%Y-%m-%dT%H:%M:%S.%f'), ' ', message)
  else concat(ip, ' - - [', strftime(timestamp, '%d/%b/%Y:%H:%M:%S'), ' +0000] "', method, ' ', endpoint, ' HTTP/1.1" ', cast(status_code as string), ' ', cast(response_size as string), ' "-" "curl/8.4.0"')
  end as value
from logs
union all select row_id, 'f5', row_id, '  ' from logs where row_id % 6 = 5
"""

LINE_FORMAT = f"""case when value like '{{%' and json_valid(value) then 'json'
  when regexp_matches(value, '{APACHE}') then 'apache'
  when regexp_matches(value, '{SYSLOG}') then 'syslog'
  when regexp_matches(value, '{APPLICATION}') then 'application'
  else 'unknown' end"""


def apache_part(i: int) -> str:
    return f"regexp_extract(value, '{APACHE}', {i})"


def syslog_part(i: int) -> str:
    return f"regexp_extract(value, '{SYSLOG}', {i})"


def application_part(i: int) -> str:
    return f"regexp_extract(value, '{APPLICATION}', {i})"


def json_part(name: str, default: str = "null") -> str:
    value = f"json_extract_string(value, '$.{name}')"
    return f"case when json_exists(value, '$.{name}') then {value} else {default} end"


APACHE_STATUS = f"try_cast({apache_part(6)} as int)"
APACHE_TIME = f"try_strptime(replace({apache_part(2)}, ' +0000', ''), '%d/%b/%Y:%H:%M:%S')"
APACHE_LEVEL = (
    f"case when {APACHE_STATUS} >= 500 then 'ERROR' when {APACHE_STATUS} >= 400 then 'WARNING' else 'INFO' end"
)
APACHE_MESSAGE = f"concat({apache_part(3)}, ' ', {apache_part(4)}, ' ', cast({APACHE_STATUS} as string))"
SYSLOG_TIME = f"try_strptime(concat('{DEFAULT_YEAR} ', {syslog_part(1)}), '%Y %b %d %H:%M:%S')"
APPLICATION_TIME = f"try_strptime({application_part(1)}, '%Y-%m-%d %H:%M:%S,%g')"
JSON_TIME = f"try_cast({json_part('timestamp')} as timestamp)"
GENERIC_LEVEL = (
    f"coalesce(nullif(upper(regexp_extract(value, '{fv.GENERIC_LEVEL}', 1)), ''), '{fv.DEFAULT_LEVEL}')"
)
GENERIC_TIME = (
    f"try_strptime(replace(regexp_extract(value, '{fv.GENERIC_ISO_TIME}'), 'T', ' '), '%Y-%m-%d %H:%M:%S')"
)
NOW = f"timestamp '{INGEST_TS}'"

ROUTED = f"""
select l.*, f.fmt,
  case when f.fmt = 'unknown' then 'generic'
    when f.fmt = 'apache' then case when regexp_matches(value, '{APACHE}') then 'apache' else 'dropped' end
    when f.fmt = 'syslog' then case when regexp_matches(value, '{SYSLOG}') then 'syslog' else 'dropped' end
    when f.fmt = 'application' then case when regexp_matches(value, '{APPLICATION}') then 'application' else 'dropped' end
    else case when json_valid(value) then 'json' else 'dropped' end end as route
from nonblank l join file_formats f on l.file = f.file
"""


def _by_route(**columns: str) -> str:
    whens = " ".join(f"when '{route}' then {expression}" for route, expression in columns.items())
    return f"case route {whens} end"


PARSED = f"""
select *, case when route <> 'apache' then {severity_case('level', fv.PARSE_SEVERITY)} end as severity from (
  select file, line_no, route, value as raw,
    {_by_route(apache=APACHE_TIME, syslog=f"coalesce({SYSLOG_TIME}, {NOW})",
               application=f"coalesce({APPLICATION_TIME}, {NOW})", json=f"coalesce({JSON_TIME}, {NOW})",
               generic=f"coalesce({GENERIC_TIME}, {NOW})")} as timestamp,
    {_by_route(apache=APACHE_LEVEL, syslog=f"upper({syslog_part(5)})",
               application=f"upper({application_part(3)})",
               json=f"upper({json_part('level', quoted(['INFO']))})", generic=GENERIC_LEVEL)} as level,
    {_by_route(apache=APACHE_MESSAGE, syslog=syslog_part(6), application=application_part(5),
               json=json_part('message', "''"), generic='value')} as message,
    {_by_route(syslog=syslog_part(3), application=application_part(4),
               json=json_part('service', quoted(['unknown'])))} as service,
    {_by_route(apache=apache_part(1))} as ip,
    {_by_route(apache=apache_part(3))} as method,
    {_by_route(apache=apache_part(4))} as endpoint,
    {_by_route(apache=apache_part(5))} as protocol,
    {_by_route(apache=APACHE_STATUS, json=f"try_cast({json_part('status_code')} as int)")} as status_code,
    {_by_route(apache=f"cast({apache_part(7)} as bigint)")} as response_size,
    {_by_route(apache=apache_part(9))} as user_agent,
    {_by_route(syslog=syslog_part(2))} as hostname,
    {_by_route(syslog=f"cast({syslog_part(4)} as int)")} as pid,
    {_by_route(json=json_part('host', quoted(['unknown'])))} as host,
    {_by_route(json=f"try_cast({json_part('duration_ms')} as double)")} as duration_ms,
    {_by_route(application=application_part(2))} as thread
  from routed where route <> 'dropped')
"""

ENRICHMENT = f"""
  case upper(level) when 'WARN' then 'WARNING' when 'FATAL' then 'CRITICAL' else upper(level) end as level,
  cast(hour(timestamp) as int) as hour,
  cast(isodow(timestamp) - 1 as int) as day_of_week,
  strftime(timestamp, '%Y-%m-%d') as date,
  hour(timestamp) between 9 and 17 as is_business_hours,
  case when hour(timestamp) <= 6 then 'night' when hour(timestamp) <= 12 then 'morning'
    when hour(timestamp) <= 18 then 'afternoon' else 'evening' end as time_bucket,
  cast({severity_case("case upper(level) when 'WARN' then 'WARNING' when 'FATAL' then 'CRITICAL' else upper(level) end")} as int) as severity_num,
  cast(length(message) as int) as message_length,
  case when status_code <= 0 or status_code > 599 then null when status_code <= 199 then '1xx'
    when status_code <= 299 then '2xx' when status_code <= 399 then '3xx'
    when status_code <= 499 then '4xx' when status_code <= 599 then '5xx' end as status_category
"""

ENRICHED = f"select * exclude (level), {ENRICHMENT} from logs"

CLEANED = """
select * from (
  select *, row_number() over (partition by raw order by file, line_no) as copy from parsed)
where copy = 1 and timestamp is not null and length(message) >= 5
"""

RAW_FEATURES = r"""
select row_id, severity_num as severity, hour, day_of_week,
  cast(day_of_week >= 5 as int) as is_weekend, cast(hour < 6 or hour > 22 as int) as is_night,
  cast(hour * 60 + minute(timestamp) as int) as minute_of_day,
  sin(2 * pi() * hour / 24) as hour_sin, cos(2 * pi() * hour / 24) as hour_cos,
  message_length, cast(len(list_filter(regexp_split_to_array(message, '\s+'), lambda w: w <> '')) as int) as word_count,
  cast(regexp_matches(message, '(?i)error|fail|exception|crash|timeout|denied|refused') as int) as has_error_keyword,
  cast(regexp_matches(message, '\d') as int) as has_number,
  length(regexp_replace(message, '[^\p{Lu}]', '', 'g')) / greatest(length(message), 1) as uppercase_ratio,
  cast(length(regexp_replace(message, '[^!@#$%^&*()_+=\[\]{};:''"\\|,.<>?/~`]', '', 'g')) as int) as special_char_count,
  coalesce(status_code, 200) as status_code, cast(status_code >= 400 as int) as is_error_status,
  cast(status_code >= 500 as int) as is_server_error, response_size,
  ln(1 + response_size) as response_size_log, duration_ms,
  ln(1 + duration_ms) as duration_log, cast(duration_ms > 1000 as int) as is_slow
from enriched
"""

# Digits both engines agree on.
FEATURES = """
select * replace (round(hour_sin, 9) as hour_sin, round(hour_cos, 9) as hour_cos,
  round(uppercase_ratio, 9) as uppercase_ratio, round(response_size_log, 9) as response_size_log,
  round(duration_log, 9) as duration_log)
from raw_features
"""

# [^a-zA-Z] also turns every kind of white space into the blank the words are split at
_NOISE = f"""regexp_replace(regexp_replace(regexp_replace(regexp_replace(message,
  '{fv.TEXT_IPV4}', ' ', 'g'), '{fv.TEXT_TIME}', ' ', 'g'), '{fv.TEXT_HEX}', ' ', 'g'),
  '{fv.TEXT_PATH}', ' ', 'g')"""
CLEAN_TEXT = rf"lower(regexp_replace({_NOISE}, '[^a-zA-Z\t-\r\x1c-\x1f\x{{85}}\p{{Z}}]', ' ', 'g'))"
WORDS = f"""list_filter(string_split(lower(regexp_replace({_NOISE}, '[^a-zA-Z]+', ' ', 'g')), ' '),
  lambda w: length(w) > 2 and w not in ({quoted(fv.LOG_STOP_WORDS)}))"""

TERM_LIST = f"""list_filter(regexp_extract_all(lower(message), '{fv.TERM_PATTERN}'),
  lambda w: w not in ({quoted(fv.TERM_STOP_WORDS)}))"""

VIEWS: dict[str, tuple[str, tuple[str, ...]]] = {
    "logs": (LOGS_SQL.format(events="events"), ()),
    "gaps": (GAPS_SQL.format(logs="logs"), ("logs",)),
    "log_lines": (LOG_LINES, ("logs",)),
    "doubled": (
        "select * from log_lines union all select row_id, 'f9', line_no, value from log_lines where row_id % 50 = 0",
        ("log_lines",),
    ),
    "nonblank": (
        r"select row_id, file, line_no, regexp_replace(value, '^\s+|\s+$', '', 'g') as value from doubled "
        r"where regexp_replace(value, '^\s+|\s+$', '', 'g') <> ''",
        ("doubled",),
    ),
    "file_formats": (
        f"select file, {LINE_FORMAT} as fmt from "
        "(select file, arg_min(value, line_no) as value from nonblank group by file)",
        ("nonblank",),
    ),
    "routed": (ROUTED, ("nonblank", "file_formats")),
    "parsed": (PARSED, ("routed",)),
    "cleaned": (CLEANED, ("parsed",)),
    "enriched": (ENRICHED, ("logs",)),
    "raw_features": (RAW_FEATURES, ("enriched",)),
    "features": (FEATURES, ("raw_features",)),
    "texts": ("select doc_id as row_id, text as message from documents", ()),
    "words": (f"select row_id, {WORDS} as words from texts where length(message) > 0", ("texts",)),
    "tokens": ("select row_id, unnest(words) as token from words", ("words",)),
    "token_counts": ("select token, count(*) as count from tokens group by token", ("tokens",)),
    "log_words": (
        f"select row_id, {WORDS} as words from logs where length(message) > 0", ("logs",)
    ),
    "log_tokens": ("select row_id, unnest(words) as token from log_words", ("log_words",)),
    "log_token_counts": ("select token, count(*) as count from log_tokens group by token", ("log_tokens",)),
    "terms": (
        f"""select row_id, message, unnest(list_concat(words,
              list_transform(range(0, greatest(len(words) - 1, 0)), lambda i: concat(words[i + 1], ' ', words[i + 2])))) as term
            from (select row_id, message, {TERM_LIST} as words from logs where length(message) > 0)""",
        ("logs",),
    ),
    "vocabulary": (
        """select term, df, corpus_count, ln((1 + total) / (1 + df)) + 1 as idf from (
             select term, count(distinct row_id) as df, count(*) as corpus_count,
               (select count(*) from logs where length(message) > 0) as total
             from terms group by term)
           where df >= 2 and df <= 0.95 * total order by corpus_count desc, term limit 5000""",
        ("terms", "logs"),
    ),
    "weights": (
        """select row_id, message, term, w / sqrt(sum(w * w) over (partition by row_id)) as weight from (
             select t.row_id, t.message, t.term, count(*) * any_value(v.idf) as w
             from terms t join vocabulary v on t.term = v.term group by t.row_id, t.message, t.term)""",
        ("terms", "vocabulary"),
    ),
    "labelled": (
        "select *, cast(level = 'CRITICAL' as int) as is_anomaly from enriched", ("enriched",)
    ),
}


def with_views(body: str, *names: str) -> str:
    needed: list[str] = []

    def add(name: str) -> None:
        if name not in needed:
            for dependency in VIEWS[name][1]:
                add(dependency)
            needed.append(name)

    for name in names:
        add(name)
    ctes = ",\n".join(f"{n} as ({VIEWS[n][0]})" for n in needed)
    return f"with {ctes}\n{body}" if needed else body
