"""Formats, word lists and lookup tables that decide results.

They are plain data. Everything that acts on them lives in the other modules.
"""

# --- fixed values: line patterns (anchored at the start, open at the end) ---
APACHE_PATTERN = r'^(\S+) \S+ \S+ \[([^\]]+)\] "(\S+) (\S+) (\S+)" (\d+) (\d+) "([^"]*)" "([^"]*)"'
SYSLOG_PATTERN = r"^(\w+ \d+ \d+:\d+:\d+) (\S+) (\S+)\[(\d+)\]: \[(\w+)\] (.*)"
APPLICATION_PATTERN = r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2},\d{3}) \[([^\]]+)\] (\S+)\s+(\S+) - (.*)"
GENERIC_ISO_TIME = r"\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}"
GENERIC_APACHE_TIME = r"\d{2}/\w{3}/\d{4}:\d{2}:\d{2}:\d{2}"
GENERIC_LEVEL = r"(?i)\b(DEBUG|INFO|WARN(?:ING)?|ERROR|CRITICAL|FATAL)\b"

# --- fixed values: white space, as str.strip and str.split see it ---
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
WHITESPACE_CLASS = r"\t-\r\x1c-\x1f\x85\p{Z}"

# --- fixed values: levels ---
LEVELS = ("DEBUG", "INFO", "WARNING", "ERROR", "CRITICAL")
ERROR_LEVELS = ("ERROR", "CRITICAL")
PARSE_SEVERITY = {
    "DEBUG": 0, "INFO": 1, "WARNING": 2, "WARN": 2, "ERROR": 3, "CRITICAL": 4, "FATAL": 4,
}
LEVEL_SEVERITY = {"DEBUG": 0, "INFO": 1, "WARNING": 2, "ERROR": 3, "CRITICAL": 4}
LEVEL_ALIASES = {"WARN": "WARNING", "FATAL": "CRITICAL"}
DEFAULT_LEVEL = "INFO"
DEFAULT_SEVERITY = 1

# --- fixed values: JSON lines ---
JSON_DEFAULT_NAME = "unknown"

# --- fixed values: binned columns ---
TIME_BUCKETS = ("night", "morning", "afternoon", "evening")
STATUS_CATEGORIES = ("1xx", "2xx", "3xx", "4xx", "5xx")
ANOMALY_SEVERITIES = ("critical", "high", "medium", "normal")
SIZE_UNITS = ("B", "KB", "MB", "GB", "TB")

# --- fixed values: message features ---
ERROR_KEYWORD_PATTERN = "(?i)error|fail|exception|crash|timeout|denied|refused"
SPECIAL_CHARACTERS = r"""[!@#$%^&*()_+=\[\]{};:'"\\|,.<>?/~`]"""
NUMERIC_FEATURES = (
    "severity", "hour", "day_of_week", "is_weekend", "is_night", "minute_of_day", "hour_sin",
    "hour_cos", "message_length", "word_count", "has_error_keyword", "has_number",
    "uppercase_ratio", "special_char_count", "status_code", "is_error_status",
    "is_server_error", "response_size", "response_size_log", "duration_ms", "duration_log",
    "is_slow",
)

# --- fixed values: text mining ---
TEXT_IPV4 = r"\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}"
TEXT_TIME = r"\d{4}[-/]\d{2}[-/]\d{2}[T ]\d{2}:\d{2}:\d{2}"
TEXT_HEX = r"0x[0-9a-fA-F]+"
TEXT_PATH = r"[/\\][\p{L}\p{N}_./\\]+"
LOG_STOP_WORDS = (
    "log", "info", "debug", "warn", "error", "http", "https", "get", "post", "put", "delete",
    "null", "none", "true", "false", "com", "org", "net", "www", "localhost", "server", "client",
)
SEVERITY_KEYWORDS = {
    "critical": ("crash", "panic", "fatal", "corruption", "breach", "exhausted", "failure", "killed"),
    "high": ("error", "exception", "failed", "timeout", "refused", "denied", "unauthorized", "unreachable"),
    "medium": ("warning", "slow", "deprecated", "approaching", "nearing", "exceeded", "retry"),
    "low": ("info", "success", "completed", "started", "connected", "loaded", "healthy"),
}

# --- fixed values: lines of the text summary ---
INSIGHT_CRITICAL = "[!] %d messages contain CRITICAL severity indicators"
INSIGHT_HIGH = "[!] %d messages contain HIGH severity indicators"
INSIGHT_TERMS = "Most frequent terms: %s"
INSIGHT_RICHNESS = "Vocabulary richness: %.1f%%"

# --- fixed values: message patterns ---
TERM_PATTERN = r"\b[a-zA-Z_][a-zA-Z0-9_]*\b"

# --- fixed values: data lake ---
ZONES = ("raw", "processed", "models", "reports")
# The English stop words that ship with Spark, without the contractions: those hold an
# apostrophe, which the term pattern never matches.
TERM_STOP_WORDS = tuple(
    """
    i me my myself we our ours ourselves you your yours yourself yourselves he him his himself
    she her hers herself it its itself they them their theirs themselves what which who whom
    this that these those am is are was were be been being have has had having do does did
    doing a an the and but if or because as until while of at by for with about against between
    into through during before after above below to from up down in out on off over under again
    further then once here there when where why how all any both each few more most other some
    such no nor not only own same so than too very s t can will just don should now cannot could
    ought would
    """.split()
)
