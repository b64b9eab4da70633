"""The unified log record: one wide row for all line formats, absent = NULL."""

from pyspark.sql import types as T

LINE_SCHEMA = T.StructType(
    [
        T.StructField("_file", T.StringType()),
        T.StructField("_block", T.LongType()),
        T.StructField("_line_no", T.LongType()),
        T.StructField("value", T.StringType()),
    ]
)

RECORD_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("level", T.StringType()),
        T.StructField("severity", T.IntegerType()),
        T.StructField("message", T.StringType()),
        T.StructField("service", T.StringType()),
        T.StructField("ip", T.StringType()),
        T.StructField("method", T.StringType()),
        T.StructField("endpoint", T.StringType()),
        T.StructField("protocol", T.StringType()),
        T.StructField("status_code", T.IntegerType()),
        T.StructField("response_size", T.LongType()),
        T.StructField("referrer", T.StringType()),
        T.StructField("user_agent", T.StringType()),
        T.StructField("hostname", T.StringType()),
        T.StructField("pid", T.IntegerType()),
        T.StructField("host", T.StringType()),
        T.StructField("request_id", T.StringType()),
        T.StructField("duration_ms", T.DoubleType()),
        T.StructField("error_trace", T.StringType()),
        T.StructField("anomaly_hint", T.BooleanType()),
        T.StructField("thread", T.StringType()),
        T.StructField("_format", T.StringType()),
        T.StructField("_raw", T.StringType()),
        T.StructField("_file", T.StringType()),
        T.StructField("_block", T.LongType()),
        T.StructField("_line_no", T.LongType()),
    ]
)

# Where a record stood in the input; the first one wins wherever order matters.
POSITION = ("_file", "_block", "_line_no")
