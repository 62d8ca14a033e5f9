"""Schemas of every input and output table."""

from pyspark.sql import types as T

from logweir.fixed_values import METADATA_FIELDS, QUERY_LOG_FIELDS, USAGE_FIELDS

CORRUPT = "_corrupt_record"


def _strings(names):
    return [T.StructField(name, T.StringType()) for name in names]


# Input of the query-log job. Declaring the event time as a timestamp makes Spark validate it
# while parsing, so an unreadable time lands in the corrupt-record column.
QUERY_LOG_IN = T.StructType(
    [
        T.StructField("@timestamp", T.TimestampType()),
        T.StructField("log", T.StringType()),
        T.StructField(CORRUPT, T.StringType()),
    ]
)

USAGE_EVENT = T.StructType(_strings(USAGE_FIELDS))
METADATA_EVENT = T.StructType(_strings(METADATA_FIELDS))

_ENVELOPE = [
    T.StructField("MetadataLogId", T.StringType()),
    T.StructField("MetadataLogType", T.StringType()),
    T.StructField("MetadataLogTimeGenerated", T.TimestampType()),
    T.StructField("MetadataLogDate", T.LongType()),
    T.StructField("TimeGenerated", T.StringType()),
    T.StructField("MetadataLogGuid", T.LongType()),
    T.StructField("MetadataLogFileName", T.StringType()),
    T.StructField("TenantId", T.StringType()),
    T.StructField("Type", T.StringType()),
]

QUERY_LOG_OUT = T.StructType(_strings(QUERY_LOG_FIELDS) + _ENVELOPE)
METADATA_GOLD = T.StructType(_strings(METADATA_FIELDS) + _ENVELOPE)

USAGE_BRONZE = T.StructType(
    _strings(USAGE_FIELDS)
    + [
        T.StructField("TimeGenerated", T.TimestampType()),
        T.StructField("input_file_path", T.StringType()),
    ]
)

USAGE_SILVER = T.StructType(
    _strings(USAGE_FIELDS)
    + [f for f in _ENVELOPE if f.name not in ("MetadataLogId", "MetadataLogGuid")]
)

USAGE_GOLD = T.StructType(
    USAGE_SILVER.fields
    + [
        T.StructField("MetadataLogId", T.StringType()),
        T.StructField("MetadataLogGuid", T.LongType()),
        T.StructField("filename", T.StringType()),
        T.StructField("size_in_kb", T.StringType()),
    ]
)

INGEST_CHECKPOINT = T.StructType(
    [
        T.StructField("file_date", T.StringType()),
        T.StructField("last_timegenerated", T.TimestampType()),
    ]
)

# Rows the query-log job could not use, with the line as it came.
QUERY_LOG_QUARANTINE = T.StructType(
    [
        T.StructField("raw", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("MetadataLogFileName", T.StringType()),
        T.StructField("content_id", T.StringType()),
    ]
)

# Messages whose body is missing or is not one JSON object.
MESSAGE_QUARANTINE = T.StructType(
    [T.StructField("body", T.BinaryType()), T.StructField("TimeGenerated", T.TimestampType())]
)

WATCHLIST = T.StructType(
    [
        T.StructField("Model", T.StringType()),
        T.StructField("URL", T.StringType()),
        T.StructField("Target Price", T.IntegerType()),
    ]
)
