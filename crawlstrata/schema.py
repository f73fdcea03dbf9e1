"""Explicit schemas of the tables the jobs exchange."""

from pyspark.sql import types as T

# One row per record of an archive file, before the HTTP message is split.
RECORDS = T.StructType([
    T.StructField("source_file", T.StringType()),
    T.StructField("source_offset", T.LongType()),
    T.StructField("format", T.StringType()),
    T.StructField("record_type", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("ip", T.StringType()),
    T.StructField("capture_date", T.StringType()),
    T.StructField("content_type", T.StringType()),
    T.StructField("payload_length", T.LongType()),
    T.StructField("headers", T.MapType(T.StringType(), T.StringType())),
    T.StructField("payload", T.BinaryType()),
    T.StructField("error", T.StringType()),
])

CAPTURES = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("url_key", T.StringType()),
    T.StructField("capture_ts", T.TimestampType()),
    T.StructField("capture_date", T.StringType()),
    T.StructField("content_type", T.StringType()),
    T.StructField("record_type", T.StringType()),
    T.StructField("content", T.BinaryType()),
    T.StructField("content_length", T.LongType()),
    T.StructField("content_sha", T.StringType()),
    T.StructField("ip", T.StringType()),
    T.StructField("http_status", T.IntegerType()),
    T.StructField("http_headers", T.MapType(T.StringType(), T.StringType())),
    T.StructField("headers", T.MapType(T.StringType(), T.StringType())),
    T.StructField("source_file", T.StringType()),
    T.StructField("source_offset", T.LongType()),
    T.StructField("error", T.StringType()),
])

ADJACENCY = T.StructType([
    T.StructField("src", T.LongType()),
    T.StructField("dst", T.ArrayType(T.LongType())),
])

PREFIXES = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("prefix", T.StringType()),
])
