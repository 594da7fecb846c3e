"""Schemas of the parsed log and of the stored result and run tables."""

from __future__ import annotations

from pyspark.sql import types as T

# The nine fields of one parsed request, in export order.
RECORD_FIELDS = [
    "host",
    "timestamp",
    "log_date",
    "log_hour",
    "http_method",
    "resource_path",
    "protocol_version",
    "status_code",
    "bytes_transferred",
]

RECORD = T.StructType(
    [
        T.StructField("host", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("log_date", T.DateType()),
        T.StructField("log_hour", T.IntegerType()),
        T.StructField("http_method", T.StringType()),
        T.StructField("resource_path", T.StringType()),
        T.StructField("protocol_version", T.StringType()),
        T.StructField("status_code", T.IntegerType()),
        T.StructField("bytes_transferred", T.LongType()),
    ]
)

# Sums of 64-bit integers need more digits than one of them.
BYTES_SUM = T.DecimalType(30, 0)

# Columns of the three reports.
Q1_RESULT = T.StructType(
    [
        T.StructField("log_date", T.DateType()),
        T.StructField("status_code", T.IntegerType()),
        T.StructField("request_count", T.LongType()),
        T.StructField("total_bytes", BYTES_SUM),
    ]
)

Q2_RESULT = T.StructType(
    [
        T.StructField("resource_path", T.StringType()),
        T.StructField("request_count", T.LongType()),
        T.StructField("total_bytes", BYTES_SUM),
        T.StructField("distinct_host_count", T.LongType()),
        T.StructField("rank", T.IntegerType()),
    ]
)

Q3_RESULT = T.StructType(
    [
        T.StructField("log_date", T.DateType()),
        T.StructField("log_hour", T.IntegerType()),
        T.StructField("error_request_count", T.LongType()),
        T.StructField("total_request_count", T.LongType()),
        T.StructField("error_rate", T.DoubleType()),
        T.StructField("distinct_error_hosts", T.LongType()),
    ]
)

COUNTS_RESULT = T.StructType(
    [
        T.StructField("total_records", T.LongType()),
        T.StructField("malformed_records", T.LongType()),
    ]
)

_RUN_KEY = [
    T.StructField("run_id", T.StringType()),
    T.StructField("pipeline_name", T.StringType()),
]

# Stored tables by name. Result tables carry the run key in front of the rows.
TABLES = {
    "execution_metadata": T.StructType(
        _RUN_KEY
        + [
            T.StructField("batch_size", T.IntegerType()),
            T.StructField("total_batches", T.IntegerType()),
            T.StructField("total_records", T.LongType()),
            T.StructField("malformed_records", T.LongType()),
            T.StructField("avg_batch_size", T.DoubleType()),
            T.StructField("execution_start", T.TimestampType()),
            T.StructField("execution_end", T.TimestampType()),
            T.StructField("execution_time_ms", T.LongType()),
            T.StructField("data_file", T.StringType()),
            T.StructField("created_at", T.TimestampType()),
        ]
    ),
    "query_results": T.StructType(
        _RUN_KEY
        + [
            T.StructField("query_id", T.IntegerType()),
            T.StructField("query_name", T.StringType()),
            T.StructField("execution_timestamp", T.TimestampType()),
            T.StructField("result_json", T.StringType()),
        ]
    ),
    "daily_traffic_summary": T.StructType(_RUN_KEY + Q1_RESULT.fields),
    "top_resources": T.StructType(_RUN_KEY + Q2_RESULT.fields),
    "hourly_error_analysis": T.StructType(_RUN_KEY + Q3_RESULT.fields),
    "resource_host_state": T.StructType(
        _RUN_KEY
        + [
            T.StructField("resource_path", T.StringType()),
            T.StructField("host", T.StringType()),
            T.StructField("request_count", T.LongType()),
            T.StructField("total_bytes", BYTES_SUM),
        ]
    ),
    "hour_host_state": T.StructType(
        _RUN_KEY
        + [
            T.StructField("log_date", T.DateType()),
            T.StructField("log_hour", T.IntegerType()),
            T.StructField("host", T.StringType()),
            T.StructField("error_request_count", T.LongType()),
            T.StructField("total_request_count", T.LongType()),
        ]
    ),
    "batch_metadata": T.StructType(
        _RUN_KEY
        + [
            T.StructField("batch_id", T.IntegerType()),
            T.StructField("batch_size", T.LongType()),
            T.StructField("records_processed", T.LongType()),
            T.StructField("malformed_records", T.LongType()),
            T.StructField("execution_timestamp", T.TimestampType()),
        ]
    ),
}
