"""Explicit schemas for the record model (no inference anywhere)."""

from __future__ import annotations

from pyspark.sql import types as T


def audit_fields() -> list[T.StructField]:
    """Columns every entity carries: key plus three audit instants."""
    return [
        T.StructField("id", T.LongType(), False),
        T.StructField("created_at", T.TimestampNTZType(), False),
        T.StructField("updated_at", T.TimestampNTZType(), False),
        T.StructField("deleted_at", T.TimestampNTZType(), True),
    ]


ENTITY = T.StructType(
    [audit_fields()[0],
     T.StructField("name", T.StringType(), False),
     T.StructField("description", T.StringType(), False),
     *audit_fields()[1:]]
)

META = T.StructType(
    [
        T.StructField("result", T.StringType(), False),
        T.StructField("error_code", T.StringType(), True),
        T.StructField("message", T.StringType(), True),
    ]
)

PAYLOAD = T.StructType(
    [
        T.StructField("id", T.LongType(), True),
        T.StructField("name", T.StringType(), True),
        T.StructField("description", T.StringType(), True),
    ]
)

RESPONSE = T.StructType([T.StructField("meta", META, False), T.StructField("data", PAYLOAD, True)])

ERROR_CATALOGUE = T.StructType(
    [
        T.StructField("error_type", T.StringType(), False),
        T.StructField("status", T.IntegerType(), False),
        T.StructField("code", T.StringType(), False),
        T.StructField("message", T.StringType(), False),
    ]
)

REQUEST = T.StructType([T.StructField("request_id", T.LongType(), False), T.StructField("raw_id", T.StringType(), True)])

CHANGE = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("event_id", T.LongType(), False),
        T.StructField("ts", T.TimestampNTZType(), False),
        T.StructField("op", T.StringType(), False),
        T.StructField("description", T.StringType(), True),
    ]
)

STREAM_RECORD = T.StructType(
    [
        T.StructField("key", T.BinaryType(), True),
        T.StructField("value", T.BinaryType(), True),
        T.StructField("topic", T.StringType(), True),
        T.StructField("partition", T.IntegerType(), True),
        T.StructField("offset", T.LongType(), True),
        T.StructField("timestamp", T.TimestampType(), True),
    ]
)

RUN_LOG = T.StructType(
    [
        T.StructField("run_id", T.LongType(), False),
        T.StructField("job_name", T.StringType(), False),
        T.StructField("start_ms", T.LongType(), False),
        T.StructField("end_ms", T.LongType(), False),
    ]
)

STEP_LOG = T.StructType(
    [
        T.StructField("step_id", T.LongType(), False),
        T.StructField("event_id", T.LongType(), False),
        T.StructField("ts", T.TimestampNTZType(), False),
        T.StructField("failed", T.BooleanType(), False),
        T.StructField("message", T.StringType(), True),
    ]
)
