"""Schemas of raw events. Payloads stay text until a job needs their fields. The names of the fields."""

from __future__ import annotations

from pyspark.sql import types as T

REST_METADATA = T.StructType(
    [
        T.StructField("request_started_at_ns", T.LongType()),
        T.StructField("request_ended_at_ns", T.LongType()),
        T.StructField("method", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("params", T.MapType(T.StringType(), T.StringType())),
        T.StructField("status", T.IntegerType()),
        T.StructField("attempt", T.IntegerType()),
        T.StructField("rate_limit_headers", T.MapType(T.StringType(), T.StringType())),
        T.StructField("requested_interval_ns", T.LongType()),
        T.StructField("effective_interval_ns", T.LongType()),
    ]
)

_TEXT = ["exchange", "market", "instrument_key", "wire_symbol", "logical_stream", "native_channel", "transport"]

ENVELOPE = T.StructType(
    [T.StructField("schema_version", T.IntegerType())]
    + [T.StructField(n, T.StringType()) for n in _TEXT]
    + [
        T.StructField("event_time_ns", T.LongType()),
        T.StructField("event_time_source", T.StringType()),
        T.StructField("received_at_ns", T.LongType()),
        T.StructField("monotonic_ns", T.LongType()),
        T.StructField("worker_instance_id", T.StringType()),
        T.StructField("connection_id", T.StringType()),
        T.StructField("connection_generation", T.LongType()),
        T.StructField("writer_sequence", T.LongType()),
        T.StructField("egress_id", T.StringType()),
        T.StructField("config_sha256", T.StringType()),
        T.StructField("integrity_mode", T.StringType()),
        T.StructField("coverage", T.StringType()),
        T.StructField("rest_metadata", REST_METADATA),
        T.StructField("payload", T.StringType()),
    ]
)

#: Where a record comes from; added when it is read.
LOCATOR = ["manifest_sha256", "record_index"]
#: What tells the parts of raw storage apart.
PART_KEYS = ["exchange", "market", "instrument_key", "logical_stream", "worker_instance_id", "config_sha256"]
