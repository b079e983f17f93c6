"""Rules for raw events: good rows, and quarantined rows with their reasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import is_json

# Streams of a whole market, and streams of order books.
MARKET_STREAMS = ["instrument", "status", "insurance_fund"]
BOOK_STREAMS = ["book_deep_snapshot", "book_live", "book_live_bootstrap"]


def envelope_rules() -> dict[str, Column]:
    """Reason -> what breaks it."""
    c = F.col
    control = c("logical_stream") == "_control"
    rest = c("transport") == "rest"
    meta = c("rest_metadata")
    odd = lambda a, b: c(a).isNull() != c(b).isNull()
    return {
        "market_missing": c("market").isNull() & ~control,
        "instrument_unpaired": odd("instrument_key", "wire_symbol"),
        "instrument_missing": ~control & ~c("logical_stream").isin(MARKET_STREAMS) & c("instrument_key").isNull(),
        "channel_missing": c("native_channel").isNull() & ~control,
        "event_time_unpaired": odd("event_time_ns", "event_time_source"),
        "rest_metadata_missing": rest & meta.isNull(),
        "rest_metadata_unexpected": ~rest & meta.isNotNull(),
        "internal_transport": (c("transport") == "internal") & ~control,
        "bootstrap_transport": (c("logical_stream") == "book_live_bootstrap") & ~rest,
        "integrity_scope": c("integrity_mode").isNotNull() & ~c("logical_stream").isin(BOOK_STREAMS),
        "payload_not_json": ~is_json("payload"),
    }


def rest_rules() -> dict[str, Column]:
    m = F.col("rest_metadata")
    asked, got = m["requested_interval_ns"], m["effective_interval_ns"]
    return {
        "request_times": m["request_ended_at_ns"] < m["request_started_at_ns"],
        "intervals_unpaired": m.isNotNull() & (asked.isNull() != got.isNull()),
        "interval_shrunk": got < asked,
    }


def source_rules() -> dict[str, Column]:
    """Connections belong to web sockets and bootstraps, egresses to all but internal records."""
    c = F.col
    connected, egress = c("connection_id").isNotNull(), c("egress_id").isNotNull()
    internal = c("transport") == "internal"
    needs = (c("transport") == "websocket") | (c("logical_stream") == "book_live_bootstrap")
    return {
        "connection_unpaired": connected != c("connection_generation").isNotNull(),
        "source_internal": internal & (connected | egress),
        "source_connection": ~internal & needs & ~(connected & egress),
        "source_rest": ~internal & ~needs & (connected | ~egress),
    }


def checked(rows: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Adds `reasons`, the names of all broken rules; a rule whose inputs are null is not broken."""
    return rows.withColumn("reasons", F.array_compact(F.array(*[F.when(F.coalesce(broken, F.lit(False)), F.lit(name)) for name, broken in rules.items()])))


def split(rows: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Good rows, and quarantined rows with reasons."""
    marked = checked(rows, rules)
    return marked.filter(F.size("reasons") == 0).drop("reasons"), marked.filter(F.size("reasons") > 0)


def research_valid(rows: DataFrame) -> DataFrame:
    """Rows fit for research: all whose integrity is not known to be broken."""
    return rows.filter(F.col("integrity_mode").isNull() | (F.col("integrity_mode") != "invalid"))
