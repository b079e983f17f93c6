"""Derivative and quality windows, and the expectations behind them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import HOUR, floor_to
from .ordered import carried
from .trades import expectation_grid

# Kinds of control events and what they count.
CONTROL_COUNTS = {"gap_detected": "gap_count", "reconnect": "reconnect_count", "parse_error": "parse_error_count", "checksum_error": "checksum_error_count", "queue_overflow": "queue_overflow_count"}
#: Events of request rates that quality windows count besides.
RATE_COUNTS = {"throttled": "throttle_count", "interval_stretched": "stretch_count"}


def derivative_windows(updates: DataFrame, keys: list[str], time: str, interval: int, order: list[str], coverage: DataFrame) -> DataFrame:
    """Last mark, index, premium, funding and limits of each window, change of open interest, and liquidations.

    Sparse fields: a missing one is null, never zero and never carried forward. A window without liquidations counts 0 only
    if its feed is complete and healthy (`coverage`: keys, coverage, feed_healthy), else null.
    """
    at = F.struct(*order)
    last = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), at)).alias(c)
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), at))
    rows = updates.withColumn("window_start_ns", floor_to(time, interval)).groupBy(*keys, "window_start_ns").agg(
        *[last(c) for c in ("mark_price", "index_price", "funding_rate", "open_interest", "price_limit")],
        first("open_interest").alias("_oi_first"), F.sum("liquidation").alias("_liquidated"), F.count(F.lit(1)).alias("updates"),
    )
    rows = rows.join(coverage, keys, "left")
    quiet = F.when((F.col("coverage") == "complete") & F.col("feed_healthy"), F.lit(0))
    return rows.withColumns(
        {"premium": F.col("mark_price") - F.col("index_price"), "open_interest_change": F.col("open_interest") - F.col("_oi_first"), "liquidation": F.coalesce("_liquidated", quiet)}
    ).drop("_oi_first", "_liquidated")


def expectation_intervals(checkpoints: DataFrame, keys: list[str], effective: str, tie: str, end: int | Column) -> DataFrame:
    """What was expected from when to when: a checkpoint closes the one before, also of an earlier hour. Of those of one time
    the last by `tie` counts."""
    rows = carried(checkpoints, keys, [floor_to(effective, HOUR)], "_after", F.min(effective), F.min, ahead=True)
    w = Window.partitionBy(*keys, "_s0").orderBy(effective, tie)
    close = F.coalesce(F.lead(effective).over(w), "_after", F.lit(end) if isinstance(end, int) else end)
    return rows.withColumns({"start_ns": F.col(effective), "end_ns": close}).filter("end_ns > start_ns").drop("_after", "_s0")


def quality_windows(expectations: DataFrame, events: DataFrame, keys: list[str], time: str, interval: int) -> DataFrame:
    """A row for each expected window: inputs, share with exchange time, worst latency, control counts, throttles, stretches,
    number of egresses and of changes between them (from one input to the next of the window), and the age of the last event at the window's end (null until there is one). Silent windows have zero
    counts."""
    kinds = CONTROL_COUNTS | RATE_COUNTS
    control = [F.count(F.when(F.col("control_kind") == k, 1)).alias(n) for k, n in kinds.items()]
    inputs = F.col("control_kind").isNull()
    order = F.struct(time, *[c for c in ("record_index",) if c in events.columns])
    steps = Window.partitionBy(*keys, "window_start_ns", "_input").orderBy(order)
    events = events.withColumn("window_start_ns", floor_to(time, interval)).withColumn("_input", inputs)
    events = events.withColumn("_changed", F.col("_input") & (F.col("egress_id") != F.lag("egress_id").over(steps)))
    actual = events.groupBy(*keys, "window_start_ns").agg(
        F.count(F.when(inputs, 1)).alias("input_count"), F.count(F.when(inputs & (F.col("time_source") == "exchange"), 1)).alias("exchange_time_count"),
        F.max(F.when(inputs, F.col("latency_ns"))).alias("latency_max_ns"), F.max(F.when(inputs, F.col(time))).alias("_last"), F.count_distinct(F.when(inputs, F.col("egress_id"))).alias("egress_count"),
        F.count(F.when(F.col("_changed"), 1)).alias("egress_changes"), *control,
    )
    rows = expectation_grid(expectations, keys, interval).join(actual, [*keys, "window_start_ns"], "left")
    run = Window.partitionBy(*keys).orderBy("window_start_ns").rowsBetween(Window.unboundedPreceding, 0)
    age = F.col("window_start_ns") + interval - F.last("_last", ignorenulls=True).over(run)
    zero = ["input_count", "exchange_time_count", "egress_count", "egress_changes", *kinds.values()]
    return rows.withColumn("last_event_age_ns", age).withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in zero}).withColumn(
        "exchange_time_ratio", F.when(F.col("input_count") > 0, F.col("exchange_time_count") / F.col("input_count"))
    ).drop("_last")


def control_by_part(control: DataFrame, parts: DataFrame, part: str) -> DataFrame:
    """Control events (with an array of target parts) counted by kind for each part; parts without any have zeros."""
    counts = [F.count(F.when(F.col("control_kind") == k, 1)).alias(n) for k, n in CONTROL_COUNTS.items()]
    hit = control.select("control_kind", F.explode("targets").alias(part)).groupBy(part).agg(*counts)
    return parts.join(hit, part, "left").withColumns({n: F.coalesce(F.col(n), F.lit(0)) for n in CONTROL_COUNTS.values()})
