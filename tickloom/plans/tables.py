"""The driver's tables, seen as the engine's inputs. SQL twins of the same views stand beside them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import DAY, choose_time


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trade events: instrument = event type; every 50th was received late, every 100th has no identifier, and
    every 20th repeats the identifier of the event 10 before of its instrument's user."""
    e = table(spark, sf_dir, "events")
    ns = F.unix_micros(F.col("ts").cast("timestamp")) * 1000
    late = F.when(F.col("event_id") % 50 == 0, 8 * DAY).otherwise((F.col("event_id") % 1000) * 1_000_000)
    return e.select(
        F.col("event_type").alias("instrument_key"),
        F.when(F.col("event_id") % 100 != 0, F.col("event_id") - F.when(F.col("event_id") % 20 == 0, 10).otherwise(0)).cast("string").alias("trade_id"),
        F.when(F.col("event_id") % 33 != 0, ns).alias("event_time_ns"),
        (ns + late).alias("received_at_ns"),
        F.col("value").cast("decimal(18,9)").alias("price"),
        F.get_json_object("props", "$.k").cast("decimal(18,9)").alias("quantity"),
        F.when(F.col("user_id") % 2 == 0, "buy").otherwise("sell").alias("side"),
        F.col("event_id").alias("record_index"),
        F.col("user_id"),
        F.concat(F.lit("worker-"), F.col("user_id") % 5).alias("worker_instance_id"),
    )


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events with their effective time."""
    time, source = choose_time("event_time_ns", "received_at_ns")
    return events(spark, sf_dir).withColumns({"time_ns": time, "time_source": source})


EVENTS_SQL = f"""
e0 AS (SELECT *, epoch_us(ts) * 1000 AS ns FROM events),
ev AS (
  SELECT event_type AS instrument_key,
         CASE WHEN event_id % 100 <> 0 THEN CAST(event_id - CASE WHEN event_id % 20 = 0 THEN 10 ELSE 0 END AS VARCHAR) END AS trade_id,
         CASE WHEN event_id % 33 <> 0 THEN ns END AS event_time_ns,
         ns + CASE WHEN event_id % 50 = 0 THEN {8 * DAY} ELSE (event_id % 1000) * 1000000 END AS received_at_ns,
         CAST(value AS DECIMAL(18,9)) AS price, CAST(json_extract_string(props, '$.k') AS DECIMAL(18,9)) AS quantity,
         CASE WHEN user_id % 2 = 0 THEN 'buy' ELSE 'sell' END AS side, event_id AS record_index, user_id,
         'worker-' || (user_id % 5) AS worker_instance_id
  FROM e0),
tr AS (
  SELECT *, CASE WHEN event_time_ns BETWEEN received_at_ns - {7 * DAY} AND received_at_ns + 300000000000 THEN event_time_ns ELSE received_at_ns END AS time_ns,
         CASE WHEN event_time_ns IS NULL THEN 'receive_missing' WHEN event_time_ns BETWEEN received_at_ns - {7 * DAY} AND received_at_ns + 300000000000
              THEN 'exchange' ELSE 'receive_outlier' END AS time_source
  FROM ev)"""


def doubles(frame: DataFrame) -> DataFrame:
    """Decimals as doubles, since engines print decimals of their own scales."""
    return frame.select(*[F.col(c).cast("double").alias(c) if t.startswith("decimal") else F.col(c) for c, t in frame.dtypes])
