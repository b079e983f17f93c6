"""Bars of several sizes from a chain of streams: each rolls up the closed bars of the one before."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .jobs import file_stream, run_available, windowed_bars


def rolled_bars(bars: DataFrame, keys: list[str], size_us: int) -> DataFrame:
    """Closed bars of a smaller size, put into windows of `size_us`; they close, and their state is freed, when a bar of a later window
    has come. Bars come by closing time, so that none is late."""
    rows = bars.withColumn("_at", F.timestamp_micros("window_start")).withWatermark("_at", "0 seconds")
    first, last = F.min_by("open", "window_start"), F.max_by("close", "window_start")
    found = rows.groupBy(*keys, F.window("_at", f"{size_us} microseconds")).agg(
        first.alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), last.alias("close"), F.sum("base_volume").alias("base_volume"), F.sum("trade_count").alias("trade_count")
    )
    return found.select(*keys, F.unix_micros("window.start").alias("window_start"), "open", "high", "low", "close", "base_volume", "trade_count")


def chained_bars(trades: DataFrame, keys: list[str], time: str, sizes_us: list[int], order: list[str], delay: str, root: str) -> DataFrame:
    """Works off what is there and reads all bars: keys, interval_us, window_start (in microseconds), open, high, low, close, base_volume,
    trade_count. `sizes_us` rise, each a multiple of the one before.

    The trades make bars of the first size only, which close `delay` after their end by event time. The files of each size's closed
    bars are the stream of the next size, with a checkpoint of its own; so a trade is aggregated once, each stream has one state, of
    open bars alone, and a bar is out as soon as it is closed. A run that fails goes on from its checkpoints.
    """
    if any(b % a or b <= a for a, b in zip(sizes_us, sizes_us[1:], strict=False)):
        raise ValueError("each size is a multiple of the one before")
    spark = trades.sparkSession
    bars = windowed_bars(trades, keys, time, f"{sizes_us[0]} microseconds", order, delay).withColumn("window_start", F.unix_micros("window_start"))
    found = []
    for i, size in enumerate(sizes_us):
        if i:
            # The files of one closing hold bars of the same times, so a batch takes all files: were they parted, the first would
            # move the watermark past bars of the rest.
            bars = rolled_bars(file_stream(spark, f"{root}/{sizes_us[i - 1]}/*", schema, "*.parquet", files_per_batch=None), keys, size)
        schema = bars.schema
        run_available(bars, f"{root}/{size}", f"{root}/checkpoint-{size}")
        found.append(spark.read.schema(schema).parquet(f"{root}/{size}/*").withColumn("interval_us", F.lit(size).cast("long")))
    return reduce(DataFrame.unionByName, found)
