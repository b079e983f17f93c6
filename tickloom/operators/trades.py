"""Trade normalisation and trade bars."""

from __future__ import annotations

from collections.abc import Callable

from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import HOUR, SECOND, floor_to

#: Default intervals; each divides an hour.
INTERVALS = [30 * SECOND, 60 * SECOND, 300 * SECOND, 900 * SECOND, 3600 * SECOND]
QUANTITY = "decimal(18,9)"


def check_intervals(intervals: list[int]) -> list[int]:
    """Intervals are from 30 seconds to an hour and divide the hour."""
    for i in intervals:
        if not 30 * SECOND <= i <= HOUR or HOUR % i:
            raise ValueError(f"no interval of 30 s to 1 h that divides an hour: {i}")
    return sorted(set(intervals))


# Venues: a function of the payload column that returns an array of trades, all as text.


def _trades(array_schema: str, payload: Column, path: str | None, pick: Callable[[Column], list[Column]]) -> Column:
    text = F.get_json_object(payload, path) if path else F.concat(F.lit("["), payload, F.lit("]"))
    names = ["trade_id", "time_ns", "price", "quantity", "side"]
    return F.transform(F.from_json(text, array_schema), lambda t: F.struct(*[c.alias(n) for c, n in zip(pick(t), names, strict=True)]))


def _ms(text: Column) -> Column:
    return text.cast("long") * 1_000_000


VENUES: dict[str, Callable[[Column], Column]] = {
    "okx": lambda p: _trades(
        "array<struct<tradeId:string,px:string,sz:string,side:string,ts:string>>", p, "$.data",
        lambda t: [t["tradeId"], _ms(t["ts"]), t["px"], t["sz"], t["side"]],
    ),
    # Its fields differ by case only (t, T), so they are taken by path.
    "binance": lambda p: F.array(
        F.struct(
            F.get_json_object(p, "$.t").alias("trade_id"),
            _ms(F.get_json_object(p, "$.T")).alias("time_ns"),
            F.get_json_object(p, "$.p").alias("price"),
            F.get_json_object(p, "$.q").alias("quantity"),
            F.when(F.get_json_object(p, "$.m") == "true", "sell").otherwise("buy").alias("side"),
        )
    ),
    "bybit": lambda p: _trades(
        "array<struct<i:string,T:string,p:string,v:string,S:string>>", p, "$.data",
        lambda t: [t["i"], _ms(t["T"]), t["p"], t["v"], F.lower(t["S"])],
    ),
    "bitget": lambda p: _trades(
        "array<struct<tradeId:string,ts:string,price:string,size:string,side:string>>", p, "$.data",
        lambda t: [t["tradeId"], _ms(t["ts"]), t["price"], t["size"], t["side"]],
    ),
    "kraken": lambda p: _trades(
        "array<struct<trade_id:string,timestamp:string,price:string,qty:string,side:string>>", p, "$.data",
        lambda t: [t["trade_id"], F.unix_micros(F.to_timestamp(t["timestamp"])) * 1000, t["price"], t["qty"], t["side"]],
    ),
}


def normalise_trades(raw: DataFrame, venues: dict[str, Callable[[Column], Column]] = VENUES) -> DataFrame:
    """Trades of raw events (exchange, instrument_key, payload, received_at_ns, locator): a row for each trade in a payload.

    One pass: the venue's parser is chosen by a case on the exchange. Unknown venues and unreadable payloads give no rows.
    """
    parsed = F.coalesce(*[F.when(F.col("exchange") == v, f(F.col("payload"))) for v, f in venues.items()])
    rows = raw.select(*[c for c in raw.columns if c != "payload"], F.explode(parsed).alias("_t"))
    return rows.select(
        *[c for c in rows.columns if c != "_t"],
        "_t.trade_id",
        "_t.time_ns",
        F.col("_t.price").cast(QUANTITY).alias("price"),
        F.col("_t.quantity").cast(QUANTITY).alias("quantity"),
        (F.col("_t.price").cast(QUANTITY) * F.col("_t.quantity").cast(QUANTITY)).alias("quote_quantity"),
        "_t.side",
    )


def deduplicated(trades: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Marks the rows whose trade identifier came before in canonical order (`duplicate`). Rows without an identifier
    are never duplicates."""
    first = Window.partitionBy(*keys, "trade_id").orderBy(*order)
    known = F.col("trade_id").isNotNull()
    rows = trades.filter(known).withColumn("duplicate", F.row_number().over(first) > 1)
    return rows.unionByName(trades.filter(~known).withColumn("duplicate", F.lit(False)))


def trade_bars(
    trades: DataFrame, keys: list[str], intervals: list[int], time: str = "time_ns", order: tuple[str, ...] = ("time_ns", "received_at_ns", "record_index")
) -> DataFrame:
    """Bars of each key and window: open, high, low, close, vwap, volumes by side, counts, first and last time.

    Trades are aggregated once, into windows of the intervals' greatest common divisor; those bars, not the trades, are put
    into a window of each interval. Rows need a `duplicate` flag, and count as duplicates in the window of their own time.
    """
    base = gcd(*check_intervals(intervals))
    at = F.struct(*order)
    real = ~F.col("duplicate")
    only = lambda c: F.when(real, c)
    amount = lambda c: F.coalesce(F.sum(only(c)), F.lit(0))
    notional = F.col("price") * F.col("quantity")
    buys, sells = (F.when(F.col("side") == s, F.col("quantity")) for s in ("buy", "sell"))
    small = trades.withColumn("_base_ns", floor_to(time, base)).groupBy(*keys, "_base_ns").agg(
        F.min_by("price", only(at)).alias("open"),
        F.max_by("price", only(at)).alias("close"),
        F.min(only(at)).alias("_from"),
        F.max(only(at)).alias("_to"),
        F.max(only(F.col("price"))).alias("high"),
        F.min(only(F.col("price"))).alias("low"),
        amount(F.col("quantity")).alias("base_volume"),
        amount(notional).alias("quote_volume"),
        amount(buys).alias("buy_volume"),
        amount(sells).alias("sell_volume"),
        F.count(only(F.lit(1))).alias("trade_count"),
        F.count(F.when(F.col("duplicate"), 1)).alias("duplicate_count"),
        F.count(F.when(real & F.col("trade_id").isNull(), 1)).alias("unidentified_count"),
        F.min(only(F.col(time))).alias("first_time_ns"),
        F.max(only(F.col(time))).alias("last_time_ns"),
        F.count(F.when(F.col("time_source") == "exchange", 1)).alias("exchange_time_count"),
    )
    windows = F.explode(F.array(*[F.lit(i).cast("long") for i in intervals])).alias("interval_ns")
    rows = small.select("*", windows).withColumn("window_start_ns", floor_to("_base_ns", F.col("interval_ns")))
    summed = ["base_volume", "quote_volume", "buy_volume", "sell_volume", "trade_count", "duplicate_count", "unidentified_count", "exchange_time_count"]
    bars = rows.groupBy(*keys, "interval_ns", "window_start_ns").agg(
        F.min_by("open", "_from").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", "_to").alias("close"),
        *[F.sum(c).alias(c) for c in summed], F.min("first_time_ns").alias("first_time_ns"), F.max("last_time_ns").alias("last_time_ns"),
    )
    return bars.withColumns(
        {
            "signed_volume": F.col("buy_volume") - F.col("sell_volume"),
            "vwap": F.when(F.col("base_volume") > 0, F.col("quote_volume").cast("double") / F.col("base_volume").cast("double")),
            "dedup_mode": F.when(F.col("unidentified_count") > 0, "unavailable").otherwise("trade_id"),
            "exchange_time_ratio": F.col("exchange_time_count") / (F.col("trade_count") + F.col("duplicate_count")),
        }
    )


def expectation_grid(expectations: DataFrame, keys: list[str], interval_ns: int) -> DataFrame:
    """A row for each window that an expectation [start_ns, end_ns) touches, also silent ones."""
    first = floor_to("start_ns", interval_ns)
    last = floor_to(F.col("end_ns") - 1, interval_ns)
    starts = F.explode(F.sequence(first, last, F.lit(interval_ns).cast("long"))).alias("window_start_ns")
    return expectations.filter("end_ns > start_ns").select(*keys, starts).distinct()


def filled_bars(bars: DataFrame, grid: DataFrame, keys: list[str]) -> DataFrame:
    """The bars on the grid: empty windows have null prices and zero volumes and counts; nothing is carried forward."""
    zero = ["base_volume", "quote_volume", "buy_volume", "sell_volume", "signed_volume", "trade_count", "duplicate_count", "unidentified_count", "exchange_time_count"]
    rows = grid.join(bars, [*keys, "window_start_ns"], "left")
    return rows.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in zero if c in bars.columns})


def reconciled_candles(bars: DataFrame, native: DataFrame, keys: list[str]) -> DataFrame:
    """Derived bars against an exchange's own candles of the same windows: differences, and what one side lacks."""
    mine = bars.select(*keys, "window_start_ns", *[F.col(c).alias(f"derived_{c}") for c in ("open", "high", "low", "close", "base_volume")])
    both = mine.join(native, [*keys, "window_start_ns"], "full_outer")
    state = (
        F.when(F.col("open").isNull(), "missing_native").when(F.col("derived_open").isNull(), "missing_derived")
        .when(F.col("open").eqNullSafe(F.col("derived_open")) & F.col("high").eqNullSafe(F.col("derived_high")) & F.col("low").eqNullSafe(F.col("derived_low")) & F.col("close").eqNullSafe(F.col("derived_close")), "equal")
        .otherwise("different")
    )
    return both.withColumns({"state": state, "close_difference": F.col("derived_close") - F.col("close"), "volume_difference": F.col("derived_base_volume") - F.col("base_volume")})
