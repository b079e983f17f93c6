"""Queries: trades, bars, grids, times."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import DAY, HOUR, SECOND, cadence_phase, checksum_text, decode_key, encode_key, floor_to, row_digest, storage_hour, turnover
from ..operators.ordered import positions
from ..operators.trades import INTERVALS, deduplicated, expectation_grid, filled_bars, normalise_trades, reconciled_candles, trade_bars
from .tables import EVENTS_SQL, doubles, events, table, trades

KEYS = ["instrument_key"]
ORDER = ["time_ns", "received_at_ns", "record_index"]


def _bars(spark: SparkSession, sf_dir: str, intervals: list[int]) -> DataFrame:
    return trade_bars(deduplicated(trades(spark, sf_dir), KEYS, ORDER), KEYS, intervals)


def d1_trade_bars(spark, sf_dir):
    return doubles(_bars(spark, sf_dir, INTERVALS).drop("buy_volume", "sell_volume", "signed_volume"))


def d2_aggressor_split(spark, sf_dir):
    return doubles(_bars(spark, sf_dir, [HOUR]).select(*KEYS, "window_start_ns", "buy_volume", "sell_volume", "signed_volume"))


def d3_trade_dedup(spark, sf_dir):
    rows = deduplicated(trades(spark, sf_dir), KEYS, ORDER)
    return rows.groupBy(*KEYS).agg(
        F.count(F.when(~F.col("duplicate"), 1)).alias("kept"),
        F.count(F.when(F.col("duplicate"), 1)).alias("duplicates"),
        F.count(F.when(F.col("trade_id").isNull(), 1)).alias("unidentified"),
        F.sum(F.when(~F.col("duplicate"), F.col("record_index"))).alias("kept_locators"),
    )


def _expectations(spark, sf_dir):
    return trades(spark, sf_dir).groupBy(*KEYS).agg(F.min("time_ns").alias("start_ns"), (F.max("time_ns") + 1).alias("end_ns"))


def d4_filled_bars(spark, sf_dir):
    grid = expectation_grid(_expectations(spark, sf_dir), KEYS, 900 * SECOND)
    bars = filled_bars(_bars(spark, sf_dir, [900 * SECOND]).drop("interval_ns"), grid, KEYS)
    return doubles(bars.select(*KEYS, "window_start_ns", "open", "close", "base_volume", "trade_count", "vwap"))


def d5_interval_counts(spark, sf_dir):
    bars = _bars(spark, sf_dir, INTERVALS)
    return bars.groupBy("interval_ns").agg(F.count(F.lit(1)).alias("windows"), F.sum("trade_count").alias("trades"), F.max("trade_count").alias("busiest"))


def d6_time_sources(spark, sf_dir):
    rows = trades(spark, sf_dir).withColumn("window_start_ns", floor_to("time_ns", HOUR))
    n = lambda s: F.count(F.when(F.col("time_source") == s, 1))
    return rows.groupBy(*KEYS, "window_start_ns").agg(
        n("exchange").alias("exchange"), n("receive_missing").alias("missing"), n("receive_outlier").alias("outlier"), (n("exchange") / F.count(F.lit(1))).alias("exchange_ratio")
    )


def b8_event_time(spark, sf_dir):
    return trades(spark, sf_dir).select("record_index", "time_ns", "time_source")


def b6_storage_hour(spark, sf_dir):
    return trades(spark, sf_dir).groupBy(storage_hour("received_at_ns").alias("hour")).agg(F.count(F.lit(1)).alias("records"), F.min("record_index").alias("first"))


def b10_normalised_trades(spark, sf_dir):
    e = events(spark, sf_dir)
    ms = F.expr("received_at_ns div 1000000").cast("string")
    price, size, key = F.col("price").cast("string"), F.col("quantity").cast("string"), F.col("record_index").cast("string")
    one = {
        "okx": F.to_json(F.struct(F.array(F.struct(key.alias("tradeId"), price.alias("px"), size.alias("sz"), F.col("side").alias("side"), ms.alias("ts"))).alias("data"))),
        "binance": F.to_json(F.struct(key.alias("t"), price.alias("p"), size.alias("q"), ms.alias("T"), (F.col("side") == "sell").alias("m"))),
        "bybit": F.to_json(F.struct(F.array(F.struct(key.alias("i"), ms.alias("T"), price.alias("p"), size.alias("v"), F.initcap("side").alias("S"))).alias("data"))),
        "bitget": F.to_json(F.struct(F.array(F.struct(key.alias("tradeId"), ms.alias("ts"), price.alias("price"), size.alias("size"), F.col("side").alias("side"))).alias("data"))),
        "kraken": F.to_json(F.struct(F.array(F.struct(key.alias("trade_id"), F.date_format(F.timestamp_millis(ms.cast("long")), "yyyy-MM-dd'T'HH:mm:ss.SSSXXX").alias("timestamp"), price.alias("price"), size.alias("qty"), F.col("side").alias("side"))).alias("data"))),
    }
    names = list(one)
    venue = F.get(F.array(*map(F.lit, names)), (F.col("user_id") % 5).cast("int"))
    raw = e.withColumn("exchange", venue).withColumn("payload", F.coalesce(*[F.when(F.col("exchange") == n, v) for n, v in one.items()]))
    return doubles(normalise_trades(raw.select("exchange", "instrument_key", "record_index", "payload")))


def b5_key_encoding(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    key = F.concat_ws("_", "p_brand", "p_name", F.lit("é*~ %"))
    return p.select("p_partkey", encode_key(key).alias("encoded"), (decode_key(encode_key(key)) == key).alias("reversible"))


def b18_turnover(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem")
    given = F.when(F.col("l_linenumber") % 2 == 1, F.col("l_extendedprice").cast("decimal(18,2)"))
    value, method = turnover(given, F.col("l_quantity").cast("decimal(9,2)"), F.lit(10).cast("decimal(9,2)"))
    return doubles(l.select("l_partkey", value.alias("value"), method.alias("method")).groupBy("l_partkey", "method").agg(F.sum("value").alias("turnover")))


def c7_expectation_grid(spark, sf_dir):
    grid = expectation_grid(_expectations(spark, sf_dir), KEYS, 300 * SECOND)
    actual = trades(spark, sf_dir).groupBy(*KEYS, floor_to("time_ns", 300 * SECOND).alias("window_start_ns")).agg(F.count(F.lit(1)).alias("events"))
    return grid.join(actual, [*KEYS, "window_start_ns"], "left").withColumn("events", F.coalesce("events", F.lit(0)))


def c18_candle_reconciliation(spark, sf_dir):
    bars = _bars(spark, sf_dir, [60 * SECOND])
    odd = F.pmod((F.col("window_start_ns") / (60 * SECOND)).cast("long"), F.lit(7))
    native = bars.filter(odd != 3).select(*KEYS, "window_start_ns", "open", "high", "low", F.when(odd == 5, F.col("close") + 1).otherwise(F.col("close")).alias("close"), "base_volume")
    rows = reconciled_candles(bars, native, KEYS)
    return doubles(rows.groupBy(*KEYS, "state").agg(F.count(F.lit(1)).alias("windows"), F.sum("close_difference").alias("close_difference")))


def f1_canonical_order(spark, sf_dir):
    rows = positions(trades(spark, sf_dir), KEYS, ORDER, [floor_to("time_ns", HOUR)])
    return rows.select(*KEYS, "record_index", "position")


def f2_causal_order(spark, sf_dir):
    """Worker runs by their first receive time; inside a run by receive time and locator, never by event time."""
    t = trades(spark, sf_dir)
    run = [*KEYS, "worker_instance_id"]
    rows = t.join(t.groupBy(*run).agg(F.min("received_at_ns").alias("run_start")), run)
    order = ["run_start", "worker_instance_id", "received_at_ns", "record_index"]
    stretch = [F.col("run_start"), F.col("worker_instance_id"), floor_to("received_at_ns", HOUR)]
    return positions(rows, KEYS, order, stretch).select(*KEYS, "record_index", "position")


def d27_latency(spark, sf_dir):
    """The total is text of a whole number: nanoseconds of many late events pass 64 bits."""
    rows = events(spark, sf_dir).filter("event_time_ns IS NOT NULL").withColumn("lag", F.col("received_at_ns") - F.col("event_time_ns"))
    total = F.sum(F.col("lag").cast("decimal(19,0)")).cast("string")
    return rows.groupBy(*KEYS).agg(F.min("lag").alias("lag_min"), F.max("lag").alias("lag_max"), total.alias("lag_total"), F.count("lag").alias("samples"))


def h2_digests(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", F.sha2(F.col("o_orderpriority"), 256).alias("sha"), row_digest("o_orderkey", "o_orderstatus", F.when(F.col("o_orderkey") % 3 > 0, F.col("o_orderpriority"))).alias("row_sha"))


def h3_checksum_text(spark, sf_dir):
    return events(spark, sf_dir).select("record_index", F.concat(checksum_text(F.col("price").cast("string")), checksum_text(F.col("quantity").cast("string"))).alias("text"))


def h4_cadence_phase(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    phase = cadence_phase("c_name", 60 * SECOND)
    return c.select("c_custkey", phase.alias("phase_ns"), (floor_to("c_custkey", 10)).alias("floor"))


QUERIES = {
    f.__name__: f
    for f in (
        d1_trade_bars, d2_aggressor_split, d3_trade_dedup, d4_filled_bars, d5_interval_counts, d6_time_sources, b5_key_encoding, b6_storage_hour, b8_event_time,
        b10_normalised_trades, b18_turnover, c7_expectation_grid, c18_candle_reconciliation, f1_canonical_order, f2_causal_order, d27_latency, h2_digests, h3_checksum_text, h4_cadence_phase,
    )
}

_DEDUP = f"""{EVENTS_SQL},
dd AS (SELECT *, trade_id IS NOT NULL AND row_number() OVER (PARTITION BY instrument_key, trade_id ORDER BY time_ns, received_at_ns, record_index) > 1 AS duplicate FROM tr)"""


def _bars_sql(intervals: list[int]) -> str:
    values = ", ".join(f"({i})" for i in intervals)
    return f"""{_DEDUP},
w AS (SELECT dd.*, interval_ns, time_ns - time_ns % interval_ns AS window_start_ns FROM dd, (VALUES {values}) i(interval_ns)),
bars AS (
  SELECT instrument_key, interval_ns, window_start_ns,
         arg_min(price, (time_ns, received_at_ns, record_index)) FILTER (WHERE NOT duplicate) AS open, max(price) FILTER (WHERE NOT duplicate) AS high,
         min(price) FILTER (WHERE NOT duplicate) AS low, arg_max(price, (time_ns, received_at_ns, record_index)) FILTER (WHERE NOT duplicate) AS close,
         coalesce(sum(quantity) FILTER (WHERE NOT duplicate), 0) AS base_volume, coalesce(sum(price * quantity) FILTER (WHERE NOT duplicate), 0) AS quote_volume,
         coalesce(sum(quantity) FILTER (WHERE NOT duplicate AND side = 'buy'), 0) AS buy_volume, coalesce(sum(quantity) FILTER (WHERE NOT duplicate AND side = 'sell'), 0) AS sell_volume,
         count(*) FILTER (WHERE NOT duplicate) AS trade_count, count(*) FILTER (WHERE duplicate) AS duplicate_count,
         count(*) FILTER (WHERE trade_id IS NULL) AS unidentified_count, min(time_ns) FILTER (WHERE NOT duplicate) AS first_time_ns,
         max(time_ns) FILTER (WHERE NOT duplicate) AS last_time_ns, count(*) FILTER (WHERE time_source = 'exchange') AS exchange_time_count, count(*) AS n
  FROM w GROUP BY ALL)"""


_D = lambda *cs: ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in cs)
_VWAP = "CASE WHEN base_volume > 0 THEN CAST(quote_volume AS DOUBLE) / CAST(base_volume AS DOUBLE) END AS vwap"

ORACLES = {
    "d1_trade_bars": f"""WITH {_bars_sql(INTERVALS)}
SELECT instrument_key, interval_ns, window_start_ns, {_D('open', 'high', 'low', 'close', 'base_volume', 'quote_volume')}, trade_count, duplicate_count, unidentified_count,
       first_time_ns, last_time_ns, exchange_time_count, {_VWAP}, CASE WHEN unidentified_count > 0 THEN 'unavailable' ELSE 'trade_id' END AS dedup_mode,
       exchange_time_count / n AS exchange_time_ratio FROM bars""",
    "d2_aggressor_split": f"""WITH {_bars_sql([HOUR])}
SELECT instrument_key, window_start_ns, {_D('buy_volume', 'sell_volume')}, CAST(buy_volume - sell_volume AS DOUBLE) AS signed_volume FROM bars""",
    "d3_trade_dedup": f"""WITH {_DEDUP}
SELECT instrument_key, count(*) FILTER (WHERE NOT duplicate) AS kept, count(*) FILTER (WHERE duplicate) AS duplicates, count(*) FILTER (WHERE trade_id IS NULL) AS unidentified,
       CAST(sum(record_index) FILTER (WHERE NOT duplicate) AS BIGINT) AS kept_locators FROM dd GROUP BY 1""",
    "d4_filled_bars": f"""WITH {_bars_sql([900 * SECOND])},
x AS (SELECT instrument_key, min(time_ns) AS a, max(time_ns) AS b FROM tr GROUP BY 1),
grid AS (SELECT instrument_key, unnest(range(a - a % {900 * SECOND}, b + 1, {900 * SECOND})) AS window_start_ns FROM x)
SELECT instrument_key, window_start_ns, {_D('open', 'close')}, CAST(coalesce(base_volume, 0) AS DOUBLE) AS base_volume, coalesce(trade_count, 0) AS trade_count, {_VWAP}
FROM grid LEFT JOIN bars USING (instrument_key, window_start_ns)""",
    "d5_interval_counts": f"""WITH {_bars_sql(INTERVALS)}
SELECT interval_ns, count(*) AS windows, CAST(sum(trade_count) AS BIGINT) AS trades, max(trade_count) AS busiest FROM bars GROUP BY 1""",
    "d6_time_sources": f"""WITH {EVENTS_SQL}
SELECT instrument_key, time_ns - time_ns % {HOUR} AS window_start_ns, count(*) FILTER (WHERE time_source = 'exchange') AS exchange, count(*) FILTER (WHERE time_source = 'receive_missing') AS missing,
       count(*) FILTER (WHERE time_source = 'receive_outlier') AS outlier, count(*) FILTER (WHERE time_source = 'exchange') / count(*) AS exchange_ratio FROM tr GROUP BY 1, 2""",
    "b8_event_time": f"WITH {EVENTS_SQL} SELECT record_index, time_ns, time_source FROM tr",
    "b6_storage_hour": f"""WITH {EVENTS_SQL}
SELECT strftime(make_timestamp(received_at_ns // 1000), '%Y/%m/%d/%H') AS hour, count(*) AS records, min(record_index) AS first FROM tr GROUP BY 1""",
    "b10_normalised_trades": f"""WITH {EVENTS_SQL}
SELECT ['okx', 'binance', 'bybit', 'bitget', 'kraken'][user_id % 5 + 1] AS exchange, instrument_key, record_index, CAST(record_index AS VARCHAR) AS trade_id,
       received_at_ns // 1000000 * 1000000 AS time_ns, {_D('price', 'quantity')}, CAST(price * quantity AS DOUBLE) AS quote_quantity, side FROM ev""",
    "b5_key_encoding": """SELECT p_partkey, replace(url_encode(p_brand || '_' || p_name || '_é*~ %'), '_', '%5F') AS encoded, true AS reversible FROM part""",
    "b18_turnover": """SELECT l_partkey, CASE WHEN l_linenumber % 2 = 1 THEN 'quote_volume' ELSE 'base_times_price' END AS method,
       CAST(sum(CASE WHEN l_linenumber % 2 = 1 THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE CAST(l_quantity AS DECIMAL(9,2)) * 10 END) AS DOUBLE) AS turnover FROM lineitem GROUP BY 1, 2""",
    "c7_expectation_grid": f"""WITH {EVENTS_SQL},
x AS (SELECT instrument_key, min(time_ns) AS a, max(time_ns) AS b FROM tr GROUP BY 1),
grid AS (SELECT instrument_key, unnest(range(a - a % {300 * SECOND}, b + 1, {300 * SECOND})) AS window_start_ns FROM x),
n AS (SELECT instrument_key, time_ns - time_ns % {300 * SECOND} AS window_start_ns, count(*) AS events FROM tr GROUP BY 1, 2)
SELECT instrument_key, window_start_ns, coalesce(events, 0) AS events FROM grid LEFT JOIN n USING (instrument_key, window_start_ns)""",
    "c18_candle_reconciliation": f"""WITH {_bars_sql([60 * SECOND])},
s AS (SELECT instrument_key, close, CASE (window_start_ns // {60 * SECOND}) % 7 WHEN 3 THEN 'missing_native' WHEN 5 THEN CASE WHEN close IS NULL THEN 'missing_native' ELSE 'different' END
             ELSE CASE WHEN open IS NULL THEN 'missing_native' ELSE 'equal' END END AS state FROM bars)
SELECT instrument_key, state, count(*) AS windows, CASE state WHEN 'missing_native' THEN NULL WHEN 'equal' THEN 0.0 ELSE CAST(-count(*) AS DOUBLE) END AS close_difference FROM s GROUP BY 1, 2""",
    "f1_canonical_order": f"WITH {EVENTS_SQL} SELECT instrument_key, record_index, row_number() OVER (PARTITION BY instrument_key ORDER BY time_ns, received_at_ns, record_index) AS position FROM tr",
    "f2_causal_order": f"""WITH {EVENTS_SQL}, r AS (SELECT *, min(received_at_ns) OVER (PARTITION BY instrument_key, worker_instance_id) AS run_start FROM tr)
SELECT instrument_key, record_index, row_number() OVER (PARTITION BY instrument_key ORDER BY run_start, worker_instance_id, received_at_ns, record_index) AS position FROM r""",
    "d27_latency": f"""WITH {EVENTS_SQL}, l AS (SELECT instrument_key, received_at_ns - event_time_ns AS lag FROM ev WHERE event_time_ns IS NOT NULL)
SELECT instrument_key, min(lag) AS lag_min, max(lag) AS lag_max, CAST(sum(lag) AS BIGINT) AS lag_total, count(*) AS samples FROM l GROUP BY 1""",
    "h2_digests": """SELECT o_orderkey, sha256(o_orderpriority) AS sha,
       sha256(concat_ws('|', length(o_orderkey::VARCHAR) || ':' || o_orderkey, length(o_orderstatus) || ':' || o_orderstatus,
              CASE WHEN o_orderkey % 3 > 0 THEN length(o_orderpriority) || ':' || o_orderpriority ELSE '~' END)) AS row_sha FROM orders""",
    "h3_checksum_text": f"""WITH {EVENTS_SQL}
SELECT record_index, regexp_replace(replace(price::VARCHAR, '.', ''), '^0+', '') || regexp_replace(replace(quantity::VARCHAR, '.', ''), '^0+', '') AS text FROM ev""",
    "h4_cadence_phase": f"""SELECT c_custkey, CAST((('0x' || substr(sha256(c_name), 1, 8))::BIGINT::HUGEINT * {60 * SECOND} + (('0x' || substr(sha256(c_name), 9, 8))::BIGINT::HUGEINT * {60 * SECOND} + (('0x' || substr(sha256(c_name), 17, 8))::BIGINT::HUGEINT * {60 * SECOND}
         + ('0x' || substr(sha256(c_name), 25, 8))::BIGINT::HUGEINT * {60 * SECOND} // {1 << 32}) // {1 << 32}) // {1 << 32}) // {1 << 32} AS BIGINT) AS phase_ns,
       c_custkey - c_custkey % 10 AS floor FROM customer""",
}
