from decimal import Decimal as D

from tickloom.operators.trades import check_intervals, deduplicated, expectation_grid, filled_bars, normalise_trades, trade_bars

S = 1_000_000_000
SCHEMA = "k string, trade_id string, time_ns long, received_at_ns long, record_index long, price decimal(18,9), quantity decimal(18,9), side string, time_source string"


def rows(spark, *given):
    return spark.createDataFrame([("a", i, t, t, n, D(p), D(q), s, "exchange") for n, (i, t, p, q, s) in enumerate(given)], SCHEMA)


def bars(spark, *given):
    order = ["time_ns", "received_at_ns", "record_index"]
    return {r.window_start_ns: r for r in trade_bars(deduplicated(rows(spark, *given), ["k"], order), ["k"], [30 * S]).collect()}


def test_two_sides(spark):
    b = bars(spark, ("1", 1, "10.10", "2", "buy"), ("2", 2, "10.30", "1", "sell"))[0]
    assert (b.open, b.high, b.close) == (D("10.1"), D("10.3"), D("10.3"))
    assert abs(b.vwap - 30.5 / 3) < 1e-12
    assert (b.buy_volume, b.sell_volume, b.signed_volume) == (2, 1, 1)


def test_replay_and_missing_identifier(spark):
    b = bars(spark, ("v", 1, "1", "1", "buy"), ("v", 2, "1", "1", "buy"))[0]
    assert (b.trade_count, b.duplicate_count, b.dedup_mode) == (1, 1, "trade_id")
    b = bars(spark, (None, 1, "1", "1", "buy"), (None, 1, "1", "1", "buy"))[0]
    assert (b.trade_count, b.duplicate_count, b.dedup_mode) == (2, 0, "unavailable")


def test_window_boundary_and_fill(spark):
    b = bars(spark, ("1", 30 * S, "1", "1", "buy"))
    assert list(b) == [30 * S]
    grid = expectation_grid(spark.createDataFrame([("a", 0, 60 * S)], "k string, start_ns long, end_ns long"), ["k"], 30 * S)
    frame = trade_bars(deduplicated(rows(spark, ("1", 30 * S, "1", "1", "buy")), ["k"], ["time_ns", "received_at_ns", "record_index"]), ["k"], [30 * S])
    found = {r.window_start_ns: (r.trade_count, r.base_volume, r.open) for r in filled_bars(frame, grid, ["k"]).collect()}
    assert found == {0: (0, 0, None), 30 * S: (1, 1, D(1))}


def test_intervals():
    import pytest

    assert check_intervals([60 * S, 30 * S]) == [30 * S, 60 * S]
    for bad in (29 * S, 7200 * S, 7 * 60 * S):
        with pytest.raises(ValueError):
            check_intervals([bad])


def test_unknown_venue_gives_no_rows(spark):
    raw = spark.createDataFrame([("x", "k", "{}"), ("okx", "k", "not json"), ("okx", "k", '{"data":[{"tradeId":"1","px":"2","sz":"3","side":"buy","ts":"4"}]}')], "exchange string, instrument_key string, payload string")
    (r,) = normalise_trades(raw).collect()
    assert (r.trade_id, r.time_ns, r.price, r.quantity, r.side) == ("1", 4_000_000, 2, 3, "buy")
