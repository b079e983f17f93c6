import zlib

from tickloom.operators import books as b
from tickloom.operators.universe import admitted, exit_grace, lifecycle_step, rendezvous, top_n
from tickloom.streaming.jobs import lifecycle_rule

SCHEMA = "k string, kind string, seq long, prev_seq long, first_seq long, time_ns long, bids array<array<string>>, asks array<array<string>>"


def book(spark, *rows):
    return spark.createDataFrame([("k", kind, seq, prev, first, t, bids, asks) for kind, seq, prev, first, t, bids, asks in rows], SCHEMA)


def validity(spark, rule, *rows):
    frame = book(spark, *[(kind, seq, prev, first, n, [], []) for n, (kind, seq, prev, first) in enumerate(rows)])
    return [r.valid for r in b.validated(frame, ["k"], ["time_ns"], rule, 2).orderBy("time_ns").collect()]


def test_continuity_rules(spark):
    s = ("snapshot", 100, None, None)
    assert validity(spark, "binance_spot", s, ("update", 101, None, 99)) == [True, True]
    assert validity(spark, "binance_spot", s, ("update", 104, None, 103)) == [True, False]
    assert validity(spark, "bybit", s, ("update", 150, None, None)) == [True, True]
    assert validity(spark, "bitget", s, ("update", 101, 99, None)) == [True, True]
    assert validity(spark, "bitget", s, ("update", 102, 101, None)) == [True, False]
    assert validity(spark, "kraken_futures", s, ("update", 105, None, None), ("update", 104, None, None)) == [True, True, False]
    assert validity(spark, "okx", s, ("update", 101, 100, None), ("update", 103, 102, None), ("snapshot", 200, None, None), ("update", 201, 200, None)) == [True, True, False, True, True]
    assert validity(spark, "okx", ("update", 1, None, None)) == [False]


def test_state_at_window_end(spark):
    frame = b.segmented(book(spark, ("snapshot", 1, None, None, 0, [["10", "2"]], [["11", "1"]]), ("update", 2, 1, None, 5, [["10", "0"], ["9", "4"]], [])), ["k"], ["seq"], 1)
    ends = b.segment_ends(frame, ["k"], "time_ns", 20)
    levels = b.exploded_levels(frame, ["k", "segment", "seq", "time_ns"]).join(ends, ["k", "segment"])
    states = b.states_at(b.lifetimes(levels, ["k"], "seq", "time_ns", "until"), ["k"], 10)
    got = {r.window_end_ns: r for r in b.book_features(states, ["k", "window_end_ns"]).collect()}
    assert (got[0].mid, got[0].spread, got[0].bid_notional_1) == (10.5, 1.0, 20.0)
    assert (got[10].bid_price, got[10].bid_quantity, got[10].mid) == (9.0, 4.0, 10.0)


def test_checksum_chain_trims(spark):
    asks = [[f"{i}.0", "1.50"] for i in range(1, 13)]
    text = "".join(f"{i}0" + "150" for i in range(1, 11))
    frame = spark.createDataFrame([("k", 1, 1, "snapshot", [], asks, zlib.crc32(text.encode())), ("k", 1, 2, "update", [], [["1.0", "0"]], 0)], "k string, segment long, seq long, kind string, bids array<array<string>>, asks array<array<string>>, checksum long")
    got = {r.seq: r for r in b.checksum_chain(frame, ["k"], "seq").collect()}
    assert got[1].matches and not got[2].matches
    assert got[2].computed == zlib.crc32("".join(f"{i}0" + "150" for i in range(2, 11)).encode())  # 11 and 12 were trimmed before


def test_grace_and_ties(spark):
    rows = [("a", t, r, e) for t, r, e in [(0, 1, True), (1, None, True), (2, None, True), (3, None, True), (4, 2, True), (5, None, False), (6, None, True)]]
    frame = spark.createDataFrame(rows, "k string, t int, rank int, eligible boolean")
    got = {r.t: (r.in_grace, r.exit_started, r.shown_rank) for r in exit_grace(frame, ["k"], "t", 2).collect()}
    assert got[1] == (True, 1, 1) and got[2] == (True, 1, 1) and got[3][0] is False
    assert got[5][0] is False and got[6][0] is False
    c = spark.createDataFrame([("b", 5, 10), ("a", 5, 10), ("c", 9, 5)], "instrument_key string, turnover long, turnover_observed_at_ns long").selectExpr("*", "true present", "true tradable", "true covered", "'U' quote_asset", "'U' turnover_currency", "1 s")
    assert [r.instrument_key for r in top_n(c, ["s"], 2, 12, 2).orderBy("rank").collect()] == ["a", "b"]


def test_admission_never_evicts_fixed(spark):
    c = spark.createDataFrame([(1, "f", 0, None, 0), (1, "n1", 1, None, 5), (1, "n2", 1, None, 9), (1, "t1", 2, 1, 0), (1, "t2", 2, 2, 0)], "s int, instrument_key string, priority int, rank int, first_seen_ns long")
    from pyspark.sql import functions as F

    got = {r.instrument_key: r.admitted for r in admitted(c, ["s"], F.lit(2)).collect()}
    assert got == {"f": True, "n1": True, "n2": False, "t1": False, "t2": False}


def test_rendezvous_moves_only_lost_keys(spark):
    from pyspark.sql import functions as F

    keys = spark.range(200).select(F.col("id").cast("string").alias("k"))
    buckets = spark.createDataFrame([(x,) for x in "abcd"], "b string")
    before = {r.k: r.b for r in rendezvous(keys, "k", buckets, "b").collect()}
    after = {r.k: r.b for r in rendezvous(keys, "k", buckets.filter("b <> 'c'"), "b").collect()}
    assert all(after[k] == v for k, v in before.items() if v != "c") and len(set(before.values())) == 4


def test_lifecycle_rule_is_the_column_rule(spark):
    from itertools import product

    from pyspark.sql import functions as F

    rows = [(s or None, st, st == "trading", o, f) for s, st, o, f in product(["", "baseline", "pending", "pending_official", "active_new", "relist_pending"], ["trading", "preopen", "delisted", "halted"], [True, False], [True, False])]
    frame = spark.createDataFrame(rows, "s string, st string, tr boolean, o boolean, f boolean")
    for r in frame.select("*", lifecycle_step(*[F.col(c) for c in ("s", "st", "tr", "o", "f")]).alias("out")).collect():
        assert r.out == lifecycle_rule(r.s or "", r.st, r.tr, r.o, r.f)
