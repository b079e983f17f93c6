"""Queries: streams over the event table, run to its end."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions.scalar import DAY, HOUR, SECOND, floor_to
from ..operators import books
from ..operators import revisions as rv
from ..operators.trades import INTERVALS
from ..shared import shared_dir
from ..shipping import ship
from ..streaming import jobs as s
from ..streaming import chain, replay, revise, silence
from . import q_books, q_storage, q_telemetry, q_universe
from .tables import EVENTS_SQL, doubles, events, table, trades

KEY = "instrument_key"
#: How long the chain's first windows wait, in ms: trades come within a second of their time.
CHAIN_MS = 1000


def _stream(frame, order=None):
    """A batch table as files of a landing folder, and those as a stream. With order, batches come in that order: files hold
    ranges of it, none of its values is in two files, and as streams take files by time, they get theirs by name."""
    spark = frame.sparkSession
    ship(spark)
    folder = f"{shared_dir(spark)}/landing-{uuid.uuid4()}"
    (frame.repartitionByRange(order).sortWithinPartitions(order) if order else frame).write.parquet(folder)
    if order:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        files = sorted((x.getPath() for x in fs.listStatus(path)), key=lambda x: x.getName())
        first = max(x.getModificationTime() for x in fs.listStatus(path)) - len(files)
        for i, x in enumerate(files):
            fs.setTimes(x, first + i, -1)
        times = [fs.getFileStatus(x).getModificationTime() for x in files]
        if times != sorted(set(times)):
            raise ValueError(f"{folder}: the store does not keep the files' times")
    return s.file_stream(spark, folder, frame.schema, "*.parquet")


def i1_ingest(spark, sf_dir):
    """Reads the event file itself as it lies; a second run from the same checkpoint adds nothing."""
    folder = f"{shared_dir(spark)}/ingest-{uuid.uuid4()}"
    schema = table(spark, sf_dir, "events").schema
    for _ in range(2):
        s.run_available(s.file_stream(spark, sf_dir, schema, "events.parquet"), f"{folder}/out", f"{folder}/checkpoint")
    return spark.read.parquet(f"{folder}/out").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"))


def i2_stream_bars(spark, sf_dir):
    e = trades(spark, sf_dir).select(KEY, "time_ns", "record_index", "price", "quantity", F.timestamp_micros(F.expr("time_ns div 1000")).alias("ts"))
    bars = s.windowed_bars(_stream(e, "time_ns"), [KEY], "ts", "1 hour", ["time_ns", "record_index"], delay=None)
    rows = s.results(bars, "update", [KEY, "window_start"])
    return doubles(rows.withColumn("window_start", F.unix_micros("window_start")))


def i2_chained_bars(spark, sf_dir):
    """All five sizes, each from the closed bars of the one before; the last windows of each size are open still."""
    e = trades(spark, sf_dir).select(KEY, "time_ns", "received_at_ns", "record_index", "price", "quantity", F.timestamp_micros(F.expr("time_ns div 1000")).alias("ts"))
    root = f"{shared_dir(spark)}/chain-{uuid.uuid4()}"
    bars = chain.chained_bars(_stream(e, "received_at_ns"), [KEY], "ts", [i // 1000 for i in INTERVALS], ["time_ns", "record_index"], f"{CHAIN_MS} milliseconds", root)
    return doubles(bars)


def i5_stream_dedup(spark, sf_dir):
    e = trades(spark, sf_dir).select(KEY, "trade_id", F.timestamp_micros(F.expr("time_ns div 1000")).alias("ts"))
    rows = s.results(s.deduplicated(_stream(e, "ts"), [KEY], "ts", "30 days"))
    return rows.groupBy(KEY).agg(F.count(F.lit(1)).alias("kept"), F.count_distinct("trade_id").alias("identifiers"))


def i4_late_revisions(spark, sf_dir):
    late, snaps = q_storage.late_events(spark, sf_dir), q_storage.authorities(spark, sf_dir)
    return s.results(_stream(late), each=lambda batch, _: rv.affected_hours(batch, snaps, [KEY], "t", 12 * HOUR, DAY)).groupBy(KEY, "hour_ns").agg(F.sum("inputs").alias("inputs"), F.min("too_late").alias("too_late"))


#: Lateness up to which a trade's window waits for it, and beyond which it is left to explicit reprocessing, in ns.
DELAY, TOO_LATE = SECOND // 2, SECOND * 9 // 10


def _by_lateness(spark, sf_dir):
    t = trades(spark, sf_dir).select(KEY, "time_ns", "received_at_ns", "record_index", "price", "quantity")
    return t.withColumn("lateness", F.col("received_at_ns") - F.col("time_ns"))


def i3_closed_bars(spark, sf_dir):
    """Hours that the watermark has closed, each told once: rows that come within the delay are all in them."""
    rows = _by_lateness(spark, sf_dir).filter(F.col("lateness") <= DELAY).withColumn("ts", F.timestamp_micros(F.expr("time_ns div 1000")))
    bars = s.windowed_bars(_stream(rows, "received_at_ns"), [KEY], "ts", "1 hour", ["time_ns", "record_index"], f"{DELAY // 1_000_000} milliseconds")
    return doubles(s.results(bars).withColumn("window_start", F.unix_micros("window_start")))


def _hour_bars(rows):
    at = F.struct("time_ns", "record_index")
    return rows.groupBy(KEY, floor_to("time_ns", HOUR).alias("hour_ns")).agg(F.count(F.lit(1)).alias("trades"), F.sum("quantity").alias("volume"), F.max_by("price", at).alias("close"))


def i4_revised_hours(spark, sf_dir):
    """The bars of both revisions: of the trades in time, and of the hours that late ones touched, which a stream wrote anew."""
    rows, root = _by_lateness(spark, sf_dir), f"{shared_dir(spark)}/hours-{uuid.uuid4()}"
    in_time = rows.filter(F.col("lateness") <= DELAY)
    revise.publish_first(in_time, _hour_bars, [KEY], root)
    late = _stream(rows.filter(F.col("lateness") > DELAY), "received_at_ns")
    s.results(late, each=revise.revising(in_time, _hour_bars, [KEY], "time_ns", root, TOO_LATE))
    return doubles(revise.revisions(spark, [KEY], root))


def i6_hysteresis(spark, sf_dir):
    rows = q_universe._months(spark, sf_dir).select("p_partkey", "month", "rank", "eligible")
    return s.in_time(s.results(s.hysteresis(_stream(rows, "month"), "p_partkey", "month", 3), states=True))


def _snapshots(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    status = F.when(F.col("o_orderstatus") == "F", "delisted").when(F.col("o_orderstatus") == "P", "preopen").otherwise("trading")
    return o.select("o_custkey", "o_orderkey", status.alias("status"), (status == "trading").alias("tradable"), (F.col("o_orderkey") % 3 == 0).alias("official_past"), (F.col("o_orderkey") % 5 == 0).alias("first_snapshot"))


def i7_lifecycle(spark, sf_dir):
    return s.in_time(s.results(s.lifecycle(_stream(_snapshots(spark, sf_dir), "o_orderkey"), "o_custkey", "o_orderkey"), states=True))


def i8_book_validity(spark, sf_dir):
    rows = q_books.messages(spark, sf_dir).select(KEY, "seq", "prev_seq", "kind")
    return s.in_time(s.results(s.book_validity(_stream(rows, "seq"), KEY, "seq"), states=True))


def _replay(spark, sf_dir, depth=None):
    rows = q_books.messages(spark, sf_dir).select(KEY, "seq", "prev_seq", "first_seq", "kind", "time_ns", "bids", "asks", "checksum")
    root = f"{shared_dir(spark)}/replay-{uuid.uuid4()}"
    s.results(_stream(rows, "seq"), each=replay.replaying([KEY], "okx", root, depth))
    return replay.told(spark, root)


def i8_book_replay(spark, sf_dir):
    """Validity of each message, and the checksum's text of the book that it leaves, trimmed to ten levels a side."""
    return _replay(spark, sf_dir, 10).filter("NOT late").select("seq", "segment", "valid", "break", F.sha2("text", 256).alias("text_sha256"))


def i8_level_states(spark, sf_dir):
    """The levels at each window's end, as c8_book_states gives them, from the levels that the stream kept from batch to batch."""
    stands = replay.level_lifetimes(_replay(spark, sf_dir), [KEY], q_books.END)
    return q_books.state_sums(books.states_at(stands, [KEY], q_books.STEP))


def i9_silences(spark, sf_dir):
    rows = events(spark, sf_dir).select(KEY, F.col("received_at_ns").alias("at"))
    return s.in_time(s.results(s.silences(_stream(rows, "at"), KEY, "at", 2 * HOUR), states=True))


#: How long an instrument may be silent, in ms.
SILENCE_MS = 2 * HOUR // 1_000_000


def i9_silence_alarms(spark, sf_dir):
    """Every silence is told, also the one at the end, which no event ends."""
    rows = events(spark, sf_dir).select(KEY, F.timestamp_millis(F.expr("received_at_ns div 1000000")).alias("at"))
    return s.results(silence.silence_alarms(_stream(rows, "at"), KEY, "at", "1 second", SILENCE_MS), states=True).select(KEY, "silent_from_ms")


def i10_slo_monitor(spark, sf_dir):
    rows = q_telemetry.lags(spark, sf_dir).select("worker_instance_id", "hour", "lag_ns")
    return s.results(s.slo_monitor(_stream(rows, "hour"), "worker_instance_id", "hour", 2, 4_850_000_000))


def i11_gap_generations(spark, sf_dir):
    rows = q_books.messages(spark, sf_dir).select(KEY, "seq", "prev_seq", "kind")
    found = s.in_time(s.results(s.book_validity(_stream(rows, "seq"), KEY, "seq"), states=True))
    return found.join(rows.select(KEY, "seq"), "seq").groupBy(KEY).agg(F.sum(F.col("break").cast("int")).alias("gaps"), F.sum((~F.col("valid")).cast("int")).alias("invalid"))


QUERIES = {f.__name__: f for f in (i1_ingest, i2_stream_bars, i2_chained_bars, i3_closed_bars, i4_revised_hours, i4_late_revisions, i5_stream_dedup, i6_hysteresis, i7_lifecycle, i8_book_validity, i8_book_replay, i8_level_states, i9_silences, i9_silence_alarms, i10_slo_monitor, i11_gap_generations)}

_VALID = q_books._valid_sql("e4a_link")
ORACLES = {
    "i1_ingest": "SELECT event_type, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM events GROUP BY 1",
    "i2_stream_bars": f"""WITH {EVENTS_SQL} SELECT instrument_key, (time_ns - time_ns % {HOUR}) // 1000 AS window_start, CAST(arg_min(price, (time_ns, record_index)) AS DOUBLE) AS open, CAST(max(price) AS DOUBLE) AS high, CAST(min(price) AS DOUBLE) AS low,
  CAST(arg_max(price, (time_ns, record_index)) AS DOUBLE) AS close, CAST(sum(quantity) AS DOUBLE) AS base_volume, count(*) AS trade_count FROM tr GROUP BY 1, 2""",
    "i5_stream_dedup": f"WITH {EVENTS_SQL} SELECT instrument_key, count(DISTINCT trade_id) + count(*) FILTER (WHERE trade_id IS NULL) AS kept, count(DISTINCT trade_id) AS identifiers FROM tr GROUP BY 1",
    "i6_hysteresis": q_universe.ORACLES["e2_exit_grace"],
    "i8_book_validity": f"WITH {_VALID} SELECT seq, valid, broke AS break FROM val",
    "i9_silences": f"""WITH {EVENTS_SQL}, p AS (SELECT instrument_key, received_at_ns AS t, lag(received_at_ns) OVER (PARTITION BY instrument_key ORDER BY received_at_ns) AS b FROM ev)
SELECT instrument_key, b AS silent_from, t AS silent_to FROM p WHERE t - b > {2 * HOUR}""",
    "i10_slo_monitor": q_telemetry.ORACLES["e8_slo_transitions"],
    "i11_gap_generations": f"WITH {_VALID} SELECT instrument_key, CAST(sum(broke::INT) AS BIGINT) AS gaps, CAST(sum((NOT valid)::INT) AS BIGINT) AS invalid FROM val GROUP BY 1",
}
_HOUR = f"time_ns - time_ns % {HOUR}"
_CLOSED = f"(SELECT (max(time_ns) // 1000000 - {DELAY // 1_000_000}) * 1000000 FROM t)"
ORACLES["i3_closed_bars"] = f"""WITH {EVENTS_SQL}, t AS (SELECT * FROM tr WHERE received_at_ns - time_ns <= {DELAY})
SELECT instrument_key, ({_HOUR}) // 1000 AS window_start, CAST(arg_min(price, (time_ns, record_index)) AS DOUBLE) AS open, CAST(max(price) AS DOUBLE) AS high, CAST(min(price) AS DOUBLE) AS low,
  CAST(arg_max(price, (time_ns, record_index)) AS DOUBLE) AS close, CAST(sum(quantity) AS DOUBLE) AS base_volume, count(*) AS trade_count FROM t GROUP BY 1, 2
HAVING window_start * 1000 + {HOUR} <= {_CLOSED}"""
_BARS = "count(*) AS trades, CAST(sum(quantity) AS DOUBLE) AS volume, CAST(arg_max(price, (time_ns, record_index)) AS DOUBLE) AS close"
ORACLES["i4_revised_hours"] = f"""WITH {EVENTS_SQL}, t AS (SELECT *, {_HOUR} AS hour_ns, received_at_ns - time_ns AS late FROM tr)
SELECT instrument_key, hour_ns, 1 AS rev, {_BARS} FROM t WHERE late <= {DELAY} GROUP BY 1, 2
UNION ALL
SELECT instrument_key, hour_ns, CASE WHEN bool_or(late <= {DELAY}) THEN 2 ELSE 1 END AS rev, {_BARS} FROM t WHERE late <= {TOO_LATE} GROUP BY 1, 2 HAVING bool_or(late > {DELAY})"""
ORACLES["i9_silence_alarms"] = f"""WITH {EVENTS_SQL}, m AS (SELECT DISTINCT instrument_key, received_at_ns // 1000000 AS t FROM ev),
p AS (SELECT *, lead(t) OVER (PARTITION BY instrument_key ORDER BY t) AS after, max(t) OVER () - 1000 AS mark FROM m)
SELECT instrument_key, t AS silent_from_ms FROM p WHERE after - t > {SILENCE_MS} OR (after IS NULL AND mark - t > {SILENCE_MS})"""


def _chain_sql() -> str:
    """Of each size those windows that end by the last start of a closed bar of the size before; of the first, by the watermark."""
    parts, mark = [], f"(SELECT max(time_ns) // 1000000 * 1000 - {CHAIN_MS * 1000} FROM tr)"
    for i, size in enumerate(i // 1000 for i in INTERVALS):
        start = f"time_ns // 1000 - time_ns // 1000 % {size}"
        parts.append(f"""b{i} AS (SELECT instrument_key, {size} AS interval_us, {start} AS window_start, CAST(arg_min(price, (time_ns, record_index)) AS DOUBLE) AS open, CAST(max(price) AS DOUBLE) AS high,
  CAST(min(price) AS DOUBLE) AS low, CAST(arg_max(price, (time_ns, record_index)) AS DOUBLE) AS close, CAST(sum(quantity) AS DOUBLE) AS base_volume, count(*) AS trade_count
  FROM tr WHERE {start} + {size} <= {mark} GROUP BY 1, 2, 3)""")
        mark = f"(SELECT max(window_start) // 1000 * 1000 FROM b{i})"
    return f"WITH {EVENTS_SQL}, {', '.join(parts)} " + " UNION ALL ".join(f"SELECT * FROM b{i}" for i in range(len(INTERVALS)))


ORACLES["i2_chained_bars"] = _chain_sql()
ORACLES["i8_level_states"] = q_books.ORACLES["c8_book_states"]
# The book of each segment, a message at a time: a level is taken out, put in again if it has a quantity, and ten a side stay.
_SIDE = lambda name, side, order: f"""CASE WHEN m.side = '{side}' THEN {order}(list_concat(list_filter({name}, lambda x: x.p <> m.p),
    CASE WHEN m.q > 0 THEN [{{'p': m.p, 'q': m.q}}] ELSE [] END))[:10] ELSE {name} END"""  # noqa: E731
_LEVEL = "coalesce(list_aggregate(list_transform({}, lambda x: ltrim(x.p::VARCHAR, '0') || ltrim(x.q::VARCHAR, '0')), 'string_agg', ''), '')"
ORACLES["i8_book_replay"] = f"""WITH RECURSIVE {_VALID},
mr AS (SELECT instrument_key AS k, segment, seq, side, valid, broke, CAST(floor(price) AS BIGINT) AS p, CASE WHEN CAST(quantity AS INT) % 10 = 0 THEN 0 ELSE CAST(quantity AS INT) END AS q,
  row_number() OVER (PARTITION BY instrument_key, segment ORDER BY seq) AS n FROM val),
book AS (
  SELECT DISTINCT k, segment, CAST(0 AS BIGINT) AS seq, false AS valid, false AS broke, CAST(0 AS BIGINT) AS n, CAST([] AS STRUCT(p BIGINT, q INT)[]) AS bids, CAST([] AS STRUCT(p BIGINT, q INT)[]) AS asks FROM mr
  UNION ALL
  SELECT m.k, m.segment, m.seq, m.valid, m.broke, m.n, {_SIDE('bids', 'bid', 'list_reverse_sort')}, {_SIDE('asks', 'ask', 'list_sort')}
  FROM book JOIN mr m ON m.k = book.k AND m.segment = book.segment AND m.n = book.n + 1)
SELECT seq, CAST(segment AS BIGINT) AS segment, valid, broke AS break, sha256({_LEVEL.format('asks')} || {_LEVEL.format('bids')}) AS text_sha256 FROM book WHERE n > 0"""
ORACLES["i4_late_revisions"] = q_storage.ORACLES["c11_affected_hours"]
ORACLES["i7_lifecycle"] = """WITH RECURSIVE o AS (
  SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n, o_orderstatus = 'F' AS gone, o_orderstatus = 'P' AS pre, o_orderkey % 3 = 0 AS official, o_orderkey % 5 = 0 AS first FROM orders),
f AS (
  SELECT o_custkey, o_orderkey, n, state, CAST(state = 'active_new' AS BIGINT) AS generation
  FROM (SELECT *, CASE WHEN gone THEN 'relist_pending' WHEN pre AND official THEN 'pending_official' WHEN pre THEN 'pending' WHEN official OR NOT first THEN 'active_new' ELSE 'baseline' END AS state FROM o WHERE n = 1)
  UNION ALL
  SELECT o_custkey, o_orderkey, n, state, generation + CAST(state = 'active_new' AND before <> 'active_new' AS BIGINT)
  FROM (SELECT o.*, f.generation, f.state AS before, CASE WHEN gone THEN 'relist_pending' WHEN NOT pre AND f.state IN ('relist_pending', 'pending', 'pending_official') THEN 'active_new' ELSE f.state END AS state
        FROM f JOIN o ON o.o_custkey = f.o_custkey AND o.n = f.n + 1))
SELECT o_custkey, o_orderkey, state, generation FROM f"""
