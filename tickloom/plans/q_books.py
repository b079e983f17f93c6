"""Queries: books, derivatives, quality windows, validation."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.scalar import HOUR, contract_quantity, distance_bps, imbalance, microprice, mid, redacted, transform_of, HEADER_NAMES, QUERY_NAMES
from ..operators import books as b
from ..operators import validate as v
from ..operators import windows as w
from .tables import EVENTS_SQL, doubles, events, table, trades

KEY = ["instrument_key"]
STEP = 6 * HOUR
#: Numbers of messages that are one stretch of an instrument's history.
STRETCH = 10_000
END = 1_800_000_000_000_000_000


def messages(spark, sf_dir):
    """Book messages of the events: one level each, every 500th an authority; numbers link to the message before, but for
    some that do not."""
    e = events(spark, sf_dir)
    level = F.array(F.array(F.floor("price").cast("string"), F.when(F.col("quantity") % 10 == 0, F.lit("0")).otherwise(F.col("quantity").cast("int").cast("string"))))
    none = F.array().cast("array<array<string>>")
    bid = F.col("record_index") % 2 == 0
    order = Window.partitionBy(*KEY).orderBy("record_index")
    before = F.lag("record_index").over(order)
    off = F.when(F.col("record_index") % 777 == 5, 1).otherwise(0)
    return e.select(
        *KEY, F.col("record_index").alias("seq"), F.col("received_at_ns").alias("time_ns"), F.when(F.col("record_index") % 500 == 0, "snapshot").otherwise("update").alias("kind"),
        (before + off).alias("prev_seq"), (before + 1 + off).alias("first_seq"), F.when(bid, level).otherwise(none).alias("bids"), F.when(bid, none).otherwise(level).alias("asks"),
        F.crc32(F.col("trade_id").cast("binary")).alias("checksum"), "user_id",
    )


MESSAGES_SQL = f"""{EVENTS_SQL}, m0 AS (SELECT *, record_index AS seq, lag(record_index) OVER (PARTITION BY instrument_key ORDER BY record_index) AS b4, CASE WHEN record_index % 777 = 5 THEN 1 ELSE 0 END AS off FROM ev),
m1 AS (SELECT instrument_key, seq, received_at_ns AS time_ns, CASE WHEN seq % 500 = 0 THEN 'snapshot' ELSE 'update' END AS kind, b4 + off AS prev_seq, b4 + 1 + off AS first_seq, price, quantity, user_id,
  CASE WHEN seq % 2 = 0 THEN 'bid' ELSE 'ask' END AS side FROM m0),
ms AS (SELECT *, sum(CASE WHEN kind = 'snapshot' THEN 1 ELSE 0 END) OVER (PARTITION BY instrument_key ORDER BY seq) AS segment FROM m1)"""


def _continuity(rule):
    def query(spark, sf_dir):
        rows = b.validated(messages(spark, sf_dir), KEY, ["seq"], rule, STRETCH)
        return rows.groupBy(*KEY, "segment").agg(F.count(F.lit(1)).alias("messages"), F.sum(F.col("break").cast("int")).alias("breaks"), F.sum(F.col("valid").cast("int")).alias("valid"))

    return query


def e5_segments(spark, sf_dir):
    return b.segmented(messages(spark, sf_dir), KEY, ["seq"], STRETCH).groupBy(*KEY, "segment").agg(F.min("seq").alias("first"), F.max("seq").alias("last"))


def e6_validity(spark, sf_dir):
    return b.validated(messages(spark, sf_dir), KEY, ["seq"], "okx", STRETCH).select("seq", "valid", "break")


def j3_levels(spark, sf_dir):
    return doubles(b.exploded_levels(messages(spark, sf_dir), ["seq"]))


def _states(spark, sf_dir):
    rows = b.segmented(messages(spark, sf_dir), KEY, ["seq"], STRETCH)
    ends = b.segment_ends(rows, KEY, "time_ns", END)
    levels = b.exploded_levels(rows, [*KEY, "segment", "seq", "time_ns"]).join(ends, [*KEY, "segment"])
    last = rows.groupBy(*KEY).agg(F.max("time_ns").alias("last"))
    stands = b.lifetimes(levels.join(last, KEY).withColumn("until", F.least("until", F.col("last") + 1)), KEY, "seq", "time_ns", "until")
    return b.states_at(stands, KEY, STEP)


def state_sums(states):
    return states.groupBy(*KEY, "window_end_ns", "side").agg(F.count(F.lit(1)).alias("levels"), F.sum("quantity").cast("double").alias("quantity"), F.sum("price").cast("double").alias("prices"))


def c8_book_states(spark, sf_dir):
    return state_sums(_states(spark, sf_dir))


def e20_book_features(spark, sf_dir):
    keys = [*KEY, "window_end_ns"]
    rows = b.book_features(_one_quantity(_states(spark, sf_dir)), keys)
    updates = b.update_counts(messages(spark, sf_dir), KEY, "time_ns", STEP)
    rows = rows.join(updates, keys, "left").fillna(0, ["updates"])
    told = b.validated(messages(spark, sf_dir), KEY, ["seq"], "okx", STRETCH)
    return b.only_valid(rows, b.valid_at_ends(told, KEY, "seq", "time_ns", STEP), KEY, ["updates"])


def _one_quantity(states):
    """Segments can overlap where receive times are out of order; the largest quantity of a price counts."""
    return states.groupBy(*KEY, "window_end_ns", "side", "price").agg(F.max("quantity").alias("quantity"))


def e19_valid_coverage(spark, sf_dir):
    """Of messages of one time the last in order tells the state."""
    rows = b.validated(messages(spark, sf_dir), KEY, ["seq"], "okx", STRETCH)
    return b.valid_coverage(rows.groupBy(*KEY, "time_ns").agg(F.max_by("valid", "seq").alias("valid")), KEY, "time_ns", STEP)


def c9_authority(spark, sf_dir):
    rows = b.last_authority(messages(spark, sf_dir), KEY, ["seq"], ["seq", "time_ns"], STRETCH)
    return rows.select("seq", F.col("authority.seq").alias("authority_seq"))


def d15_deep_features(spark, sf_dir):
    e = events(spark, sf_dir)
    deep = e.select(*KEY, F.col("received_at_ns").alias("time_ns"), *[
        F.array(*[F.array((F.floor("price") + s * (1 + i * (F.col("record_index") % 3))).cast("string"), (F.col("quantity").cast("int") + i).cast("string")) for i in range(3)]).alias(n)
        for n, s in (("bids", -1), ("asks", 1))
    ])
    return b.deep_features(deep, KEY, "time_ns", STEP, (100, 1000)).select(*KEY, "window_start_ns", "snapshots", F.round("bid_100_min", 6).alias("bid_min"), F.round("ask_1000_max", 6).alias("ask_max"), F.round("bid_1000_mean", 3).alias("bid_mean"))


def e4g_checksum_chain(spark, sf_dir):
    rows = b.segmented(messages(spark, sf_dir), KEY, ["seq"], STRETCH)
    return b.checksum_chain(rows.select(*KEY, "segment", "seq", "kind", "bids", "asks", "checksum"), KEY, "seq")


def _updates(spark, sf_dir):
    t = trades(spark, sf_dir)
    some = lambda n, c: F.when(F.col("record_index") % n == 0, c)
    return t.select(
        *KEY, "time_ns", "record_index", some(2, F.col("price")).alias("mark_price"), some(3, F.col("price")).alias("index_price"), some(7, F.col("quantity")).alias("funding_rate"),
        some(5, F.col("quantity") * 10).alias("open_interest"), some(11, F.col("price")).alias("price_limit"), some(29, F.col("quantity")).alias("liquidation"),
    )


def _coverage(spark, sf_dir):
    c = F.when(F.length("event_type") % 3 == 0, "complete").when(F.length("event_type") % 3 == 1, "lossy_window").otherwise("unknown")
    return table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("instrument_key")).agg(F.max(c).alias("coverage"), F.max(F.length("event_type") % 2 == 0).alias("feed_healthy"))


def d16_derivative_windows(spark, sf_dir):
    rows = w.derivative_windows(_updates(spark, sf_dir), KEY, "time_ns", STEP, ["time_ns", "record_index"], _coverage(spark, sf_dir))
    return doubles(rows.select(*KEY, "window_start_ns", "mark_price", "index_price", "premium", "funding_rate", "open_interest", "open_interest_change", "price_limit", "updates"))


def d16b_liquidation_silence(spark, sf_dir):
    rows = w.derivative_windows(_updates(spark, sf_dir), KEY, "time_ns", HOUR, ["time_ns", "record_index"], _coverage(spark, sf_dir))
    return doubles(rows.select(*KEY, "window_start_ns", "coverage", "liquidation"))


def b16_sparse_fields(spark, sf_dir):
    payload = F.to_json(F.struct(F.when(F.col("record_index") % 3 == 0, F.col("price").cast("string")).alias("last"), F.when(F.col("record_index") % 4 == 0, F.col("quantity").cast("string")).alias("volume")))
    t = events(spark, sf_dir).select("record_index", F.from_json(payload, "last string, volume string").alias("t"))
    return t.select("record_index", F.col("t.last").cast("double").alias("last"), F.col("t.volume").cast("double").alias("volume"))


def b11_contract_sizes(spark, sf_dir):
    e = events(spark, sf_dir)
    value = F.when(F.col("user_id") % 3 == 0, "quote").otherwise("base")
    return e.select("record_index", F.round(contract_quantity(F.col("quantity").cast("double"), F.lit(0.5), value, F.lit("base"), F.col("price").cast("double")), 9).alias("base_quantity"))


def _checkpoints(spark, sf_dir):
    return trades(spark, sf_dir).select(*KEY, F.col("time_ns").alias("effective_ns"), "record_index")


def e17_expectation_intervals(spark, sf_dir):
    rows = w.expectation_intervals(_checkpoints(spark, sf_dir), KEY, "effective_ns", "record_index", END)
    return rows.select(*KEY, "record_index", "start_ns", "end_ns")


def d22_quality_windows(spark, sf_dir):
    t = trades(spark, sf_dir)
    kinds = [*w.CONTROL_COUNTS, *w.RATE_COUNTS]
    kind = F.when(F.col("record_index") % 41 == 0, F.get(F.array(*map(F.lit, kinds)), (F.col("record_index") % 7).cast("int")))
    e = t.select(*KEY, "time_ns", "record_index", "time_source", kind.alias("control_kind"), (F.col("received_at_ns") - F.col("time_ns")).alias("latency_ns"), F.concat(F.lit("egress-"), F.col("user_id") % 2).alias("egress_id"))
    x = t.groupBy(*KEY).agg((F.min("time_ns") - STEP).alias("start_ns"), (F.max("time_ns") + STEP).alias("end_ns"))
    return w.quality_windows(x, e, KEY, "time_ns", HOUR)


def c10_control_counts(spark, sf_dir):
    e = events(spark, sf_dir)
    kinds = list(w.CONTROL_COUNTS)
    control = e.select(F.get(F.array(*map(F.lit, kinds)), (F.col("user_id") % 5).cast("int")).alias("control_kind"), F.array(F.col("worker_instance_id"), F.concat_ws(":", "instrument_key", F.col("user_id") % 2)).alias("targets"))
    parts = e.select(F.col("worker_instance_id").alias("part")).union(e.select(F.concat_ws(":", "instrument_key", F.col("user_id") % 3))).distinct()
    return w.control_by_part(control, parts, "part")


def h10_book_math(spark, sf_dir):
    e = events(spark, sf_dir).select("record_index", F.col("price").cast("double").alias("p"), F.col("quantity").cast("double").alias("q"))
    bid, ask = F.col("p"), F.col("p") + 0.5
    r = lambda c: F.round(c, 6)
    return e.select("record_index", r(mid(bid, ask)).alias("mid"), r(microprice(bid, F.col("q"), ask, F.lit(10.0))).alias("microprice"), r(imbalance(F.col("q"), F.lit(10.0))).alias("imbalance"), r(distance_bps(ask, bid)).alias("bps"))


def envelopes(spark, sf_dir):
    """Raw events of the event table, some of them against the rules."""
    e = events(spark, sf_dir)
    n = lambda k, c: F.when(F.col("record_index") % k != 0, c)
    rest = F.col("user_id") % 4 == 0
    transport = F.when(rest, "rest").when(F.col("user_id") % 4 == 1, "internal").otherwise("websocket")
    meta = F.struct(F.col("received_at_ns").alias("request_started_at_ns"), (F.col("received_at_ns") + F.col("record_index") % 7 - 1).alias("request_ended_at_ns"), n(3, F.lit(30)).alias("requested_interval_ns"), n(5, (F.col("record_index") % 60)).alias("effective_interval_ns"))
    return e.select(
        "record_index", transport.alias("transport"), n(13, F.lit("spot")).alias("market"), n(17, F.col("instrument_key")).alias("instrument_key"), n(19, F.col("instrument_key")).alias("wire_symbol"),
        F.when(F.col("user_id") % 4 == 1, "_control").when(F.col("user_id") % 8 == 2, "book_live").when(F.col("user_id") % 8 == 4, "book_live_bootstrap").otherwise("trade").alias("logical_stream"),
        n(23, F.lit("channel")).alias("native_channel"), n(29, F.col("received_at_ns")).alias("event_time_ns"), n(31, F.lit("exchange")).alias("event_time_source"),
        F.when(rest & (F.col("record_index") % 37 != 0), meta).alias("rest_metadata"), n(2, F.lit("valid")).alias("integrity_mode"),
        F.when(F.col("record_index") % 43 == 0, F.lit('{"a":NaN}')).when(F.col("record_index") % 47 == 0, F.lit("{")).otherwise(F.lit('{"a":1}')).alias("payload"),
        F.when(~rest & (F.col("record_index") % 53 != 0), "c").alias("connection_id"), F.when(~rest, F.lit(1)).alias("connection_generation"), n(59, F.lit("e")).alias("egress_id"),
    )


ENVELOPES_SQL = f"""{EVENTS_SQL}, en AS (SELECT record_index AS r, CASE user_id % 4 WHEN 0 THEN 'rest' WHEN 1 THEN 'internal' ELSE 'websocket' END AS transport,
  CASE WHEN user_id % 4 = 1 THEN '_control' WHEN user_id % 8 = 2 THEN 'book_live' WHEN user_id % 8 = 4 THEN 'book_live_bootstrap' ELSE 'trade' END AS stream, user_id % 4 = 0 AND record_index % 37 <> 0 AS meta FROM ev)"""


def b1_envelope_rules(spark, sf_dir):
    return v.checked(envelopes(spark, sf_dir), v.envelope_rules()).select("record_index", F.array_join("reasons", ",").alias("reasons"))


def b2_rest_rules(spark, sf_dir):
    return v.checked(envelopes(spark, sf_dir), v.rest_rules()).select("record_index", F.array_join("reasons", ",").alias("reasons"))


def b3_source_rules(spark, sf_dir):
    _, bad = v.split(envelopes(spark, sf_dir), v.source_rules())
    return bad.select("record_index", F.array_join("reasons", ",").alias("reasons"))


def b4_json_domain(spark, sf_dir):
    good, _ = v.split(envelopes(spark, sf_dir), {"payload_not_json": v.envelope_rules()["payload_not_json"]})
    return good.groupBy("payload").agg(F.count(F.lit(1)).alias("n"))


def b9_research_valid(spark, sf_dir):
    e = envelopes(spark, sf_dir).withColumn("integrity_mode", F.when(F.col("record_index") % 9 == 0, "invalid").otherwise(F.col("integrity_mode")))
    return v.research_valid(e).groupBy("logical_stream").agg(F.count(F.lit(1)).alias("n"))


def b14_redaction(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", F.sha2(redacted("text"), 256).alias("redacted_sha256"), (redacted("text") != F.col("text")).alias("changed"))


def b17_transforms(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    suffix = F.get(F.array(*map(F.lit, ["html", "zst", "json"])), (F.col("page_id") % 3).cast("int"))
    return p.select("page_id", transform_of(F.when(F.col("page_id") % 5 == 0, "passthrough").otherwise("auto"), suffix, F.octet_length("html"), 2000).alias("transform"))


QUERIES = {
    f.__name__: f
    for f in (
        e5_segments, e6_validity, j3_levels, c8_book_states, e20_book_features, e19_valid_coverage, c9_authority, d15_deep_features, e4g_checksum_chain, d16_derivative_windows, d16b_liquidation_silence,
        b16_sparse_fields, b11_contract_sizes, e17_expectation_intervals, d22_quality_windows, c10_control_counts, h10_book_math, b1_envelope_rules, b2_rest_rules, b3_source_rules, b4_json_domain,
        b9_research_valid, b14_redaction, b17_transforms,
    )
}
_RULES = {"e4a_link": "okx", "e4b_range_ids": "binance_spot", "e4c_named_previous": "binance_futures", "e4d_snapshot_chain": "bybit", "e4e_overlap_link": "bitget", "e4f_monotone": "kraken_futures"}
QUERIES |= {name: _continuity(rule) for name, rule in _RULES.items()}

_BREAK = {
    "e4a_link": "prev_seq <> pseq",
    "e4b_range_ids": "seq > seen AND first_seq > seen + 1",
    "e4c_named_previous": "CASE WHEN rn = 2 THEN NOT (first_seq <= pseq AND seq >= pseq) ELSE prev_seq <> pseq END",
    "e4d_snapshot_chain": "false",
    "e4e_overlap_link": "prev_seq <> 0 AND CASE WHEN rn = 2 THEN NOT (prev_seq < pseq AND seq > pseq) ELSE prev_seq <> pseq END",
    "e4f_monotone": "seq <= pseq",
}


def _valid_sql(name: str) -> str:
    return f"""{MESSAGES_SQL}, x AS (SELECT *, lag(seq) OVER w AS pseq, row_number() OVER w AS rn, max(seq) OVER (PARTITION BY instrument_key, segment ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen
  FROM ms WINDOW w AS (PARTITION BY instrument_key, segment ORDER BY seq)),
y AS (SELECT *, CASE WHEN kind = 'snapshot' THEN false ELSE coalesce({_BREAK[name]}, false) END AS broke FROM x),
val AS (SELECT *, segment > 0 AND max(broke::INT) OVER (PARTITION BY instrument_key, segment ORDER BY seq) = 0 AS valid FROM y)"""


_STATES_SQL = f"""{MESSAGES_SQL}, se AS (SELECT instrument_key, segment, coalesce(lead(s) OVER (PARTITION BY instrument_key ORDER BY segment), {END}) AS until FROM (SELECT instrument_key, segment, min(time_ns) AS s FROM ms GROUP BY 1, 2)),
la AS (SELECT instrument_key, max(time_ns) AS last FROM ms GROUP BY 1),
lv AS (SELECT ms.*, floor(price) AS p, CASE WHEN CAST(quantity AS INT) % 10 = 0 THEN 0 ELSE CAST(quantity AS INT) END AS q, least(until, last + 1) AS stop FROM ms JOIN se USING (instrument_key, segment) JOIN la USING (instrument_key)),
li AS (SELECT *, coalesce(lead(time_ns) OVER (PARTITION BY instrument_key, segment, side, p ORDER BY seq), stop) AS upto FROM lv),
st AS (SELECT instrument_key, side, p, q, unnest(range(CAST(time_ns + ({STEP} - time_ns % {STEP}) % {STEP} AS BIGINT), CAST(upto AS BIGINT), {STEP})) AS window_end_ns FROM li WHERE q > 0 AND time_ns < upto)"""

_D = lambda *cs: ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in cs)
_UPD = f"""{EVENTS_SQL}, up AS (SELECT instrument_key, time_ns, record_index AS r, CASE WHEN record_index % 2 = 0 THEN price END AS mark, CASE WHEN record_index % 3 = 0 THEN price END AS idx, CASE WHEN record_index % 7 = 0 THEN quantity END AS fund,
  CASE WHEN record_index % 5 = 0 THEN quantity * 10 END AS oi, CASE WHEN record_index % 11 = 0 THEN price END AS lim, CASE WHEN record_index % 29 = 0 THEN quantity END AS liq FROM tr)"""
_LAST = lambda c: f"arg_max({c}, (time_ns, r)) FILTER (WHERE {c} IS NOT NULL)"


def _redact_sql() -> str:
    """Written out by hand, apart from the lists of names."""
    heads, said = "|".join(reversed(sorted(HEADER_NAMES))), r"(\"([^\"\\\r\n]|\\[^\r\n])*\"|''([^''\\\r\n]|\\[^\r\n])*'')"
    code = lambda c: f"({c}|%{ord(c):02x}|%{ord(c.upper()):02x})"
    asked = "|".join("".join(map(code, n)) for n in reversed(sorted(QUERY_NAMES)))
    text = "text"
    for pattern, to in (
        (r"socks5h?://[^ \t\n\f\r]+", "[REDACTED_PROXY]"), (r"\b(http|https|ws|wss)://[^ \t\n\f\r/?#]*@", r"\1://"), (rf"([?&]({asked})=)[^ \t\n\f\r&]*", r"\1[REDACTED]"),
        (rf"(\b({heads})[ \t\n\f\r]*:[ \t\n\f\r]*)[^\r\n]+", r"\1[REDACTED]"), (rf"([\"'']({heads})[\"''][ \t\n\f\r]*[:,][ \t\n\f\r]*b?){said}", r"\1[REDACTED]"),
        (rf"(\b[a-z0-9_]*(secret|token|password|passwd|api_key|access_key)[a-z0-9_]*[ \t\n\f\r]*=[ \t\n\f\r]*)({said}|[^ \t\n\f\r,;&]+)", r"\1[REDACTED]"),
        (rf"(\bauth[ \t]*=[ \t]*)\([ \t]*b?{said}[ \t]*,[ \t]*b?{said}[ \t]*\)", r"\1[REDACTED]"),
    ):
        text = f"regexp_replace({text}, '{pattern}', '{to}', 'gi')"
    return text


ORACLES = {name: f"WITH {_valid_sql(name)} SELECT instrument_key, segment, count(*) AS messages, CAST(sum(broke::INT) AS BIGINT) AS breaks, CAST(sum(valid::INT) AS BIGINT) AS valid FROM val GROUP BY 1, 2" for name in _RULES}
ORACLES |= {
    "e5_segments": f"WITH {MESSAGES_SQL} SELECT instrument_key, segment, min(seq) AS first, max(seq) AS last FROM ms GROUP BY 1, 2",
    "e6_validity": f"WITH {_valid_sql('e4a_link')} SELECT seq, valid, broke AS break FROM val",
    "j3_levels": f"WITH {MESSAGES_SQL} SELECT seq, side, 0 AS place, CAST(floor(price) AS DOUBLE) AS price, CAST(CASE WHEN CAST(quantity AS INT) % 10 = 0 THEN 0 ELSE quantity END AS DOUBLE) AS quantity FROM ms",
    "c8_book_states": f"WITH {_STATES_SQL} SELECT instrument_key, window_end_ns, side, count(*) AS levels, CAST(sum(q) AS DOUBLE) AS quantity, CAST(sum(p) AS DOUBLE) AS prices FROM st GROUP BY 1, 2, 3",
    "e20_book_features": f"""WITH {_STATES_SQL.replace(MESSAGES_SQL, _valid_sql('e4a_link'))}, ve AS (SELECT instrument_key, time_ns + ({STEP} - time_ns % {STEP}) % {STEP} AS e, arg_max(valid, (time_ns, seq)) AS valid FROM val GROUP BY 1, 2), o AS (SELECT instrument_key, window_end_ns, side, CAST(p AS DOUBLE) AS p, CAST(max(q) AS DOUBLE) AS q FROM st GROUP BY 1, 2, 3, 4),
n AS (SELECT *, row_number() OVER (PARTITION BY instrument_key, window_end_ns, side ORDER BY CASE side WHEN 'bid' THEN -p ELSE p END) AS l FROM o),
f AS (SELECT instrument_key, window_end_ns, max(p) FILTER (WHERE side = 'bid' AND l = 1) AS bid_price, max(q) FILTER (WHERE side = 'bid' AND l = 1) AS bid_quantity, max(p) FILTER (WHERE side = 'ask' AND l = 1) AS ask_price, max(q) FILTER (WHERE side = 'ask' AND l = 1) AS ask_quantity,
  {', '.join(f"coalesce(sum({x}) FILTER (WHERE side = '{s}' AND l <= {d}), 0) AS {s}_{nm}_{d}" for d in (1, 5) for s in ('bid', 'ask') for nm, x in (('quantity', 'q'), ('notional', 'p * q')))} FROM n GROUP BY 1, 2)
SELECT instrument_key, window_end_ns, updates, valid, CASE WHEN valid THEN COLUMNS(* EXCLUDE (instrument_key, window_end_ns, updates, valid)) END FROM (
SELECT f.*, coalesce(ve.valid, false) AS valid, (bid_price + ask_price) / 2 AS mid, ask_price - bid_price AS spread, (bid_price * ask_quantity + ask_price * bid_quantity) / nullif(bid_quantity + ask_quantity, 0) AS microprice,
  (bid_notional_5 - ask_notional_5) / nullif(bid_notional_5 + ask_notional_5, 0) AS imbalance_5, coalesce(updates, 0) AS updates
FROM f LEFT JOIN (SELECT instrument_key, time_ns - time_ns % {STEP} + {STEP} AS window_end_ns, count(*) AS updates FROM ms WHERE kind = 'update' AND seq IS DISTINCT FROM prev_seq GROUP BY 1, 2) u USING (instrument_key, window_end_ns)
  ASOF LEFT JOIN ve ON ve.instrument_key = f.instrument_key AND f.window_end_ns >= ve.e)""",
    "e19_valid_coverage": f"""WITH {_valid_sql('e4a_link')}, a AS (SELECT instrument_key, time_ns, arg_max(valid, seq) AS valid FROM val GROUP BY 1, 2),
n AS (SELECT *, lead(time_ns) OVER (PARTITION BY instrument_key ORDER BY time_ns) AS nx FROM a),
c AS (SELECT instrument_key, time_ns, nx, valid, unnest(range(CAST(time_ns - time_ns % {STEP} AS BIGINT), CAST(nx AS BIGINT), {STEP})) AS window_start_ns FROM n WHERE nx > time_ns)
SELECT instrument_key, window_start_ns, CAST(sum(CASE WHEN valid THEN least(nx, window_start_ns + {STEP}) - greatest(time_ns, window_start_ns) ELSE 0 END) AS BIGINT) AS valid_ns, window_start_ns + {STEP} - max(time_ns) AS staleness_ns FROM c GROUP BY 1, 2""",
    "c9_authority": f"WITH {MESSAGES_SQL} SELECT seq, max(CASE WHEN kind = 'snapshot' THEN seq END) OVER (PARTITION BY instrument_key ORDER BY seq) AS authority_seq FROM ms",
    "d15_deep_features": f"""WITH {EVENTS_SQL}, l AS (SELECT record_index AS r, instrument_key, received_at_ns AS t, s, CAST(floor(price) AS DOUBLE) + CASE s WHEN 'bid' THEN -1 ELSE 1 END * (1 + i * (record_index % 3)) AS p, CAST(quantity AS INT) + i AS q FROM ev, (VALUES ('bid'), ('ask')) a(s), range(3) b(i)),
m AS (SELECT *, (max(CASE WHEN s = 'bid' THEN p END) OVER (PARTITION BY r) + min(CASE WHEN s = 'ask' THEN p END) OVER (PARTITION BY r)) / 2 AS mid FROM l),
c AS (SELECT r, instrument_key, t, coalesce(sum(p * q) FILTER (WHERE s = 'bid' AND abs(p - mid) / mid * 10000 <= 100), 0) AS b100, coalesce(sum(p * q) FILTER (WHERE s = 'bid' AND abs(p - mid) / mid * 10000 <= 1000), 0) AS b1000, coalesce(sum(p * q) FILTER (WHERE s = 'ask' AND abs(p - mid) / mid * 10000 <= 1000), 0) AS a1000 FROM m GROUP BY 1, 2, 3)
SELECT instrument_key, t - t % {STEP} AS window_start_ns, count(*) AS snapshots, round(min(b100), 6) AS bid_min, round(max(a1000), 6) AS ask_max, round(avg(b1000), 3) AS bid_mean FROM c GROUP BY 1, 2""",
    "d16_derivative_windows": f"""WITH {_UPD}, g AS (SELECT instrument_key, time_ns - time_ns % {STEP} AS window_start_ns, {_LAST('mark')} AS mark_price, {_LAST('idx')} AS index_price, {_LAST('fund')} AS funding_rate, {_LAST('oi')} AS open_interest, {_LAST('lim')} AS price_limit,
  arg_min(oi, (time_ns, r)) FILTER (WHERE oi IS NOT NULL) AS f, count(*) AS updates FROM up GROUP BY 1, 2)
SELECT instrument_key, window_start_ns, {_D('mark_price', 'index_price')}, CAST(mark_price - index_price AS DOUBLE) AS premium, {_D('funding_rate', 'open_interest', 'price_limit')}, CAST(open_interest - f AS DOUBLE) AS open_interest_change, updates FROM g""",
    "d16b_liquidation_silence": f"""WITH {_UPD}, g AS (SELECT instrument_key, time_ns - time_ns % {HOUR} AS window_start_ns, sum(liq) AS l FROM up GROUP BY 1, 2)
SELECT instrument_key, window_start_ns, CASE length(instrument_key) % 3 WHEN 0 THEN 'complete' WHEN 1 THEN 'lossy_window' ELSE 'unknown' END AS coverage,
  CAST(coalesce(l, CASE WHEN length(instrument_key) % 6 = 0 THEN 0 END) AS DOUBLE) AS liquidation FROM g""",
    "b16_sparse_fields": f"WITH {EVENTS_SQL} SELECT record_index, CASE WHEN record_index % 3 = 0 THEN CAST(price AS DOUBLE) END AS last, CASE WHEN record_index % 4 = 0 THEN CAST(quantity AS DOUBLE) END AS volume FROM ev",
    "b11_contract_sizes": f"WITH {EVENTS_SQL} SELECT record_index, round(CASE WHEN user_id % 3 = 0 THEN CAST(quantity AS DOUBLE) * 0.5::DOUBLE / nullif(CAST(price AS DOUBLE), 0) ELSE CAST(quantity AS DOUBLE) * 0.5::DOUBLE END, 9) AS base_quantity FROM ev",
    "e17_expectation_intervals": f"""WITH {EVENTS_SQL} SELECT instrument_key, record_index, time_ns AS start_ns, coalesce(lead(time_ns) OVER (PARTITION BY instrument_key ORDER BY time_ns, record_index), {END}) AS end_ns FROM tr QUALIFY end_ns > start_ns""",
    "d22_quality_windows": f"""WITH {EVENTS_SQL}, t AS (SELECT *, CASE WHEN record_index % 41 = 0 THEN ['gap_detected', 'reconnect', 'parse_error', 'checksum_error', 'queue_overflow', 'throttled', 'interval_stretched'][record_index % 7 + 1] END AS k, time_ns - time_ns % {HOUR} AS ws FROM tr),
ch AS (SELECT instrument_key, ws AS window_start_ns, count(*) FILTER (WHERE eg <> b) AS changes FROM (SELECT *, user_id % 2 AS eg, lag(user_id % 2) OVER (PARTITION BY instrument_key, ws ORDER BY time_ns, record_index) AS b FROM t WHERE k IS NULL) GROUP BY 1, 2),
x AS (SELECT instrument_key, min(time_ns) - {STEP} AS a, max(time_ns) + {STEP} AS b FROM t GROUP BY 1), g AS (SELECT instrument_key, unnest(range(a - a % {HOUR}, b, {HOUR})) AS window_start_ns FROM x),
n AS (SELECT instrument_key, ws AS window_start_ns, count(*) FILTER (WHERE k IS NULL) AS i, count(*) FILTER (WHERE k IS NULL AND time_source = 'exchange') AS e, max(received_at_ns - time_ns) FILTER (WHERE k IS NULL) AS l, max(time_ns) FILTER (WHERE k IS NULL) AS last, count(DISTINCT user_id % 2) FILTER (WHERE k IS NULL) AS eg,
  {', '.join(f"count(*) FILTER (WHERE k = '{k}') AS {n}" for k, n in (w.CONTROL_COUNTS | w.RATE_COUNTS).items())} FROM t GROUP BY 1, 2)
SELECT instrument_key, window_start_ns, coalesce(i, 0) AS input_count, coalesce(e, 0) AS exchange_time_count, l AS latency_max_ns, coalesce(eg, 0) AS egress_count, coalesce(changes, 0) AS egress_changes, {', '.join(f'coalesce({n}, 0) AS {n}' for n in (w.CONTROL_COUNTS | w.RATE_COUNTS).values())},
  window_start_ns + {HOUR} - max(last) OVER (PARTITION BY instrument_key ORDER BY window_start_ns) AS last_event_age_ns, CASE WHEN i > 0 THEN e / i END AS exchange_time_ratio FROM g LEFT JOIN n USING (instrument_key, window_start_ns) LEFT JOIN ch USING (instrument_key, window_start_ns)""",
    "c10_control_counts": f"""WITH {EVENTS_SQL}, p AS (SELECT worker_instance_id AS part FROM ev UNION SELECT instrument_key || ':' || (user_id % 3) FROM ev),
c AS (SELECT ['gap_detected', 'reconnect', 'parse_error', 'checksum_error', 'queue_overflow'][user_id % 5 + 1] AS k, unnest([worker_instance_id, instrument_key || ':' || (user_id % 2)]) AS part FROM ev)
SELECT p.part, {', '.join(f"count(*) FILTER (WHERE k = '{k}') AS {n}" for k, n in w.CONTROL_COUNTS.items())} FROM p LEFT JOIN c ON c.part = p.part GROUP BY 1""",
    "h10_book_math": f"""WITH {EVENTS_SQL}, e AS (SELECT record_index, CAST(price AS DOUBLE) AS p, CAST(quantity AS DOUBLE) AS q, CAST(price AS DOUBLE) + 0.5::DOUBLE AS a FROM ev)
SELECT record_index, round((p + a) / 2, 6) AS mid, round((p * 10.0::DOUBLE + a * q) / nullif(q + 10.0::DOUBLE, 0), 6) AS microprice, round((q - 10.0::DOUBLE) / nullif(q + 10.0::DOUBLE, 0), 6) AS imbalance, round((a - p) / nullif(p, 0) * 10000, 6) AS bps FROM e""",
    "b1_envelope_rules": f"""WITH {ENVELOPES_SQL} SELECT r AS record_index, concat_ws(',', CASE WHEN r % 13 = 0 AND stream <> '_control' THEN 'market_missing' END, CASE WHEN (r % 17 = 0) <> (r % 19 = 0) THEN 'instrument_unpaired' END,
  CASE WHEN stream <> '_control' AND r % 17 = 0 THEN 'instrument_missing' END, CASE WHEN r % 23 = 0 AND stream <> '_control' THEN 'channel_missing' END, CASE WHEN (r % 29 = 0) <> (r % 31 = 0) THEN 'event_time_unpaired' END,
  CASE WHEN transport = 'rest' AND NOT meta THEN 'rest_metadata_missing' END, CASE WHEN stream = 'book_live_bootstrap' AND transport <> 'rest' THEN 'bootstrap_transport' END,
  CASE WHEN r % 2 <> 0 AND stream NOT IN ('book_live', 'book_live_bootstrap') THEN 'integrity_scope' END, CASE WHEN r % 43 = 0 OR r % 47 = 0 THEN 'payload_not_json' END) AS reasons FROM en""",
    "b2_rest_rules": f"""WITH {ENVELOPES_SQL} SELECT r AS record_index, concat_ws(',', CASE WHEN meta AND r % 7 = 0 THEN 'request_times' END, CASE WHEN meta AND (r % 3 = 0) <> (r % 5 = 0) THEN 'intervals_unpaired' END,
  CASE WHEN meta AND r % 3 <> 0 AND r % 5 <> 0 AND r % 60 < 30 THEN 'interval_shrunk' END) AS reasons FROM en""",
    "b3_source_rules": f"""WITH {ENVELOPES_SQL}, s AS (SELECT *, transport <> 'rest' AND r % 53 <> 0 AS conn, r % 59 <> 0 AS eg, transport = 'websocket' OR stream = 'book_live_bootstrap' AS needs FROM en),
q AS (SELECT r AS record_index, concat_ws(',', CASE WHEN conn <> (transport <> 'rest') THEN 'connection_unpaired' END, CASE WHEN transport = 'internal' AND (conn OR eg) THEN 'source_internal' END,
  CASE WHEN transport <> 'internal' AND needs AND NOT (conn AND eg) THEN 'source_connection' END, CASE WHEN transport <> 'internal' AND NOT needs AND (conn OR NOT eg) THEN 'source_rest' END) AS reasons FROM s) SELECT * FROM q WHERE reasons <> ''""",
    "b4_json_domain": "SELECT '{\"a\":1}' AS payload, count(*) AS n FROM events WHERE event_id % 43 <> 0 AND event_id % 47 <> 0",
    "b9_research_valid": f"WITH {ENVELOPES_SQL} SELECT stream AS logical_stream, count(*) AS n FROM en WHERE r % 9 <> 0 GROUP BY 1",
    "b14_redaction": f"SELECT doc_id, sha256({_redact_sql()}) AS redacted_sha256, {_redact_sql()} <> text AS changed FROM documents",
    "b17_transforms": "SELECT page_id, CASE WHEN page_id % 5 = 0 OR page_id % 3 = 1 OR strlen(html) < 2000 THEN 'passthrough' ELSE 'zstd' END AS transform FROM pages",
}
