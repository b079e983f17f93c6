"""Queries: histograms, monitoring, resources, request logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.histograms import BOUNDS_NS, bucket_of, histogram, merged, nearest_rank
from ..functions.scalar import HOUR, SECOND, disk_state, floor_to, request_outcome, retry_after_ns
from ..operators import telemetry as t
from .tables import EVENTS_SQL, events, table

WORKER = ["worker_instance_id"]


def lags(spark, sf_dir):
    """Latency samples: lag from the event's price, in nanoseconds; second of receipt in steps of an hour."""
    e = events(spark, sf_dir)
    return e.withColumns({"lag_ns": (F.col("price") * 10_000_000).cast("long"), "hour": ((F.col("received_at_ns") - F.pmod("received_at_ns", F.lit(HOUR))) / HOUR).cast("long")})


LAGS_SQL = f"{EVENTS_SQL}, lg AS (SELECT *, CAST(floor(CAST(price AS DECIMAL(38,9)) * 10000000) AS BIGINT) AS lag_ns, received_at_ns // {HOUR} AS hour FROM ev)"
_BUCKET = "CASE " + " ".join(f"WHEN lag_ns <= {b} THEN {i}" for i, b in enumerate(BOUNDS_NS)) + " END"


def _rank_sql(percent: int, source: str, keys: str) -> str:
    """Nearest-rank quantile straight from the samples' bucket bounds."""
    bound = "CASE " + " ".join(f"WHEN lag_ns <= {b} THEN {b}" for b in BOUNDS_NS) + " END"
    return f"SELECT {keys}, list_sort(list({bound}))[greatest(1, CAST(ceil(count(*) * {percent} / 100.0) AS BIGINT))] AS p{percent}_ns FROM {source} GROUP BY {keys}"


def d7_histogram(spark, sf_dir):
    h = histogram(lags(spark, sf_dir), WORKER, "lag_ns")
    return h.select(*WORKER, "samples", F.col("lag_total_ns").cast("long").alias("lag_total_ns"), "lag_max_ns", F.posexplode("buckets").alias("bucket", "n")).filter("n > 0")


def d8_quantiles(spark, sf_dir):
    h = histogram(lags(spark, sf_dir), WORKER, "lag_ns")
    return h.select(*WORKER, *[nearest_rank(F.col("buckets"), p).alias(f"p{p}_ns") for p in (50, 99)])


def d9_histogram_merge(spark, sf_dir):
    parts = histogram(lags(spark, sf_dir), ["hour", *WORKER], "lag_ns")
    whole = merged(parts, WORKER)
    return whole.select(*WORKER, "samples", F.col("lag_total_ns").cast("long").alias("lag_total_ns"), nearest_rank(F.col("buckets"), 95).alias("p95_ns"))


def d10_round_peaks(spark, sf_dir):
    rows = lags(spark, sf_dir).groupBy("instrument_key", "hour", *WORKER).agg(F.max("lag_ns").alias("lag_ns"), F.count(F.lit(1)).alias("events"))
    return t.round_peaks(rows, ["instrument_key"], "hour", ["lag_ns", "events"])


def _samples(spark, sf_dir):
    rows = lags(spark, sf_dir)
    return rows.groupBy("instrument_key", "hour", *WORKER).agg(F.sum(F.col("price").cast("long") * 1000).alias("rss"), (F.min("hour") * 3600).alias("t"))


def d13_resources(spark, sf_dir):
    return t.resource_summary(_samples(spark, sf_dir), ["instrument_key"], "hour", "t", "rss", 7200)


def d14_health(spark, sf_dir):
    rows = lags(spark, sf_dir).groupBy("instrument_key", "hour").agg(F.min("received_at_ns").alias("started"), F.max("received_at_ns").alias("completed"), F.max("lag_ns").alias("lag_ns"))
    return t.health_summary(rows, ["instrument_key"], "hour", "started", "completed", 30 * 24 * HOUR, HOUR, F.col("lag_ns") > 4_890_000_000)


def d23_conservation(spark, sf_dir):
    o = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("accepted"), F.count(F.when(F.col("l_returnflag") == "N", 1)).alias("durable"), F.count(F.when(F.col("l_returnflag") == "R", 1)).alias("unpersisted"),
        F.count(F.when((F.col("l_returnflag") == "A") & (F.col("l_orderkey") % 97 != 0), 1)).alias("uncertain"), F.collect_list(F.lit(1).cast("long")).alias("series"),
    )
    found = t.conservation_breaks(o, {"accepted": ["durable", "unpersisted", "uncertain"]}, {"accepted": "series"})
    return found.select("l_orderkey", "accepted", F.array_join("breaks", ",").alias("breaks"))


def d26_request_log(spark, sf_dir):
    log = _requests(spark, sf_dir)
    h = histogram(log, ["endpoint", "outcome"], "lag_ns")
    return h.select("endpoint", "outcome", F.col("samples").alias("requests"), nearest_rank(F.col("buckets"), 99).alias("p99_ns"))


def _requests(spark, sf_dir):
    status = F.get(F.array(*[F.lit(s) for s in _STATUSES]), (F.col("record_index") % len(_STATUSES)).cast("int"))
    ban = (F.col("record_index") % 211 == 0)
    return lags(spark, sf_dir).withColumns({"endpoint": F.col("instrument_key"), "status": status}).withColumn("outcome", request_outcome("status", ban))


_STATUSES = [200, 200, 200, 429, 418, 500, 404, 503, 408]


def b12_request_outcome(spark, sf_dir):
    return _requests(spark, sf_dir).groupBy("status", "outcome").agg(F.count(F.lit(1)).alias("n"))


def b13_retry_after(spark, sf_dir):
    e = events(spark, sf_dir)
    k = F.col("record_index") % 4
    date = F.date_format(F.timestamp_seconds(F.floor(F.col("received_at_ns") / SECOND) + F.col("record_index") % 100), "EEE, dd MMM yyyy HH:mm:ss 'GMT'")
    header = F.when(k == 0, (F.col("record_index") % 120).cast("string")).when(k == 1, date).when(k == 2, F.lit("soon"))
    return e.select("record_index", retry_after_ns(header, F.col("received_at_ns")).alias("delay_ns"))


def b15_disk_state(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", disk_state(F.col("o_totalprice"), F.lit(500_000.0), (0.2, 60_000), (0.05, 30_000)).alias("state"))


def d28_bounded_labels(spark, sf_dir):
    rows = t.bounded_labels(lags(spark, sf_dir).withColumn("label", F.concat_ws("-", "instrument_key", F.col("user_id") % 3)), "label", ["click-0", "view-1", "purchase-2"])
    return rows.groupBy("label").agg(F.count(F.lit(1)).alias("samples"), F.sum("lag_ns").alias("lag_total_ns"))


def e7_rolling_histogram(spark, sf_dir):
    return t.rolling_histogram(lags(spark, sf_dir), WORKER, "hour", "lag_ns")


def e8_slo_transitions(spark, sf_dir):
    rolled = t.rolling_histogram(lags(spark, sf_dir), WORKER, "hour", "lag_ns", 2)
    return t.slo_transitions(rolled, WORKER, "hour", 4_850_000_000).select(*WORKER, "hour", "state")


def e9_interval_changes(spark, sf_dir):
    e = events(spark, sf_dir).withColumn("effective", F.col("quantity").cast("long") - F.col("quantity").cast("long") % 25 + 30)
    return t.interval_changes(e, ["instrument_key"], ["record_index"], "effective").groupBy("instrument_key", "direction").agg(F.count(F.lit(1)).alias("changes"), F.sum("effective").alias("effective"))


def e10_largest_gap(spark, sf_dir):
    return t.largest_gap(events(spark, sf_dir), ["instrument_key"], "received_at_ns")


def e11_counter_violations(spark, sf_dir):
    e = events(spark, sf_dir).withColumns({"a": F.col("record_index") * 2 - F.when(F.col("record_index") % 500 == 7, 9000).otherwise(0), "b": F.array(F.col("record_index"), -F.col("record_index") % 3)})
    return t.counter_violations(e, WORKER, ["record_index"], ["a", "b"]).select("record_index", F.array_join("broken", ",").alias("broken"))


def e12_counter_deltas(spark, sf_dir):
    e = events(spark, sf_dir).withColumn("counter", F.col("record_index") % 1000)
    return t.counter_deltas(e, WORKER, ["record_index"], "counter").groupBy(*WORKER).agg(F.sum("delta").alias("growth"), F.count(F.when(F.col("restarted"), 1)).alias("restarts"))


def e21_failure_runs(spark, sf_dir):
    log = _requests(spark, sf_dir).withColumn("until", F.col("received_at_ns") + F.col("lag_ns"))
    rows = t.failure_runs(log, ["endpoint"], ["record_index"], F.col("outcome") != "do_not_retry", "until")
    return rows.select("endpoint", "record_index", "consecutive_failures", "cooldown_until")


_ALLOWED = [(None, "A"), ("A", "A"), ("A", "N"), ("N", "N"), ("N", "R"), ("R", "A")]


def e22_state_transitions(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem")
    return t.invalid_transitions(l, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"], "l_returnflag", _ALLOWED).groupBy("previous", "l_returnflag").agg(F.count(F.lit(1)).alias("n"))


def e23_oldest_open(spark, sf_dir):
    e = lags(spark, sf_dir).withColumns({"accepted": F.expr(f"received_at_ns div {SECOND}"), "done": F.expr(f"received_at_ns div {SECOND} + lag_ns div 1000000")})
    records = e.select("instrument_key", "accepted", F.when(F.col("record_index") % 7 != 0, F.col("done")).otherwise(F.col("accepted") + 9000).alias("done"))
    samples = e.select("instrument_key", F.col("accepted").alias("at")).distinct()
    return t.oldest_open_age(records, samples, ["instrument_key"], "accepted", "done", "at", 6000, 3600)


QUERIES = {
    f.__name__: f
    for f in (
        d7_histogram, d8_quantiles, d9_histogram_merge, d10_round_peaks, d13_resources, d14_health, d23_conservation, d26_request_log, b12_request_outcome, b13_retry_after, b15_disk_state,
        d28_bounded_labels, e7_rolling_histogram, e8_slo_transitions, e9_interval_changes, e10_largest_gap, e11_counter_violations, e12_counter_deltas, e21_failure_runs, e22_state_transitions, e23_oldest_open,
    )
}

_STATUS = f"[{', '.join(map(str, _STATUSES))}][record_index % {len(_STATUSES)} + 1]"
_REQUESTS = f"""{LAGS_SQL}, rq AS (SELECT *, instrument_key AS endpoint, {_STATUS} AS status,
  CASE WHEN record_index % 211 = 0 OR {_STATUS} = 418 THEN 'ban' WHEN {_STATUS} = 429 THEN 'throttle' WHEN {_STATUS} IN (408, 425, 500, 502, 503, 504) THEN 'backoff' ELSE 'do_not_retry' END AS outcome FROM lg)"""


def _rolling(seconds: int) -> str:
    bound = "CASE " + " ".join(f"WHEN lag_ns <= {b} THEN {b}" for b in BOUNDS_NS) + " END"
    ranks = ", ".join(f"list_sort(list(bound))[greatest(1, CAST(ceil(count(*) * {p} / 100.0) AS BIGINT))] AS p{p}_ns" for p in (50, 95, 99))
    return f"""h AS (SELECT DISTINCT worker_instance_id, hour FROM lg),
rolled AS (SELECT h.worker_instance_id, h.hour, count(*) AS samples, max(lag_ns) AS lag_max_ns, {ranks}
  FROM h JOIN (SELECT *, {bound} AS bound FROM lg) s ON s.worker_instance_id = h.worker_instance_id AND s.hour BETWEEN h.hour - {seconds - 1} AND h.hour GROUP BY 1, 2)"""


ORACLES = {
    "d7_histogram": f"""WITH {LAGS_SQL}, b AS (SELECT worker_instance_id, {_BUCKET} AS bucket, count(*) AS n FROM lg GROUP BY 1, 2),
s AS (SELECT worker_instance_id, count(*) AS samples, CAST(sum(lag_ns) AS BIGINT) AS lag_total_ns, max(lag_ns) AS lag_max_ns FROM lg GROUP BY 1)
SELECT worker_instance_id, samples, lag_total_ns, lag_max_ns, bucket, n FROM s JOIN b USING (worker_instance_id)""",
    "d8_quantiles": f"WITH {LAGS_SQL}, a AS ({_rank_sql(50, 'lg', 'worker_instance_id')}), b AS ({_rank_sql(99, 'lg', 'worker_instance_id')}) SELECT * FROM a JOIN b USING (worker_instance_id)",
    "d9_histogram_merge": f"""WITH {LAGS_SQL}, a AS ({_rank_sql(95, 'lg', 'worker_instance_id')})
SELECT worker_instance_id, count(*) AS samples, CAST(sum(lag_ns) AS BIGINT) AS lag_total_ns, any_value(p95_ns) AS p95_ns FROM lg JOIN a USING (worker_instance_id) GROUP BY 1""",
    "d10_round_peaks": f"""WITH {LAGS_SQL}, w AS (SELECT instrument_key, hour, worker_instance_id, max(lag_ns) AS l, count(*) AS e FROM lg GROUP BY 1, 2, 3),
r AS (SELECT instrument_key, hour, sum(l) AS l, sum(e) AS e FROM w GROUP BY 1, 2)
SELECT instrument_key, count(*) AS rounds, CAST(max(l) AS BIGINT) AS peak_lag_ns, CAST(max(e) AS BIGINT) AS peak_events FROM r GROUP BY 1""",
    "d13_resources": f"""WITH {LAGS_SQL}, r AS (SELECT instrument_key, hour, CAST(sum(CAST(floor(price) AS BIGINT) * 1000) AS BIGINT) AS v FROM lg GROUP BY 1, 2),
x AS (SELECT *, (hour - min(hour) OVER (PARTITION BY instrument_key)) * 3600 AS x FROM r),
s AS (SELECT instrument_key, count(*) AS rounds, max(v) AS peak, arg_max(v, x) - arg_min(v, x) FILTER (WHERE x >= 7200) AS growth, CAST(count(*) FILTER (WHERE x >= 7200) AS HUGEINT) AS n,
  CAST(sum(x) FILTER (WHERE x >= 7200) AS HUGEINT) AS sx, CAST(sum(v) FILTER (WHERE x >= 7200) AS HUGEINT) AS sy, CAST(sum(x::HUGEINT * v) FILTER (WHERE x >= 7200) AS HUGEINT) AS sxy,
  CAST(sum(x::HUGEINT * x) FILTER (WHERE x >= 7200) AS HUGEINT) AS sxx FROM x GROUP BY 1)
SELECT instrument_key, rounds, peak, growth, greatest(0.0, CAST(n * sxy - sx * sy AS DOUBLE) * 60 / CAST(n * sxx - sx * sx AS DOUBLE)) AS slope_per_minute FROM s""",
    "d14_health": f"""WITH {LAGS_SQL}, r AS (SELECT instrument_key, hour, min(received_at_ns) AS a, max(received_at_ns) AS b, max(lag_ns) AS l FROM lg GROUP BY 1, 2),
g AS (SELECT *, hour - lag(hour) OVER (PARTITION BY instrument_key ORDER BY hour) AS gap FROM r)
SELECT instrument_key, count(*) AS sample_count, max(b) - min(a) AS coverage, coalesce(max(gap), 0) AS max_gap, count(*) FILTER (WHERE l > 4890000000) AS critical_count,
  {30 * 24 - 1} AS expected_count, {30 * 24 * HOUR - 2 * HOUR} AS required_coverage, count(*) >= {30 * 24 - 1} AS count_valid, max(b) - min(a) >= {30 * 24 * HOUR - 2 * HOUR} AS coverage_valid,
  count(*) FILTER (WHERE l > 4890000000) = 0 AS healthy FROM g GROUP BY 1""",
    "d23_conservation": """SELECT l_orderkey, count(*) AS accepted, 'accepted' AS breaks FROM lineitem GROUP BY 1 HAVING l_orderkey % 97 = 0 AND count(*) FILTER (WHERE l_returnflag = 'A') > 0""",
    "d26_request_log": f"""WITH {_REQUESTS}, q AS ({_rank_sql(99, 'rq', 'endpoint, outcome')})
SELECT endpoint, outcome, count(*) AS requests, any_value(p99_ns) AS p99_ns FROM rq JOIN q USING (endpoint, outcome) GROUP BY 1, 2""",
    "b12_request_outcome": f"WITH {_REQUESTS} SELECT status, outcome, count(*) AS n FROM rq GROUP BY 1, 2",
    "b13_retry_after": f"""WITH {EVENTS_SQL} SELECT record_index, CASE record_index % 4 WHEN 0 THEN record_index % 120 * {SECOND}
  WHEN 1 THEN greatest(0, (received_at_ns // {SECOND} + record_index % 100) * {SECOND} - received_at_ns) END AS delay_ns FROM ev""",
    "b15_disk_state": """SELECT o_orderkey, CASE WHEN o_totalprice < 0.05 * 500000.0 OR o_totalprice < 30000 THEN 'critical' WHEN o_totalprice < 0.2 * 500000.0 OR o_totalprice < 60000 THEN 'low' ELSE 'ok' END AS state FROM orders""",
    "d28_bounded_labels": f"""WITH {LAGS_SQL}, l AS (SELECT lag_ns, instrument_key || '-' || (user_id % 3) AS label FROM lg)
SELECT CASE WHEN label IN ('click-0', 'view-1', 'purchase-2') THEN label ELSE '_other' END AS label, count(*) AS samples, CAST(sum(lag_ns) AS BIGINT) AS lag_total_ns FROM l GROUP BY 1""",
    "e7_rolling_histogram": f"WITH {LAGS_SQL}, {_rolling(60)} SELECT * FROM rolled",
    "e8_slo_transitions": f"""WITH {LAGS_SQL}, {_rolling(2)}, s AS (SELECT worker_instance_id, hour, lag_max_ns > 4850000000 OR p99_ns > 4850000000 AS state FROM rolled),
p AS (SELECT *, coalesce(lag(state) OVER (PARTITION BY worker_instance_id ORDER BY hour), false) AS before FROM s) SELECT worker_instance_id, hour, state FROM p WHERE state <> before""",
    "e9_interval_changes": f"""WITH {EVENTS_SQL}, e AS (SELECT instrument_key, record_index, CAST(quantity AS BIGINT) - CAST(quantity AS BIGINT) % 25 + 30 AS effective FROM ev),
p AS (SELECT *, lag(effective) OVER (PARTITION BY instrument_key ORDER BY record_index) AS before FROM e)
SELECT instrument_key, CASE WHEN effective > before THEN 'stretch' ELSE 'recover' END AS direction, count(*) AS changes, CAST(sum(effective) AS BIGINT) AS effective FROM p WHERE before <> effective GROUP BY 1, 2""",
    "e10_largest_gap": f"""WITH {EVENTS_SQL}, g AS (SELECT instrument_key, received_at_ns - lag(received_at_ns) OVER (PARTITION BY instrument_key ORDER BY received_at_ns) AS gap FROM ev)
SELECT instrument_key, coalesce(max(gap), 0) AS max_gap, count(*) AS samples FROM g GROUP BY 1""",
    "e11_counter_violations": f"""WITH {EVENTS_SQL}, e AS (SELECT record_index, worker_instance_id, record_index * 2 - CASE WHEN record_index % 500 = 7 THEN 9000 ELSE 0 END AS a, -record_index % 3 AS b FROM ev),
p AS (SELECT *, a < lag(a) OVER w AS fa, b < lag(b) OVER w AS fb FROM e WINDOW w AS (PARTITION BY worker_instance_id ORDER BY record_index))
SELECT record_index, concat_ws(',', CASE WHEN fa THEN 'a' END, CASE WHEN fb THEN 'b' END) AS broken FROM p WHERE fa OR fb""",
    "e12_counter_deltas": f"""WITH {EVENTS_SQL}, p AS (SELECT worker_instance_id, record_index % 1000 AS c, lag(record_index % 1000) OVER (PARTITION BY worker_instance_id ORDER BY record_index) AS b FROM ev)
SELECT worker_instance_id, CAST(sum(CASE WHEN b IS NULL OR c < b THEN c ELSE c - b END) AS BIGINT) AS growth, count(*) FILTER (WHERE c < b) AS restarts FROM p GROUP BY 1""",
    "e21_failure_runs": f"""WITH {_REQUESTS}, f AS (SELECT *, outcome <> 'do_not_retry' AS failed, sum(CASE WHEN outcome = 'do_not_retry' THEN 1 ELSE 0 END) OVER (PARTITION BY endpoint ORDER BY record_index) AS run FROM rq)
SELECT endpoint, record_index, CAST(sum(CASE WHEN failed THEN 1 ELSE 0 END) OVER (PARTITION BY endpoint, run ORDER BY record_index) AS BIGINT) AS consecutive_failures,
  max(CASE WHEN failed THEN received_at_ns + lag_ns END) OVER (PARTITION BY endpoint ORDER BY record_index) AS cooldown_until FROM f""",
    "e22_state_transitions": """WITH p AS (SELECT l_returnflag, lag(l_returnflag) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS previous FROM lineitem)
SELECT previous, l_returnflag, count(*) AS n FROM p WHERE coalesce(previous, '-') || l_returnflag NOT IN ('-A', 'AA', 'AN', 'NN', 'NR', 'RA') GROUP BY 1, 2""",
    "e23_oldest_open": f"""WITH {LAGS_SQL}, r AS (SELECT instrument_key, record_index, received_at_ns // {SECOND} AS a, CASE WHEN record_index % 7 <> 0 THEN received_at_ns // {SECOND} + lag_ns // 1000000 ELSE received_at_ns // {SECOND} + 9000 END AS d FROM lg),
s AS (SELECT DISTINCT instrument_key, a AS at_ FROM r),
o AS (SELECT s.instrument_key, s.at_, min(r.a) AS a FROM s JOIN r ON r.instrument_key = s.instrument_key AND r.a <= s.at_ AND r.d > s.at_ GROUP BY 1, 2)
SELECT s.instrument_key, s.at_ AS "at", s.at_ - o.a AS age, coalesce(s.at_ - o.a > 6000, false) AS critical FROM s LEFT JOIN o ON o.instrument_key = s.instrument_key AND o.at_ = s.at_""",
}
