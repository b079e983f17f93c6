"""Queries: scalar functions, sinks, commits."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions.scalar import added, canonical_json, ceil_ratio, first_true, half_even, row_digest, steps, wire_symbols
from ..operators import revisions as rv
from ..shared import shared_dir
from ..sources import raw
from .tables import EVENTS_SQL, doubles, events, table


def h5_exact_math(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem")
    return doubles(l.select("l_orderkey", "l_linenumber", "l_partkey", ceil_ratio("l_orderkey", F.col("l_linenumber").cast("long")).alias("up"), half_even("l_partkey", F.lit(8), 2).alias("even")))


def h6_arrays(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_set("l_suppkey")).alias("s"), F.sort_array(F.collect_list("l_linenumber")).alias("n"))
    big = F.transform("s", lambda x: x > 50)
    said = lambda a: F.array_join(F.transform(a, lambda x: x.cast("string")), ",")
    return l.select("l_orderkey", said(added("s", F.col("n").cast("array<bigint>"))).alias("sums"), said(steps("s")).alias("steps"), first_true(big).cast("long").alias("first_big"))


def h7_maps(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    m = wire_symbols(F.array(F.lit("trade"), F.lit("book")), F.array(F.lower("p_name"), F.upper("p_brand")))
    return p.select("p_partkey", F.explode(m).alias("channel", "symbol"))


def h8_json(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    doc = F.parse_json("props")
    return e.select("event_id", F.variant_get(doc, "$.k", "long").alias("k"), canonical_json("event_id", "event_type").alias("json"))


def h1_text(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return c.groupBy(F.lower(F.trim("c_mktsegment")).alias("segment")).agg(F.count_distinct(F.lower("c_name")).alias("names"))


def a3_hour_sink(spark, sf_dir):
    folder = f"{shared_dir(spark)}/hours-{uuid.uuid4()}"
    e = events(spark, sf_dir)
    raw.write_hours(e.select(F.lit("x").alias("exchange"), F.lit("spot").alias("market"), "instrument_key", F.lit("trade").alias("logical_stream"), (F.col("received_at_ns") - F.pmod("received_at_ns", F.lit(240 * 3_600_000_000_000))).alias("received_at_ns"), "record_index"), folder)
    return spark.read.parquet(folder).groupBy("p_key", F.col("p_hour").cast("string").alias("p_hour")).agg(F.count(F.lit(1)).alias("n"), F.sum("record_index").alias("ids"))


def a7_revisions(spark, sf_dir):
    """Two revisions of one partition; the reader sees the second, which names the first."""
    folder = f"{shared_dir(spark)}/revisions-{uuid.uuid4()}"
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", row_digest("o_orderkey").alias("digest"))
    first = rv.publish_revision(o.filter("o_orderkey % 2 = 0"), folder, None, {"dataset": "orders"}, 1, ["b", "a"], "digest").withColumn("committed", F.lit(True))
    second = rv.publish_revision(o, folder, first, {"dataset": "orders"}, 2, ["c"], "digest").withColumn("committed", F.lit(True))
    table_ = first.unionByName(second)
    rows = rv.read_latest(spark, table_, ["dataset"], folder).groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    newest = rv.latest_revisions(table_, ["dataset"]).select("rev", "supersedes", "records")
    return rows.crossJoin(F.broadcast(newest))  # one row


def g7_optimistic_commit(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    state = o.filter("o_custkey % 3 <> 0").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("revision"))
    proposals = o.select("o_custkey", F.col("o_orderkey").alias("proposal"), F.when(F.col("o_custkey") % 3 != 0, F.col("o_orderkey") % 20).alias("expected_revision"))
    return rv.committed_if_current(state, proposals, ["o_custkey"]).select("proposal", "accepted", "revision")


QUERIES = {f.__name__: f for f in (h5_exact_math, h6_arrays, h7_maps, h8_json, h1_text, a3_hour_sink, a7_revisions, g7_optimistic_commit)}

ORACLES = {
    "h5_exact_math": """WITH x AS (SELECT l_orderkey, l_linenumber, l_partkey, (l_orderkey + l_linenumber - 1) // l_linenumber AS up, l_partkey * 100 // 8 AS q, l_partkey * 100 % 8 AS r FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, up, CAST(CASE WHEN r > 4 OR (r = 4 AND q % 2 = 1) THEN q + 1 ELSE q END AS DOUBLE) / 100 AS even FROM x""",
    "h6_arrays": """WITH g AS (SELECT l_orderkey, list_sort(list_distinct(list(l_suppkey))) AS s, list_sort(list(l_linenumber)) AS n FROM lineitem GROUP BY 1)
SELECT l_orderkey, array_to_string(list_transform(range(1, greatest(len(s), len(n)) + 1), lambda i: coalesce(s[i], 0) + coalesce(n[i], 0)), ',') AS sums,
  coalesce(array_to_string(list_transform(range(2, len(s) + 1), lambda i: s[i] - s[i - 1]), ','), '') AS steps, CASE WHEN len(list_filter(s, lambda x: x > 50)) > 0 THEN len(list_filter(s, lambda x: x <= 50)) END AS first_big FROM g""",
    "h7_maps": "SELECT p_partkey, 'trade' AS channel, lower(p_name) AS symbol FROM part UNION ALL SELECT p_partkey, 'book', upper(p_brand) FROM part",
    "h8_json": """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, '{"event_id":' || event_id || ',"event_type":"' || event_type || '"}' AS json FROM events""",
    "h1_text": "SELECT lower(trim(c_mktsegment)) AS segment, count(DISTINCT lower(c_name)) AS names FROM customer GROUP BY 1",
    "a7_revisions": "SELECT o_orderpriority, count(*) AS n, 2 AS rev, 1 AS supersedes, (SELECT count(*) FROM orders) AS records FROM orders GROUP BY 1",
    "g7_optimistic_commit": """WITH s AS (SELECT o_custkey, count(*) AS now FROM orders WHERE o_custkey % 3 <> 0 GROUP BY 1), x AS (SELECT o.o_custkey, o_orderkey AS proposal, now, (CASE WHEN o.o_custkey % 3 <> 0 THEN o_orderkey % 20 END) IS NOT DISTINCT FROM now AS f FROM orders o LEFT JOIN s ON s.o_custkey = o.o_custkey),
a AS (SELECT *, f AND row_number() OVER (PARTITION BY o_custkey, f ORDER BY proposal) = 1 AS accepted FROM x) SELECT proposal, accepted, CASE WHEN accepted THEN coalesce(now, 0) + 1 ELSE now END AS revision FROM a""",
}
ORACLES["a3_hour_sink"] = f"""WITH {EVENTS_SQL} SELECT instrument_key AS p_key, strftime(make_timestamp((received_at_ns - received_at_ns % {240 * 3_600_000_000_000}) // 1000), '%Y-%m-%d-%H') AS p_hour, count(*) AS n, CAST(sum(record_index) AS BIGINT) AS ids FROM ev GROUP BY 1, 2"""
