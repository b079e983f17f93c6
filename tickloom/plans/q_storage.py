"""Queries: manifests, files, revisions, retention."""

from __future__ import annotations

import io
import uuid

import pandas as pd
from pyspark.sql import functions as F

from ..functions.scalar import DAY, HOUR, SECOND, floor_to
from ..operators import revisions as rv
from ..shared import shared_dir
from ..sources import parts, raw
from .q_books import MESSAGES_SQL, messages
from .tables import EVENTS_SQL, events, table, trades

#: A delay from which on an event counts as late.
LATE = SECOND // 2

PART = ["instrument_key", "worker_instance_id"]


def _records(spark, sf_dir):
    e = events(spark, sf_dir)
    return e.withColumns({"writer_sequence": F.col("record_index") - F.when(F.col("record_index") % 601 == 9, 400).otherwise(0), "connection_id": F.concat(F.lit("c"), F.col("user_id") % 3), "egress_id": F.concat(F.lit("e"), F.col("user_id") % 4)})


RECORDS_SQL = f"{EVENTS_SQL}, rc AS (SELECT *, record_index - CASE WHEN record_index % 601 = 9 THEN 400 ELSE 0 END AS ws FROM ev)"


def a4_part_facts(spark, sf_dir):
    return raw.part_facts(_records(spark, sf_dir), PART)


#: Lines of a frame and bytes of a task of the test parts, so that each part has several frames and tasks.
FRAME, SPLIT = 100, 1 << 12


def _part_lines(spark, sf_dir):
    """A part for each event type and fifth of the users: events as JSON lines, in the order of their numbers."""
    e = table(spark, sf_dir, "events").withColumn("us", F.unix_micros(F.col("ts").cast("timestamp"))).drop("ts")
    part = F.concat_ws("-", F.col("event_type"), (F.col("user_id") % 5).cast("string"))
    return e.select(part.alias("part"), "event_id", F.to_json(F.struct("event_id", "us", "user_id", "event_type", "value", "props")).alias("line"))


def _written_parts(spark, sf_dir):
    root = f"{shared_dir(spark)}/parts-{uuid.uuid4()}"
    parts.write_parts(_part_lines(spark, sf_dir), "part", "event_id", "line", root, FRAME)
    return root


def a2_part_scan(spark, sf_dir):
    """All events, written to compressed parts by tasks and read back by ranges of frames."""
    lines = parts.numbered(parts.scan_frames(spark, _written_parts(spark, sf_dir), split_bytes=SPLIT))
    e = F.from_json("line", "event_id long, us long, user_id long, event_type string, value double, props string")
    return lines.select("record_index", e.alias("e")).select("record_index", "e.*")


def _damaged(spark, root):
    """The parts as unfinished ones: by the last digit of their name whole, cut short, with a changed byte in their second
    frame, or with a third frame that does not begin as one."""
    to = f"{root}-damaged"

    def damage(frames):
        for frame in frames:
            for path, content in zip(frame["path"], frame["content"], strict=True):
                data, ends = bytearray(content), [0]
                while ends[-1] < len(data):
                    ends.append(parts.frame_end(io.BytesIO(content), ends[-1], len(data)))
                name = path.rsplit("/", 1)[1]
                kind = int(name.split("-")[1])
                if kind == 1:
                    del data[-3:]
                elif kind in (2, 3):
                    n = min(kind - 1, len(ends) - 2)
                    data[(ends[n] + ends[n + 1]) // 2 if kind == 2 else ends[n]] ^= 0xFF
                files, inner = parts._files(to)
                files.create_dir(inner, recursive=True)
                with files.open_output_stream(f"{inner}/{name}.partial") as out:
                    out.write(bytes(data))
                yield pd.DataFrame({"path": [path]})

    made = spark.read.format("binaryFile").load(root).select("path", "content").mapInPandas(damage, "path string")
    made.write.format("noop").mode("overwrite").save()
    return to


def a6_salvage(spark, sf_dir):
    """Of each damaged part: the records before its first bad frame, the sum of their numbers, and whether bytes go to quarantine."""
    rows, facts = raw.salvage(spark, _damaged(spark, _written_parts(spark, sf_dir)))
    part = F.regexp_extract("path", PART_NAME, 1).alias("part")
    sums = rows.groupBy(part).agg(F.max("record_index").alias("last"), F.sum(F.get_json_object("line", "$.event_id").cast("long")).alias("ids"))
    told = facts.select(part, "records", (F.col("invalid_bytes") > 0).alias("quarantine"))
    return told.join(sums, "part", "left")


#: A part's name by its path.
PART_NAME = r"([^/]*-[0-9]+)-[^/]*$"


def a9_bounded_evidence(spark, sf_dir):
    """Compressed parts that are read only if they are what is declared of them and within bounds: one row less than the largest has,
    the bytes of the average one, and a byte less than the longest line. Declared are a row too many for the parts of every fifth user,
    and a byte too few for those of another fifth."""
    e = table(spark, sf_dir, "events")
    rows = e.select(F.concat_ws("-", "event_type", (F.col("user_id") % 5).cast("string")).alias("part"), "event_id", F.to_json(F.struct("event_id", "event_type")).alias("line"))
    root = f"{shared_dir(spark)}/evidence-{uuid.uuid4()}"
    parts.write_parts(rows, "part", "event_id", "line", root, FRAME)
    size = F.octet_length("line").cast("long")
    facts = rows.groupBy("part").agg(F.count("line").alias("rows"), F.sum(size + 1).alias("bytes"), F.max(size).alias("longest"))
    bound = facts.agg(F.max("rows") - 1, F.expr("sum(bytes) div count(*)"), F.max("longest") - 1).first()
    fifth = F.substring("part", -1, 1)
    declared = facts.select("part", (F.col("rows") + F.when(fifth == "4", 1).otherwise(0)).alias("rows"), (F.col("bytes") - F.when(fifth == "3", 1).otherwise(0)).alias("bytes"))
    lines, verdicts = parts.evidence(spark, root, declared, F.regexp_extract("path", PART_NAME, 1), *bound, split_bytes=SPLIT)
    ids = F.sum(F.get_json_object("line", "$.event_id").cast("long"))
    given = lines.groupBy("part").agg(F.count("line").alias("lines"), F.max("record_index").alias("last"), ids.alias("ids"))
    return verdicts.join(given, "part", "left")


def a5_manifest_check(spark, sf_dir):
    facts = ["records", "first_received_ns", "last_sequence"]
    actual = raw.part_facts(_records(spark, sf_dir), PART)
    declared = raw.part_facts(_records(spark, sf_dir).filter("record_index % 9000 <> 5"), PART)
    return raw.verified(declared, actual, PART, facts).select(*PART, "state", "differing")


def b7_single_hour(spark, sf_dir):
    e = _records(spark, sf_dir).withColumn("day", floor_to("received_at_ns", HOUR * 6))
    return raw.part_facts(e, [*PART, "day"]).select(*PART, "day", (F.col("hours") == 1).alias("single"))


def e3_sequence_growth(spark, sf_dir):
    return raw.sequence_breaks(_records(spark, sf_dir), PART).select("record_index", "previous_sequence")


def _manifests(spark, sf_dir):
    """A manifest for each order: its data is the order's lines."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.sha2(F.col("o_orderkey").cast("string"), 256).alias("manifest_sha256"), F.concat(F.lit("/raw/"), F.col("o_orderkey")).alias("data_path"), F.sha2(F.concat(F.lit("d"), F.col("o_orderkey")), 256).alias("data_sha256"),
        F.col("o_custkey").alias("data_size"), F.when(F.col("o_orderkey") % 9 == 8, 2).otherwise(1).alias("schema_version"),
        F.col("o_orderpriority").alias("exchange"), "o_orderkey", (F.unix_micros(F.col("o_orderdate").cast("timestamp")) * 1000).alias("closed_at_ns"), (F.unix_micros(F.col("o_orderdate").cast("timestamp")) * 1000 - HOUR).alias("last_event_ns"),
    )


def _files(spark, sf_dir):
    m = _manifests(spark, sf_dir).filter("o_orderkey % 7 <> 3")
    return m.select(F.col("data_path").alias("path"), (F.col("data_size") + F.when(F.col("o_orderkey") % 31 == 1, 1).otherwise(0)).alias("size"), F.when(F.col("o_orderkey") % 41 == 2, "x").otherwise(F.col("data_sha256")).alias("sha256"))


def _tombstones(spark, sf_dir):
    m = _manifests(spark, sf_dir)
    return m.filter("o_orderkey % 14 = 3 OR o_orderkey % 97 = 5").select("manifest_sha256", F.when(F.col("o_orderkey") % 5 == 0, "y").otherwise(F.col("data_sha256")).alias("data_sha256"))


def a1_discovery(spark, sf_dir):
    rows = raw.discovered_parts(_manifests(spark, sf_dir), _files(spark, sf_dir), _tombstones(spark, sf_dir))
    return rows.select("o_orderkey", F.col("place").cast("long").alias("place"))


def a11_inventory(spark, sf_dir):
    declared = _manifests(spark, sf_dir).filter("o_orderkey % 11 <> 4").select(F.col("data_path").alias("path"), F.col("data_size").alias("size"), F.col("data_sha256").alias("sha256"))
    return raw.inventory_differences(declared, _files(spark, sf_dir))


def c17_disposition(spark, sf_dir):
    rows = raw.dispositions(_manifests(spark, sf_dir), _files(spark, sf_dir), _manifests(spark, sf_dir).filter("o_orderkey % 13 = 6"), _tombstones(spark, sf_dir))
    return rows.groupBy("disposition").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"))


def a12_capabilities(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), (F.col("n_regionkey") * 10).alias("depth"))
    return raw.with_capability(table(spark, sf_dir, "customer"), n, ["c_nationkey"]).groupBy("depth").agg(F.count(F.lit(1)).alias("customers"))


def _revisions(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem")
    return l.groupBy("l_suppkey", (F.col("l_orderkey") % 5).alias("rev")).agg(F.count(F.lit(1)).alias("records")).withColumn("committed", (F.col("l_suppkey") + F.col("rev")) % 4 != 0)


def a8_latest_revision(spark, sf_dir):
    return rv.latest_revisions(_revisions(spark, sf_dir), ["l_suppkey"]).select("l_suppkey", "rev", "records")


def late_events(spark, sf_dir):
    """Events that came at least half a second after their time."""
    late = events(spark, sf_dir).filter(F.col("received_at_ns") - F.col("event_time_ns") >= LATE)
    return late.select("instrument_key", F.col("event_time_ns").alias("t"), "received_at_ns")


def authorities(spark, sf_dir):
    """Times of the authoritative book messages."""
    return messages(spark, sf_dir).filter("kind = 'snapshot'").select("instrument_key", F.col("time_ns").alias("t"))


def c11_affected_hours(spark, sf_dir):
    late = late_events(spark, sf_dir)
    return rv.affected_hours(late, authorities(spark, sf_dir), ["instrument_key"], "t", 12 * HOUR, DAY)


def c12_cleanup(spark, sf_dir):
    m = _manifests(spark, sf_dir)
    l = table(spark, sf_dir, "lineitem")
    receipts = l.select(F.sha2(F.col("l_orderkey").cast("string"), 256).alias("manifest_sha256"), F.when(F.col("l_linenumber") % 2 == 0, "a").otherwise("b").alias("target"), (F.col("l_returnflag") != "R").alias("strong"))
    acks = m.filter("o_orderkey % 6 <> 1")
    now = 900_000_000 * 1_000_000_000
    rows = rv.eligibility(m, receipts, acks, ["a", "b"], now, 400 * DAY, now - 1000 * DAY)
    return rows.groupBy(F.array_join("blocked_by", ",").alias("blocked_by"), "eligible").agg(F.count(F.lit(1)).alias("n"))


def c15_acknowledged(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_returnflag").alias("dataset"))
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"))
    return rv.acknowledged(o, l, ["A", "N"], "l_orderkey")


def c16_receipts(spark, sf_dir):
    m = _manifests(spark, sf_dir)
    receipts = m.select("manifest_sha256", (F.col("data_size") + F.when(F.col("o_orderkey") % 23 == 0, 1).otherwise(0)).alias("stored_size"), F.when(F.col("o_orderkey") % 29 == 0, "z").otherwise(F.col("data_sha256")).alias("stored_sha256"))
    rows = rv.receipt_mismatches(m, receipts, "manifest_sha256", {"stored_size": "data_size", "stored_sha256": "data_sha256"})
    return rows.select("o_orderkey", F.array_join("mismatches", ",").alias("mismatches"))


def c19_abandoned_jobs(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").select(F.sha2(F.col("l_orderkey").cast("string"), 256).alias("manifest_sha256"), F.when(F.col("l_linestatus") == "O", "pending").otherwise("done").alias("state"), (F.col("l_linenumber") % 2 == 0).alias("optional"))
    return rv.abandoned_jobs(l, _tombstones(spark, sf_dir), "manifest_sha256").groupBy("state", "optional", "next_state").agg(F.count(F.lit(1)).alias("n"))


def d29_identity(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").select("l_suppkey", F.sha2(F.col("l_partkey").cast("string"), 256).alias("sha"))
    return rv.materialization_identity(l, ["l_suppkey"], "sha", "config", "code", {"raw": 1, "bars": 2})


def d30_lineage(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").select("l_suppkey", F.concat(F.lit("m"), F.col("l_partkey")).alias("sha"))
    return rv.lineage(l, ["l_suppkey"], "sha").select("l_suppkey", F.array_join("inputs", ",").alias("inputs"))


QUERIES = {
    f.__name__: f
    for f in (
        a2_part_scan, a6_salvage, a9_bounded_evidence, a4_part_facts, a5_manifest_check, b7_single_hour, e3_sequence_growth, a1_discovery, a11_inventory, c17_disposition, a12_capabilities, a8_latest_revision, c11_affected_hours, c12_cleanup,
        c15_acknowledged, c16_receipts, c19_abandoned_jobs, d29_identity, d30_lineage,
    )
}

_FACTS = """count(*) AS records, min(received_at_ns) AS first_received_ns, max(received_at_ns) AS last_received_ns, min(ws) AS first_sequence, max(ws) AS last_sequence, count(DISTINCT received_at_ns // 3600000000000) AS hours"""
_MAN = "mf AS (SELECT o_orderkey AS k, o_orderkey::VARCHAR AS ks, '/raw/' || o_orderkey AS path, o_custkey AS size, o_orderpriority AS ex, sha256(o_orderkey::VARCHAR) AS sha, sha256('d' || o_orderkey) AS d, epoch_us(o_orderdate) * 1000 AS closed FROM orders)"
ORACLES = {
    "a2_part_scan": """SELECT row_number() OVER (PARTITION BY event_type, user_id % 5 ORDER BY event_id) - 1 AS record_index, event_id, epoch_us(ts) AS us, user_id, event_type, value, props FROM events""",
    "a6_salvage": f"""WITH e AS (SELECT event_type || '-' || (user_id % 5) AS part, user_id % 5 AS kind, event_id, row_number() OVER (PARTITION BY event_type, user_id % 5 ORDER BY event_id) - 1 AS i,
  count(*) OVER (PARTITION BY event_type, user_id % 5) AS n FROM events),
k AS (SELECT *, {FRAME} * CASE kind WHEN 1 THEN (n - 1) // {FRAME} WHEN 2 THEN least(1, (n - 1) // {FRAME}) WHEN 3 THEN least(2, (n - 1) // {FRAME}) ELSE n END AS upto FROM e)
SELECT part, count(*) FILTER (WHERE i < upto) AS records, kind IN (1, 2, 3) AS quarantine, max(i) FILTER (WHERE i < upto) AS last, CAST(sum(event_id) FILTER (WHERE i < upto) AS BIGINT) AS ids FROM k GROUP BY part, kind""",
    "a9_bounded_evidence": """WITH e AS (SELECT event_type || '-' || (user_id % 5) AS part, user_id % 5 AS kind, event_id, strlen('{"event_id":' || event_id || ',"event_type":"' || event_type || '"}') AS b FROM events),
f AS (SELECT part, kind, count(*) AS n, CAST(sum(b + 1) AS BIGINT) AS bytes, max(b) AS longest, CAST(sum(event_id) AS BIGINT) AS ids FROM e GROUP BY 1, 2),
m AS (SELECT max(n) - 1 AS max_n, sum(bytes) // count(*) AS max_bytes, max(longest) - 1 AS max_line FROM f),
v AS (SELECT *, CASE WHEN n + CAST(kind = 4 AS INT) > max_n THEN 'rows_over' WHEN bytes > max_bytes THEN 'bytes_over' WHEN longest > max_line THEN 'line_over'
  WHEN kind = 4 THEN 'rows_differ' WHEN kind = 3 THEN 'bytes_differ' ELSE 'accepted' END AS verdict FROM f, m)
SELECT part, verdict, n AS rows, bytes, CASE WHEN verdict = 'accepted' THEN n END AS lines, CASE WHEN verdict = 'accepted' THEN n - 1 END AS last, CASE WHEN verdict = 'accepted' THEN ids END AS ids FROM v""",
    "a4_part_facts": f"""WITH {RECORDS_SQL} SELECT instrument_key, worker_instance_id, {_FACTS}, string_agg(DISTINCT 'c' || (user_id % 3), ',' ORDER BY 'c' || (user_id % 3)) AS connection_ids,
  string_agg(DISTINCT 'e' || (user_id % 4), ',' ORDER BY 'e' || (user_id % 4)) AS egress_ids FROM rc GROUP BY 1, 2""",
    "a5_manifest_check": f"""WITH {RECORDS_SQL}, a AS (SELECT instrument_key, worker_instance_id, {_FACTS} FROM rc GROUP BY 1, 2), d AS (SELECT instrument_key, worker_instance_id, {_FACTS} FROM rc WHERE record_index % 9000 <> 5 GROUP BY 1, 2),
j AS (SELECT instrument_key, worker_instance_id, concat_ws(',', CASE WHEN a.records <> d.records THEN 'records' END, CASE WHEN a.first_received_ns <> d.first_received_ns THEN 'first_received_ns' END, CASE WHEN a.last_sequence <> d.last_sequence THEN 'last_sequence' END) AS differing FROM a JOIN d USING (instrument_key, worker_instance_id))
SELECT *, CASE WHEN differing = '' THEN 'equal' ELSE 'different' END AS state FROM j""",
    "b7_single_hour": f"WITH {RECORDS_SQL} SELECT instrument_key, worker_instance_id, received_at_ns - received_at_ns % {6 * HOUR} AS day, count(DISTINCT received_at_ns // {HOUR}) = 1 AS single FROM rc GROUP BY 1, 2, 3",
    "e3_sequence_growth": f"WITH {RECORDS_SQL}, p AS (SELECT record_index, ws, lag(ws) OVER (PARTITION BY instrument_key, worker_instance_id ORDER BY record_index) AS previous_sequence FROM rc) SELECT record_index, previous_sequence FROM p WHERE previous_sequence >= ws",
    "a1_discovery": f"""WITH {_MAN} SELECT k AS o_orderkey, row_number() OVER (PARTITION BY ex ORDER BY sha) AS place FROM mf
  WHERE k % 9 <> 8 AND k % 7 <> 3 AND k % 31 <> 1 AND k % 41 <> 2 AND NOT (k % 14 = 3 OR k % 97 = 5)""",
    "a11_inventory": f"""WITH {_MAN} SELECT path, CASE WHEN k % 11 = 4 THEN 'unexpected' WHEN k % 7 = 3 THEN 'missing' ELSE 'changed' END AS difference FROM mf
  WHERE (k % 11 = 4) <> (k % 7 = 3) OR (k % 11 <> 4 AND (k % 31 = 1 OR k % 41 = 2))""",
    "c17_disposition": f"""WITH {_MAN}, s AS (SELECT k, CASE WHEN k % 14 = 3 OR k % 97 = 5 THEN CASE WHEN k % 5 = 0 THEN 'proof_mismatch' ELSE 'tombstoned' END WHEN k % 7 = 3 THEN 'missing_unexplained' WHEN k % 41 = 2 THEN 'changed'
  WHEN k % 13 = 6 THEN 'cleanup_pending' ELSE 'present' END AS disposition FROM mf) SELECT disposition, count(*) AS n, CAST(sum(k) AS BIGINT) AS keys FROM s GROUP BY 1""",
    "a12_capabilities": "SELECT n_regionkey * 10 AS depth, count(*) AS customers FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey GROUP BY 1",
    "a8_latest_revision": """WITH r AS (SELECT l_suppkey, l_orderkey % 5 AS rev, count(*) AS records FROM lineitem GROUP BY 1, 2), c AS (SELECT l_suppkey, max(rev) AS rev FROM r WHERE (l_suppkey + rev) % 4 <> 0 GROUP BY 1) SELECT l_suppkey, rev, records FROM r JOIN c USING (l_suppkey, rev)""",
    "c11_affected_hours": f"""WITH {MESSAGES_SQL}, l AS (SELECT instrument_key, event_time_ns AS t, received_at_ns AS r FROM ev WHERE received_at_ns - event_time_ns >= {LATE}), s AS (SELECT instrument_key, time_ns AS s FROM ms WHERE kind = 'snapshot'),
b AS (SELECT instrument_key, t, r, NULL AS s FROM l UNION ALL SELECT instrument_key, s, NULL, s FROM s),
n0 AS (SELECT *, min(s) OVER (PARTITION BY instrument_key ORDER BY t RANGE BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nx FROM b), n AS (SELECT * FROM n0 WHERE s IS NULL),
h AS (SELECT instrument_key, r - t > {DAY} AS late, unnest(range(t - t % {HOUR}, least(coalesce(nx, t + {12 * HOUR}), t + {12 * HOUR}), {HOUR})) AS hour_ns FROM n)
SELECT instrument_key, hour_ns, count(*) AS inputs, min(late) AS too_late FROM h GROUP BY 1, 2""",
    "c12_cleanup": f"""WITH {_MAN}, t AS (SELECT l_orderkey AS k, count(DISTINCT l_linenumber % 2) AS n FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1),
b AS (SELECT concat_ws(',', CASE WHEN coalesce(n, 0) < 2 THEN 'receipts' END, CASE WHEN mf.k % 6 = 1 THEN 'acknowledgement' END, CASE WHEN {900_000_000 * 1_000_000_000} - closed < {400 * DAY} THEN 'grace' END,
  CASE WHEN closed - {HOUR} >= {900_000_000 * 1_000_000_000 - 1000 * DAY} THEN 'revision_fence' END) AS blocked_by FROM mf LEFT JOIN t ON t.k = mf.k) SELECT blocked_by, blocked_by = '' AS eligible, count(*) AS n FROM b GROUP BY 1""",
    "c15_acknowledged": "SELECT o_orderkey AS l_orderkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag IN ('A', 'N') GROUP BY 1 HAVING count(DISTINCT l_returnflag) = 2)",
    "c16_receipts": "SELECT o_orderkey, concat_ws(',', CASE WHEN o_orderkey % 23 = 0 THEN 'stored_size' END, CASE WHEN o_orderkey % 29 = 0 THEN 'stored_sha256' END) AS mismatches FROM orders WHERE o_orderkey % 23 = 0 OR o_orderkey % 29 = 0",
    "c19_abandoned_jobs": """WITH l AS (SELECT CASE WHEN l_linestatus = 'O' THEN 'pending' ELSE 'done' END AS state, l_linenumber % 2 = 0 AS optional, (l_orderkey % 14 = 3 OR l_orderkey % 97 = 5) AND l_orderkey IN (SELECT o_orderkey FROM orders) AS gone FROM lineitem)
SELECT state, optional, CASE WHEN state = 'pending' AND optional AND gone THEN 'abandoned' ELSE state END AS next_state, count(*) AS n FROM l GROUP BY 1, 2, 3""",
    "d29_identity": "SELECT l_suppkey, sha256(string_agg(DISTINCT sha256(l_partkey::VARCHAR), ',' ORDER BY sha256(l_partkey::VARCHAR)) || '|config|code|bars=2|raw=1') AS identity FROM lineitem GROUP BY 1",
    "d30_lineage": "SELECT l_suppkey, string_agg(DISTINCT 'm' || l_partkey, ',' ORDER BY 'm' || l_partkey) AS inputs FROM lineitem GROUP BY 1",
}
