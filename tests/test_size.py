"""Cases that only large tables bring: sums past 64 bits, frames by the thousand, parts and keys that need no row."""

import datetime
import glob
import hashlib

from pyspark.sql import functions as F

from tickloom.functions.scalar import packed_digest, unpacked_digest
from tickloom.operators.reconcile import dealt, one_sided
from tickloom.plans import q_universe, registry
from tickloom.sources import parts
from tickloom.streaming import chain, folds, jobs


def test_latency_total_passes_64_bits(spark, tmp_path):
    at = datetime.datetime(2024, 1, 1)
    events = spark.range(50, 20_000 * 50 + 1, 50).selectExpr("id AS event_id", "1L AS user_id", "'view' AS event_type", "1.0D AS value", "'{}' AS props")
    events.withColumn("ts", F.lit(at)).write.parquet(f"{tmp_path}/events.parquet")
    (got,) = registry.queries()["d27_latency"](spark, str(tmp_path)).collect()
    n = sum(i % 33 != 0 for i in range(50, 20_000 * 50 + 1, 50))
    assert n * 8 * 86400 * 10**9 > 2**63
    assert (got.samples, got.lag_total) == (n, str(n * 8 * 86400 * 10**9))


def test_files_of_one_closing_are_not_parted(spark, tmp_path):
    """Closed bars in more files than a batch of a stream takes by default."""
    rows = spark.range(0, 600).selectExpr("'k' AS k", "id * 1000000 AS t", "timestamp_micros(id * 1000000) AS ts", "CAST(id AS DECIMAL(18,9)) AS price", "CAST(1 AS DECIMAL(18,9)) AS quantity")
    rows = rows.withColumn("k", F.expr("CAST(t div 1000000 % 150 AS STRING)"))
    rows.coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = jobs.file_stream(spark, f"{tmp_path}/in", rows.schema, "*.parquet")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "130")
    try:
        got = chain.chained_bars(stream, ["k"], "ts", [1_000_000, 60_000_000], ["t"], "1 second", f"{tmp_path}/out")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(glob.glob(f"{tmp_path}/out/1000000/*/*.parquet")) > 100
    closed = [i for i in range(600) if i + 1 <= 598]
    assert got.filter("interval_us = 60000000").agg(F.sum("trade_count")).first()[0] == sum(i // 60 * 60 + 60 <= max(closed) for i in closed)


def test_parts_that_were_never_in_the_top_have_no_months(spark, tmp_path):
    """Nine parts of a brand, of which a month's first four are in the top."""
    rows = [(p, datetime.datetime(2024, m, 3), float(100 - p if m != 2 else p)) for p in range(1, 10) for m in (1, 2, 4)]
    spark.createDataFrame(rows, "l_partkey long, l_shipdate timestamp, l_extendedprice double").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(p, "b") for p in range(1, 13)], "p_partkey long, p_brand string").write.parquet(f"{tmp_path}/part.parquet")
    got = {(r.p_partkey, r.month - 2024 * 12): r.rank for r in q_universe._months(spark, str(tmp_path)).collect()}
    first = {(p, m): p for p in (1, 2, 3, 4) for m in (1, 4)} | {(p, 2): 10 - p for p in (9, 8, 7, 6)}
    assert got == {(p, m): first.get((p, m)) for p in (1, 2, 3, 4, 6, 7, 8, 9) for m in (1, 2, 3, 4)}


def test_small_ranges_are_limited_in_number(spark, tmp_path, monkeypatch):
    """A part of many frames is not walked over once for each few bytes."""
    rows = spark.range(3000).selectExpr("'p-0' AS part", "id", "CONCAT('{\"i\":', id, '}') AS line")
    parts.write_parts(rows, "part", "id", "line", str(tmp_path), frame_lines=2)
    monkeypatch.setattr(parts, "MAX_RANGES", 8)
    ranges = parts._Reader({"path": str(tmp_path), "splitbytes": "16"}).partitions()
    assert len(ranges) <= 9 and ranges[-1].end == ranges[0].size
    got = parts.numbered(parts.scan_frames(spark, str(tmp_path), split_bytes=16)).select("record_index", F.get_json_object("line", "$.i").cast("int")).collect()
    assert sorted(map(tuple, got)) == [(i, i) for i in range(3000)]


def test_packed_digests_tell_texts_apart(spark):
    a = hashlib.sha256(b"a").hexdigest()
    texts = [a, a.upper(), a + "\n", a[:63], "x", "", " " * 31, "\u00e9" * 16, None]
    got = spark.createDataFrame([(x,) for x in texts], "t string").select("t", packed_digest("t").alias("p")).select("t", "p", unpacked_digest("p").alias("u")).collect()
    assert [r.u for r in got] == texts and len({None if r.p is None else bytes(r.p) for r in got}) == len(texts)
    assert len(got[0].p) == 32


def test_narrow_keys_are_dealt_over_all_partitions(spark):
    """Adaptive execution merges partitions of few bytes, however many rows they have."""
    found = one_sided(spark.range(200_000).toDF("k"), spark.range(3, 200_003).toDF("k"), ["k"])
    assert sorted(map(tuple, found.collect())) == [(0, "left"), (1, "left"), (2, "left"), *((k, "right") for k in (200_000, 200_001, 200_002))]
    assert dealt(spark.range(1000).toDF("k"), "k").select(F.spark_partition_id().alias("p")).distinct().count() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_keys_of_a_fold_share_groups(spark, tmp_path, monkeypatch):
    """Many keys in one group, over two batches: each has its own state and its own late rows."""
    monkeypatch.setattr(folds, "GROUPS", 1)
    for rows in ([(k, t) for k in (2, 10, None) for t in (3, 1, 2)], [(2, 5), (10, 2), (7, 1)]):
        spark.createDataFrame(rows, "k long, at long").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

    def step(s, r):
        s["n"] += 1
        return {"k": r["k"], "at": r["at"], "n": s["n"]}

    stream = jobs.file_stream(spark, f"{tmp_path}/in", spark.createDataFrame([], "k long, at long").schema, "*.parquet", files_per_batch=1)
    got = jobs.results(folds.stateful(stream, ["k"], "at", {"n": 0}, step, "k long, at long, n long", "n long"), states=True)
    told = sorted((tuple(r) for r in folds.in_time(got).collect()), key=str)
    assert told == sorted([(k, t, t) for k in (2, 10, None) for t in (1, 2, 3)] + [(2, 5, 4), (7, 1, 1)], key=str)
    assert [tuple(r) for r in folds.late_rows(got).collect()] == [("10", 2)]
