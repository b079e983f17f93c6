import json

import zstandard

from tickloom.functions.scalar import decode_key, encode_key
from tickloom.operators.reconcile import set_digest
from tickloom.sources.raw import inventory, inventory_differences, salvage, scan_parts


def part(path, *frames):
    data = b"".join(zstandard.ZstdCompressor().compress("".join(json.dumps(r) + "\n" for r in f).encode()) for f in frames)
    path.write_bytes(data)
    return data


def row(n, payload=None):
    return {"schema_version": 1, "exchange": "okx", "market": "spot", "instrument_key": "BTC-USDT", "logical_stream": "trade", "transport": "websocket", "received_at_ns": n, "writer_sequence": n, "payload": payload or {"x": 0.1}}


def test_scan_reads_all_frames(spark, tmp_path):
    part(tmp_path / "a.jsonl.zst", [row(1), row(2)], [row(3)])
    got = scan_parts(spark, str(tmp_path)).orderBy("record_index").collect()
    assert [(r.record_index, r.received_at_ns, r.exchange) for r in got] == [(0, 1, "okx"), (1, 2, "okx"), (2, 3, "okx")]
    assert got[0].payload == '{"x":0.1}'


def test_salvage_keeps_whole_frames(spark, tmp_path):
    data = part(tmp_path / "a.partial", [row(1)], [row(2)])
    (tmp_path / "a.partial").write_bytes(data[:-3])
    first = len(zstandard.ZstdCompressor().compress((json.dumps(row(1)) + "\n").encode()))
    rows, facts = salvage(spark, str(tmp_path))
    assert rows.count() == 1
    (f,) = facts.collect()
    assert (f.valid_bytes, f.invalid_bytes, f.records) == (first, len(data) - 3 - first, 1)


def test_inventory_finds_changes(spark, tmp_path):
    (tmp_path / "a").write_bytes(b"1")
    (tmp_path / "b").write_bytes(b"2")
    declared = inventory(spark, str(tmp_path))
    assert inventory_differences(declared, inventory(spark, str(tmp_path))).count() == 0
    from pyspark.sql import functions as F

    changed = declared.withColumn("sha256", F.when(F.col("path").endswith("a"), "x").otherwise(F.col("sha256")))
    assert [r.difference for r in inventory_differences(changed, declared).collect()] == ["changed"]


def test_keys_are_reversible(spark):
    given = ["BTC-USDT", "a_b", "é/ü", "100%", "a b+c", "~.*", ""]
    frame = spark.createDataFrame([(g,) for g in given], "k string")
    got = frame.select("k", encode_key("k").alias("e"), decode_key(encode_key("k")).alias("d")).collect()
    assert all(r.k == r.d for r in got)
    assert {r.k: r.e for r in got}["a_b"] == "a%5Fb"


def test_digest_does_not_depend_on_partitioning(spark):
    from pyspark.sql import functions as F

    frame = spark.range(1000).select((F.col("id") % 3).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("d"))
    one = {r.k: r.digest for r in set_digest(frame.repartition(1), ["k"], "d").collect()}
    assert one == {r.k: r.digest for r in set_digest(frame.repartition(7).orderBy(F.rand()), ["k"], "d").collect()}
