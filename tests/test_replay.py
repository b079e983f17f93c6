"""Book replay with levels in state, against the batch operators, in one and in many batches."""

import collections
import random

import pytest

from pyspark.sql import functions as F

from tickloom.operators import books
from tickloom.streaming import jobs, replay

KEYS = ["instrument_key"]


def messages(seed, n=120, keys=("a", "b")):
    """Random updates of a few prices, with breaks of every kind, missing links, resets, and several changes of a price."""
    rng = random.Random(seed)
    rows = []
    for key in keys:
        seq = 100
        for i in range(n):
            before = seq
            seq += rng.choice([1, 1, 1, 2, 5])
            kind = "snapshot" if rng.random() < 0.05 and i > 5 else "update"
            link = rng.choice([before] * 8 + [before - 1, before + 1, 0, None])
            first = rng.choice([before + 1] * 6 + [before, before - 3, before + 3, None])
            change = lambda: [str(rng.randint(1, 14) + rng.choice([0, 0.5])), rng.choice(["0", "0.0", "1", "2.5", "30"])]
            bids, asks = ([change() for _ in range(rng.choice([0, 1, 1, 3]))] for _ in "ba")
            rows.append((key, seq, 1000 * i + rng.choice([0, 0, -2500]), kind, link, first, bids if rng.random() < 0.9 else None, asks, rng.choice([0, None, 7])))
    return rows


SCHEMA = "instrument_key string, seq long, time_ns long, kind string, prev_seq long, first_seq long, bids array<array<string>>, asks array<array<string>>, checksum long"


def stream(spark, rows, folder, files):
    """The rows in `files` files that come one batch after the other."""
    per = -(-len(rows) // files)
    for i in range(files):
        spark.createDataFrame(rows[i * per : (i + 1) * per], SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}")
    return jobs.file_stream(spark, folder, spark.createDataFrame([], SCHEMA).schema, "*.parquet", files_per_batch=1)


@pytest.mark.parametrize("rule,files", [("okx", 1), *[(r, 3) for r in books.CONTINUITY]])
def test_rules_and_levels(spark, tmp_path, rule, files, monkeypatch):
    monkeypatch.setattr(replay, "BLOCK", 16)
    rows = sorted(messages(sum(map(ord, rule))), key=lambda r: r[1])
    batch = spark.createDataFrame(rows, SCHEMA)
    got = jobs.results(replay.replayed(stream(spark, rows, f"{tmp_path}/in", files), KEYS, rule), states=True).cache()
    valid = books.validated(batch, KEYS, ["seq"], rule, 1 << 40)
    want = {(r.instrument_key, r.seq): (r.segment, r.valid, r["break"]) for r in valid.collect()}
    assert {(r.instrument_key, r.seq): (r.segment, r.valid, r["break"]) for r in got.collect()} == want
    assert any(b for *_, b in want.values()) or rule in ("bybit", "kraken_futures")  # these have no breaks in this order
    segments = books.segmented(batch, KEYS, ["seq"], 1 << 40)
    ends = books.segment_ends(segments, KEYS, "time_ns", 1 << 60)
    last = segments.groupBy(*KEYS).agg(F.max("time_ns").alias("last"))
    levels = books.exploded_levels(segments, [*KEYS, "segment", "seq", "time_ns"]).join(ends, [*KEYS, "segment"])
    lives = books.lifetimes(levels.join(last, KEYS).withColumn("until", F.least("until", F.col("last") + 1)), KEYS, "seq", "time_ns", "until")
    mine = replay.level_lifetimes(got, KEYS, 1 << 60)
    count = lambda f: collections.Counter((r.instrument_key, r.segment, r.side, r.price, r.quantity, r.from_ns, r.to_ns) for r in f.collect())
    assert count(mine) == count(lives) and sum(count(mine).values()) > 50


@pytest.mark.parametrize("files", [3])
def test_trimmed_books_have_the_folds_checksums(spark, tmp_path, files):
    rows = sorted(messages(5, 200), key=lambda r: r[1])
    got = jobs.results(replay.replayed(stream(spark, rows, f"{tmp_path}/in", files), KEYS, "okx", depth=4), states=True)
    segments = books.segmented(spark.createDataFrame(rows, SCHEMA), KEYS, ["seq"], 1 << 40)
    fold = books.checksum_chain(segments.select(*KEYS, "segment", "seq", "kind", "bids", "asks", "checksum"), KEYS, "seq", depth=4)
    want = {(r.instrument_key, r.seq): (r.computed, r.matches) for r in fold.collect()}
    assert {(r.instrument_key, r.seq): (r.computed, bool(r.matches)) for r in got.collect()} == want


def test_late_messages_are_told_and_change_nothing(spark, tmp_path):
    rows = sorted(messages(8, 60, ["a"]), key=lambda r: r[1])
    late = [rows[10], rows[20]]
    got = jobs.results(replay.replayed(stream(spark, rows[:40] + late + rows[40:], f"{tmp_path}/late", 3), KEYS, "okx"), states=True)
    plain = jobs.results(replay.replayed(stream(spark, rows, f"{tmp_path}/plain", 3), KEYS, "okx"), states=True)
    told = got.filter("late").collect()
    assert sorted(r.seq for r in told) == sorted(r[1] for r in late) and all(r.valid is None for r in told)
    show = lambda f: sorted(map(str, f.filter("NOT late").collect()))
    assert show(got) == show(plain)


def test_rows_of_many_chunks_are_parked(spark, tmp_path, monkeypatch):
    rows = sorted(messages(9, 120, ["a"]), key=lambda r: r[1])
    one = jobs.results(replay.replayed(stream(spark, rows, f"{tmp_path}/one", 1), KEYS, "okx", 3), states=True).collect()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        shuffled = rows[:]
        random.Random(1).shuffle(shuffled)
        many = jobs.results(replay.replayed(stream(spark, shuffled, f"{tmp_path}/many", 1), KEYS, "okx", 3), states=True).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(map(str, one)) == sorted(map(str, many))
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")
