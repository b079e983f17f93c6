"""Late inputs to revisions, closing windows and silence timers, in many batches."""

import os

import pytest

from pyspark.sql import functions as F

from tests.test_queries import DATA, duck, plain  # noqa: F401
from tests.test_streams import many_batches  # noqa: F401
from tickloom.plans import q_streaming, registry
from tickloom.streaming import jobs, revise, silence

H = 3_600_000_000_000


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
@pytest.mark.parametrize("name", ["i3_closed_bars", "i9_silence_alarms"])
def test_batches_do_not_matter(spark, duck, many_batches, name):  # noqa: F811
    rows = registry.queries()[name](spark, DATA)
    want = duck.sql(registry.oracle_sql()[name])
    got = sorted(tuple(map(plain, r)) for r in rows.select(*want.columns).collect())
    assert got == sorted(tuple(map(plain, r)) for r in want.fetchall())


def bars(rows):
    return rows.groupBy("k", revise.floor_to("t", H).alias("hour_ns")).agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("v"))


SCHEMA = "k string, t long, received_at_ns long, v long"


def test_each_batch_makes_the_next_revision_once(spark, tmp_path):
    base = spark.createDataFrame([("a", 1, 2, 1), ("a", H + 1, H + 2, 10), ("b", 5, 6, 100)], SCHEMA)
    root = str(tmp_path)
    revise.publish_first(base, bars, ["k"], root)
    each = revise.revising(base, bars, ["k"], "t", root, 10 * H)
    batches = [
        [("a", 2, 2 * H, 2), ("a", 3, 2 * H, 3), ("c", 7, 2 * H, 7)],
        [("a", 4, 3 * H, 4), ("a", H + 2, 3 * H, 20), ("b", 6, 20 * H, 1000)],  # the last one is too late
        [("b", 8, 20 * H, 1)],  # nothing but that
        [],
    ]
    for number, rows in enumerate(batches):
        each(spark.createDataFrame(rows, SCHEMA), number)
    want = {
        ("a", 0, 1, 1, 1), ("a", H, 1, 1, 10), ("b", 0, 1, 1, 100),
        ("a", 0, 2, 3, 6), ("c", 0, 1, 1, 7),
        ("a", 0, 3, 4, 10), ("a", H, 2, 2, 30),
    }
    told = lambda: sorted((r.k, r.hour_ns, r.rev, r.n, r.v) for r in revise.revisions(spark, ["k"], root).collect())
    assert told() == sorted(want)
    for number in (1, 3, 0, 2):  # run again after a failure
        each(spark.createDataFrame(batches[number], SCHEMA), number)
    assert told() == sorted(want)
    assert sorted(r.v for r in spark.read.parquet(f"{root}/too_late").collect()) == [1, 1000]


def test_rows_without_a_commit_are_not_seen(spark, tmp_path):
    base = spark.createDataFrame([("a", 1, 2, 1)], SCHEMA)
    root = str(tmp_path)
    revise.publish_first(base, bars, ["k"], root)
    bars(base).withColumn("rev", F.lit(2)).write.parquet(f"{root}/rows/batch=0")  # what a crash leaves
    assert [(r.rev, r.n) for r in revise.revisions(spark, ["k"], root).collect()] == [(1, 1)]


def test_alarm_comes_before_the_next_event(spark, tmp_path):
    schema = "k string, at timestamp"
    at = lambda s: f"2024-01-01 00:{s // 60:02d}:{s % 60:02d}"
    batches = [[("a", 0), ("b", 0)], [("b", 30), ("b", 31)], [("b", 200)], [("b", 400)], [("a", 500), ("b", 500)], [("b", 510)]]
    for rows in batches:
        frame = spark.createDataFrame([(k, at(s)) for k, s in rows], "k string, s string").select("k", F.col("s").cast("timestamp").alias("at"))
        frame.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = jobs.file_stream(spark, f"{tmp_path}/in", spark.createDataFrame([], schema).schema, "*.parquet", files_per_batch=1)
    alarms = silence.silence_alarms(stream, "k", "at", "1 second", 100_000)
    with jobs.state_store(spark):
        jobs.run_available(alarms, f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    start = 1_704_067_200_000
    got = sorted((r.k, (r.silent_from_ms - start) // 1000, r.by_timer, r.batch) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert [x[:2] for x in got] == [("a", 0), ("b", 31), ("b", 200)]
    a = got[0]
    assert a[2] and a[3] < 7  # told by a timer, in the batches before the event of second 500
