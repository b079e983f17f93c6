"""Windows that are split into stretches give what one window over the whole key gives."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tickloom.functions.scalar import HOUR
from tickloom.operators import books as b
from tickloom.operators.ordered import positions
from tickloom.operators.revisions import affected_hours
from tickloom.operators.windows import expectation_intervals

SCHEMA = "k string, kind string, seq long, prev_seq long, time_ns long, valid boolean"


def rows_of(seed, n):
    r = random.Random(seed)
    rows = [(r.choice(["a", "b", None]), "snapshot" if r.random() < 0.1 else "update", s, s - 1, (s + r.randrange(3)) * HOUR // 7, r.random() < 0.5) for s in range(n)]
    return rows + [("a", "snapshot", None, None, None, True)] * (n > 0)  # no number: before all others


@pytest.mark.parametrize("n", [0, 300])
@pytest.mark.parametrize("width", [1, 13, 1000])
def test_segments_authorities_and_positions(spark, n, width):
    frame = spark.createDataFrame(rows_of(width, n), SCHEMA)
    run = Window.partitionBy("k").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    is_ = F.col("kind") == "snapshot"
    want = frame.select(
        "k", "seq", F.sum(F.when(is_, 1).otherwise(0)).over(run).alias("segment"), F.last(F.when(is_, F.struct("seq", "time_ns")), ignorenulls=True).over(run).alias("authority"),
        F.row_number().over(Window.partitionBy("k").orderBy("seq")).cast("long").alias("position"),
    )
    got = b.last_authority(b.segmented(frame, ["k"], ["seq"], width), ["k"], ["seq"], ["seq", "time_ns"], width)
    got = positions(got, ["k"], ["seq"], [F.floor(F.col("seq") / width)]).select(*want.columns)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_a_state_lasts_into_later_hours(spark):
    frame = spark.createDataFrame([("a", 0, True), ("a", 5 * HOUR + 3, False), ("a", 5 * HOUR + 7, True)], "k string, t long, valid boolean")
    got = {r.window_start_ns // HOUR: r.valid_ns for r in b.valid_coverage(frame, ["k"], "t", HOUR).collect()}
    assert got == {0: HOUR, 1: HOUR, 2: HOUR, 3: HOUR, 4: HOUR, 5: 3}


def test_hours_up_to_the_next_snapshot(spark):
    rows = [r for r in rows_of(5, 400) if r[4] is not None and r[0]]
    frame = spark.createDataFrame(rows, SCHEMA)
    late = frame.filter("kind = 'update'").select("k", "time_ns", (F.col("time_ns") + F.col("seq")).alias("received_at_ns"))
    got = {(r.k, r.hour_ns): r.inputs for r in affected_hours(late, frame.filter("kind = 'snapshot'"), ["k"], "time_ns", 12 * HOUR, 100).collect()}
    want = {}
    for k, kind, _, _, t, _ in rows:
        if kind == "update":
            after = [s[4] for s in rows if s[0] == k and s[1] == "snapshot" and s[4] > t]
            for hour in range(t // HOUR, (min([*after, t + 12 * HOUR]) - 1) // HOUR + 1):
                want[k, hour * HOUR] = want.get((k, hour * HOUR), 0) + 1
    assert got == want


def test_a_checkpoint_closes_the_one_before(spark):
    rows = [("a", 0, 1), ("a", 0, 2), ("a", 3 * HOUR, 4), ("a", 3 * HOUR + 5, 3), ("b", 9, 1)]
    frame = spark.createDataFrame(rows, "k string, t long, n long")
    got = {(r.k, r.n): (r.start_ns, r.end_ns) for r in expectation_intervals(frame, ["k"], "t", "n", 9 * HOUR).collect()}
    assert got == {("a", 2): (0, 3 * HOUR), ("a", 4): (3 * HOUR, 3 * HOUR + 5), ("a", 3): (3 * HOUR + 5, 9 * HOUR), ("b", 1): (9, 9 * HOUR)}
