"""Book replay with a fold for each segment, against the replay with a fold for each key."""

import pytest

from pyspark.sql import functions as F

from tests.test_replay import KEYS, SCHEMA, messages, stream
from tickloom.operators import books
from tickloom.streaming import jobs, replay


def shown(frame):
    """Rows without the levels that an authority ended, which the two tell in different places."""
    rows = frame.select(*KEYS, "seq", "time_ns", "segment", "valid", "break", "late", "text", "computed", "matches", F.filter("ended", lambda x: x["until"].isNotNull()).alias("ended"), "placed")
    return sorted(map(str, rows.collect()))


def authority_ended(frame):
    rows = frame.filter("NOT late").select(*KEYS, "segment", F.filter("ended", lambda x: x["until"].isNull()).alias("e")).filter("size(e) > 0").collect()
    return {(r.instrument_key, r.segment - 1): sorted((x.side, x.price, x.quantity, x.since, x["at"]) for x in r.e) for r in rows}


@pytest.mark.parametrize("rule,depth,files", [("okx", 3, 1), *[(r, None, 3) for r in books.CONTINUITY], ("okx", 4, 3)])
def test_segments_give_what_keys_give(spark, tmp_path, rule, depth, files):
    rows = sorted(messages(sum(map(ord, rule)) + (depth or 0), 150, ("a", "b", "c")), key=lambda r: r[1])
    rows = rows[:300] + [rows[10], rows[200], rows[299], rows[299]] + rows[300:]  # late, and twice in a batch
    source = stream(spark, rows, f"{tmp_path}/in", files)
    want = jobs.results(replay.replayed(source, KEYS, rule, depth), states=True)
    root = f"{tmp_path}/root"
    jobs.results(source, each=replay.replaying(KEYS, rule, root, depth, width=16))
    got = replay.told(spark, root)
    assert shown(got) == shown(want)
    assert got.filter("late").count() == want.filter("late").count() > 0
    left = replay.books_left(spark, KEYS, root).collect()
    left = {(r.instrument_key, r.segment): sorted((x.side, x.price, x.quantity, x.since, x["at"]) for x in r.levels) for r in left}
    ended = authority_ended(want)
    assert ended and {k: v for k, v in left.items() if k in ended} == ended
    assert all(not v or (key, segment) in ended or segment == max(s for k, s in left if k == key) for (key, segment), v in left.items())


def test_a_batch_that_is_run_again_writes_the_same(spark, tmp_path):
    rows = sorted(messages(3, 90, ["a", "b"]), key=lambda r: r[1])
    only_a = [r for r in rows[60:120] if r[0] == "a"]  # b's book lies over a batch, and over an empty one
    batches = [rows[:60], only_a, [], rows[120:]]
    each = replay.replaying(KEYS, "okx", str(tmp_path), 5)
    for number in (0, 1, 2, 3):
        each(spark.createDataFrame(batches[number], SCHEMA), number)
    once = shown(replay.told(spark, str(tmp_path)))
    for number in (1, 3, 2, 3):
        each(spark.createDataFrame(batches[number], SCHEMA), number)
    assert shown(replay.told(spark, str(tmp_path))) == once and len(once) == 60 + len(only_a) + 60
    whole = jobs.results(replay.replayed(stream(spark, batches[0] + only_a + batches[3], f"{tmp_path}-in", 1), KEYS, "okx", 5), states=True)
    assert shown(whole) == once


def test_a_keys_segments_are_the_work_of_several_tasks(spark, tmp_path):
    """One instrument, one batch: before, all its messages were one task's."""
    rows = [("a", i, 1000 * i, "snapshot" if i % 50 == 0 else "update", i - 1, i, [[str(i % 9), "1"]], [], None) for i in range(1, 1000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        replay.replaying(KEYS, "okx", str(tmp_path))(spark.createDataFrame(rows, SCHEMA), 0)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = replay.told(spark, str(tmp_path)).groupBy(F.input_file_name()).count().collect()
    assert len(files) > 1 and sum(r["count"] for r in files) == len(rows)
