"""Folds whose rows of a key and batch do not fit into one chunk."""

import json
import random

import pytest

from tickloom.streaming import folds, jobs


class Pieces(dict):
    """A map state; `most` is how many rows one value has held."""

    most = 0

    def updateValue(self, key, value):
        self[key] = value
        self.most = max(self.most, value[0].count("\n") + 1)

    def getValue(self, key):
        return self[key]

    def removeKey(self, key):
        del self[key]


class Handle:
    def getMapState(self, name, key, value):
        return Pieces()


@pytest.mark.parametrize(("chunks", "size"), [(0, 0), (1, 50), (2, 7), (5, 1000), (folds.FAN_IN + 1, 3), (folds.FAN_IN**2 + 5, 2)])
def test_parked_runs_come_back_in_order(chunks, size):
    draw = random.Random(chunks)
    rows = [[{"at": draw.choice([None, draw.randint(-50, 10**18), 2**53 + 1]), "s": "a\nb"} for _ in range(size)] for _ in range(chunks)]
    parking = folds.Parking(Handle(), "at")
    got = list(parking.in_order(iter([json.dumps(r) for r in chunk] for chunk in rows)))
    want = sorted((r["at"] for chunk in rows for r in chunk), key=lambda a: (a is not None, a or 0))
    assert [at for at, _ in got] == want
    assert all(row["at"] == at and row["s"] == "a\nb" for at, row in got)
    assert not parking.pieces and parking.pieces.most <= folds.PIECE


SCHEMA = "k string, at long, up long"


def test_fold_over_many_chunks_is_exact(spark, tmp_path):
    """One batch with rows of a key in many chunks and no order, then one with late rows, a null order and nulls beside large numbers."""
    base = 2**53
    rows = [("a", base + i, base + 2 * i + 1) for i in range(400)] + [(None, i, i) for i in range(5)]
    random.Random(3).shuffle(rows)
    batches = [rows, [("a", base + 399, None), ("a", base + 1, 7), ("a", None, 9), ("b", 1, base + 1), ("a", base + 500, base + 3)]]
    for batch in batches:
        spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

    def step(s, r):
        s["n"] += 1
        s["mixed"] = (s["mixed"] * 31 + (r["up"] or 0)) % 1_000_003  # depends on the order
        return {"k": r["k"], "n": s["n"], "up": r["up"]} if s["n"] % 100 == 0 or r["up"] is None or r["k"] != "a" or r["at"] == base + 500 else None

    stream = jobs.file_stream(spark, f"{tmp_path}/in", spark.createDataFrame([], SCHEMA).schema, "*.parquet", files_per_batch=1)
    made = folds.stateful(stream, ["k"], "at", {"n": 0, "mixed": 0}, step, "k string, n long, up long", "n long, mixed long")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = jobs.results(made, states=True)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    told = {tuple(r) for r in folds.in_time(got).collect()}
    hundreds = {("a", n, base + 2 * n - 1) for n in (100, 200, 300, 400)}
    assert told == hundreds | {(None, i + 1, i) for i in range(5)} | {("a", 401, None), ("a", 402, base + 3), ("b", 1, base + 1)}
    assert sorted(map(tuple, folds.late_rows(got).collect()), key=str) == sorted([("a", base + 1), ("a", None)], key=str)


def test_start_and_state_must_agree(spark):
    with pytest.raises(ValueError, match="different"):
        folds.stateful(spark.range(1), ["id"], "id", {"x": 1}, lambda s, r: None, "id long", "y long")
