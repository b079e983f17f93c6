"""Chained bar streams and rows that come too late for a fold, in many batches."""

import os

import pytest

from tests.test_queries import DATA, duck, plain  # noqa: F401
from tests.test_streams import many_batches  # noqa: F401
from tickloom.plans import registry
from tickloom.streaming import chain, jobs

SCHEMA = "k string, at long"


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_sizes_do_not_depend_on_batches(spark, duck, many_batches):  # noqa: F811
    rows = registry.queries()["i2_chained_bars"](spark, DATA)
    want = duck.sql(registry.oracle_sql()["i2_chained_bars"])
    got = sorted(tuple(map(plain, r)) for r in rows.select(*want.columns).collect())
    assert got == sorted(tuple(map(plain, r)) for r in want.fetchall())


def test_sizes_must_be_multiples(spark):
    with pytest.raises(ValueError, match="multiple"):
        chain.chained_bars(spark.range(1), ["k"], "t", [2, 3], ["t"], "1 second", "/nowhere")


def test_late_rows_go_aside(spark, tmp_path):
    for rows in ([("a", 1), ("a", 5)], [("a", 3), ("a", 20), ("b", 2)], [("b", 1), ("a", 50)], [("a", 49)]):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = jobs.file_stream(spark, f"{tmp_path}/in", spark.createDataFrame([], SCHEMA).schema, "*.parquet", files_per_batch=1)
    got = jobs.results(jobs.silences(stream, "k", "at", 10), states=True)
    assert sorted(tuple(r) for r in jobs.late_rows(got).collect()) == [("a", 3), ("a", 49), ("b", 1)]
    assert sorted(tuple(r) for r in jobs.in_time(got).collect()) == [("a", 5, 20), ("a", 20, 50)]


def test_shared_folder_is_never_a_guess(spark, monkeypatch):
    from tickloom import shared

    assert shared.shared_dir(spark).startswith("file:///tmp/spark-")

    class Conf(dict):
        def getConf(self):
            return self

        master = "yarn"

    class Session:
        sparkContext = Conf()

    with pytest.raises(ValueError, match="checkpoint"):
        shared.shared_dir(Session())
