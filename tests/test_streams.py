"""Streams in many batches, of one file each, against their SQL."""

import functools
import os

import pytest

from tests.test_queries import DATA, duck, plain  # noqa: F401
from tickloom.plans import q_streaming, registry
from tickloom.streaming import jobs

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture
def many_batches(spark, monkeypatch):
    stream = q_streaming._stream
    monkeypatch.setattr(jobs, "file_stream", functools.partial(jobs.file_stream, files_per_batch=1))
    monkeypatch.setattr(q_streaming, "_stream", lambda frame, *order: stream(frame.repartition(4), *order))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("name", ["i2_stream_bars", "i6_hysteresis", "i8_book_validity", "i9_silences", "i10_slo_monitor", "i11_gap_generations"])
def test_batches_do_not_matter(spark, duck, many_batches, name):  # noqa: F811
    rows = registry.queries()[name](spark, DATA)
    want = duck.sql(registry.oracle_sql()[name])
    got = sorted(tuple(map(plain, r)) for r in rows.select(*want.columns).collect())
    assert got == sorted(tuple(map(plain, r)) for r in want.fetchall())


def test_lifecycle_in_batches(spark, many_batches, monkeypatch):
    many = sorted(map(tuple, q_streaming.i7_lifecycle(spark, DATA).collect()))
    monkeypatch.undo()
    assert many == sorted(map(tuple, q_streaming.i7_lifecycle(spark, DATA).collect()))
