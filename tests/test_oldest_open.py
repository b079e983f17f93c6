import os

import pytest

from tickloom.plans import q_telemetry

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


def test_every_event_is_a_sample(spark):
    spans = {}
    for r in q_telemetry.lags(spark, DATA).select("instrument_key", "received_at_ns", "lag_ns", "record_index").collect():
        at = r.received_at_ns // 10**9
        spans.setdefault(r.instrument_key, []).append((at, at + r.lag_ns // 10**6 if r.record_index % 7 else at + 9000))
    want = set()
    for key, rows in spans.items():
        for at, _ in rows:
            first = min((a for a, d in rows if a <= at < d), default=None)
            age = None if first is None else at - first
            want.add((key, at, age, age is not None and age > 6000))
    got = [tuple(r) for r in q_telemetry.e23_oldest_open(spark, DATA).select("instrument_key", "at", "age", "critical").collect()]
    assert len(got) == len(want) and set(got) == want
