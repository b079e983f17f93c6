import os

import pytest

from tickloom.plans import q_streaming
from tickloom.plans.tables import trades

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


def test_trades_without_identifier_stay(spark):
    want = {}
    for r in trades(spark, DATA).select("instrument_key", "trade_id").collect():
        ids, without = want.setdefault(r.instrument_key, (set(), []))
        (without.append(1) if r.trade_id is None else ids.add(r.trade_id))
    got = {r.instrument_key: (r.kept, r.identifiers) for r in q_streaming.i5_stream_dedup(spark, DATA).collect()}
    assert all(without for _, without in want.values())
    assert got == {k: (len(ids) + len(without), len(ids)) for k, (ids, without) in want.items()}
