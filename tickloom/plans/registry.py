"""All registered queries of the market-data operators."""

from __future__ import annotations

from . import q_books, q_functions, q_storage, q_streaming, q_telemetry, q_trades, q_universe

_PARTS = [q_trades, q_telemetry, q_universe, q_books, q_storage, q_streaming, q_functions]


def queries() -> dict:
    return {name: query for part in _PARTS for name, query in part.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for part in _PARTS for name, sql in part.ORACLES.items()}
