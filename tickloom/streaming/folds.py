"""Folds over the rows of each key of a stream, in the order of a column, in bounded memory."""

from __future__ import annotations

import heapq
import json
from collections.abc import Callable, Iterator
from itertools import chain, groupby, islice

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: Rows of a piece of a parked run, and runs that are merged at a time: a task holds one piece of each of them.
PIECE, FAN_IN = 250, 32
#: Rows of a frame that a fold hands over.
BATCH = 4096
#: Keys share this many groups, as a group costs more than the rows of a small key.
GROUPS = 2048
#: Rows reach a processor as named tuples, which do not keep names that begin with an underscore.
ROW, KEY_TEXT, GROUP = "row_text", "key_text", "key_group"
LATE = "late boolean, late_key string, late_order long"


class Parking:
    """The rows of one key and batch, sorted through the state: chunks that do not come alone are parked as sorted runs, which are
    merged by FAN_IN until so few are left that the last merge can be read off."""

    def __init__(self, handle: StatefulProcessorHandle, order: str):
        self.order, self.by_key = order, False
        self.pieces = handle.getMapState("parked", "run long, piece long", "rows string")

    def in_order(self, chunks: Iterator[list[str]]) -> Iterator[tuple[int | None, dict]]:
        """order and row of each JSON text, by order; those without an order come first."""
        first = next(chunks, [])
        second = next(chunks, None)
        if second is None:
            for at, _, row in self._sorted(first):
                yield at, row
            return
        numbers = iter(range(1 << 62))
        runs = [self._park(self._sorted(c), next(numbers)) for c in chain((first, second), chunks)]
        while len(runs) > FAN_IN:
            groups = [runs[i : i + FAN_IN] for i in range(0, len(runs), FAN_IN)]
            runs = [self._park(self._merged(g), next(numbers)) for g in groups]
        for at, _, row in self._merged(runs):
            yield at, row

    def _place(self, entry: tuple) -> tuple:
        at = entry[0]
        return (entry[2][KEY_TEXT] if self.by_key else "", at is not None, at or 0)

    def _sorted(self, texts: list[str]) -> list[tuple[int | None, str, dict]]:
        read = ((text, json.loads(text)) for text in texts)
        return sorted(((row[self.order], text, row) for text, row in read), key=self._place)

    def _park(self, entries, run: int) -> tuple[int, int]:
        entries, n = iter(entries), 0
        while piece := [text for _, text, _ in islice(entries, PIECE)]:
            self.pieces.updateValue((run, n), ("\n".join(piece),))
            n += 1
        return run, n

    def _unpark(self, run: int, n: int) -> Iterator[tuple[int | None, str, dict]]:
        for piece in range(n):
            texts = self.pieces.getValue((run, piece))[0].split("\n")
            self.pieces.removeKey((run, piece))
            yield from self._sorted(texts)

    def _merged(self, runs: list[tuple[int, int]]) -> Iterator[tuple[int | None, str, dict]]:
        return heapq.merge(*(self._unpark(*run) for run in runs), key=self._place)


class OrderedFold(StatefulProcessor):
    """See stateful()."""

    def __init__(self, order: str, start: dict, step: Callable[[dict, dict], dict | None], columns: list[str], state: str):
        self.order, self.start, self.step, self.columns, self.kinds = order, start, step, columns, state

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.kept = handle.getMapState("kept", f"{KEY_TEXT} string", f"{self.kinds}, _order long")
        self.parking = Parking(handle, self.order)
        self.parking.by_key = True

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        """Rows come by key, then order; the state of one key is held at a time."""
        made = []
        for text, mine in groupby(self.parking.in_order(c[ROW].tolist() for c in rows if len(c)), lambda r: r[1][KEY_TEXT]):
            values = self.kept.getValue((text,)) if self.kept.containsKey((text,)) else None
            *values, through = values or (*self.start.values(), None)
            now, last, changed = dict(zip(self.start, values, strict=True)), through, False
            for at, row in mine:
                if at is None or (through is not None and at < through):
                    made.append({"late": True, "late_key": ",".join(map(str, json.loads(text))), "late_order": at})
                else:
                    last, changed = at, True
                    if (given := self.step(now, row)) is not None:
                        made.append(given | {"late": False})
                if len(made) == BATCH:
                    yield self._frame(made)
                    made = []
            if changed:
                self.kept.updateValue((text,), (*(now[n] for n in self.start), last))
        yield self._frame(made)

    def close(self) -> None:
        pass

    def _frame(self, made: list[dict]) -> pd.DataFrame:
        frame = pd.DataFrame(made, columns=self.columns, dtype=object)
        return frame.where(frame.notna(), None)


def stateful(stream: DataFrame, keys: list[str], order: str, start: dict, step: Callable[[dict, dict], dict | None], out: str, state: str) -> DataFrame:
    """A fold over each key's rows in order (a whole number): step(state, row) changes the state and may give a row. The state is as
    large as `state` says, in the order of `start`, and the last row's order, whatever the number of rows.

    Batches must come in order too. A row behind the last one that an earlier batch has folded, or without an order, changes
    nothing: it is given back with `late` set, its order and its keys, and in_time() and late_rows() tell the two apart. Rows of equal
    order are folded in any order.

    Keys are worked off in GROUPS groups, by hash, each with the states of its keys in a map; a group is sorted by key, then order, and one
    key's state is held at a time. However many rows a batch has for a group, a task holds one chunk of them, or FAN_IN pieces: the rest is parked in the state, as
    sorted runs, while the batch is worked off. Whole numbers reach step() exactly, also in columns with nulls. The stream needs a
    state store with column families, which results(states=True) sets while it runs.
    """
    if [x.split()[0] for x in state.split(", ")] != list(start):
        raise ValueError("start and state name different values")
    columns = [x.split()[0] for x in f"{out}, {LATE}".split(", ")]
    key = F.to_json(F.array(*[F.col(k).cast("string") for k in keys]), {"ignoreNullFields": "false"})
    row = F.to_json(F.struct("*", key.alias(KEY_TEXT)), {"ignoreNullFields": "false"})
    texts = stream.select(F.pmod(F.xxhash64(key), F.lit(GROUPS)).alias(GROUP), row.alias(ROW))
    return texts.groupBy(GROUP).transformWithStateInPandas(OrderedFold(order, start, step, columns, state), f"{out}, {LATE}", "Append", "None")


def in_time(rows: DataFrame) -> DataFrame:
    """What a fold gave for the rows that came in order."""
    return rows.filter("NOT late").drop("late", "late_key", "late_order")


def late_rows(rows: DataFrame) -> DataFrame:
    """key (as text) and order of the rows that came too late for a fold."""
    return rows.filter("late").select(F.col("late_key").alias("key"), F.col("late_order").alias("order"))
