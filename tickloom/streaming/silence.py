"""Alarms of keys that have fallen silent, from event-time timers."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


class SilenceAlarm(StatefulProcessor):
    """State: the last event's time, and whether its silence has been told."""

    def __init__(self, key: str, threshold_ms: int):
        self.key, self.threshold = key, threshold_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("last", "at long, told boolean")

    def _rows(self, key: tuple, silent: list[int], timer: bool) -> pd.DataFrame:
        return pd.DataFrame({self.key: pd.Series([key[0]] * len(silent), dtype=object), "silent_from_ms": pd.Series(silent, dtype="int64"), "by_timer": pd.Series([timer] * len(silent), dtype=bool)})

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        at, told = self.state.get() if self.state.exists() else (None, False)
        old = at
        times: set[int] = set()
        for chunk in rows:
            if len(chunk):
                times.update(int(t) for t in chunk["event_ms"])
        silent = []
        for now in sorted(t for t in times if at is None or t > at):
            if at is not None and now - at > self.threshold and not told:
                silent.append(at)
            at, told = now, False
        self.state.update((at, told))
        if old != at:
            if old is not None:
                self.handle.deleteTimer(old + self.threshold)
            self.handle.registerTimer(at + self.threshold)
        yield self._rows(key, silent, False)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        at, _ = self.state.get()
        due = expiredTimerInfo.getExpiryTimeInMs() == at + self.threshold
        if due:
            self.state.update((at, True))
        yield self._rows(key, [at] if due else [], True)

    def close(self) -> None:
        pass


def silence_alarms(events: DataFrame, key: str, time: str, delay: str, threshold_ms: int) -> DataFrame:
    """key, silent_from_ms (the last event's time), by_timer: a row for each time that a key has no event for longer than the
    threshold. The alarm comes as soon as the watermark has passed the threshold, without waiting for the key's next event; where
    the next event is in the same batch or the one after, it tells of the silence itself. Each silence is told once.

    `time` is a timestamp. State: two values and one timer for each key. A batch's distinct milliseconds of a key are sorted in its task.
    """
    kind = dict(events.dtypes)[key]
    rows = events.withWatermark(time, delay).withColumn("event_ms", F.unix_millis(time))
    return rows.groupBy(key).transformWithStateInPandas(SilenceAlarm(key, threshold_ms), f"{key} {kind}, silent_from_ms long, by_timer boolean", "Append", "EventTime")
