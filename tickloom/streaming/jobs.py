"""Structured Streaming twins of the batch operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager, nullcontext

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from ..functions.histograms import BOUNDS_NS
from ..operators.universe import lifecycle_step  # noqa: F401  (the batch rule that lifecycle() follows)
from ..shared import shared_dir
from .folds import in_time, late_rows, stateful  # noqa: F401

#: How long a window stays open for late events (0 to 60 minutes).
CLOSE_DELAY = "5 minutes"


def file_stream(spark: SparkSession, folder: str, schema: StructType, pattern: str, files_per_batch: int | None = 100) -> DataFrame:
    """Closed files of a folder as a stream: each once, also after a restart from its checkpoint; unfinished ones never. Without a
    number of files, a batch takes all that are there."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).parquet(folder)


def run_available(stream: DataFrame, out: str, checkpoint: str, mode: str = "append", each: Callable[[DataFrame, int], DataFrame] | None = None) -> None:
    """Works off all that is there, and stops. Each batch's rows go to a folder of its own, so that a batch that is run again
    after a failure replaces what it had written."""

    def put(batch: DataFrame, number: int) -> None:
        rows = each(batch, number) if each else batch
        rows.write.mode("overwrite").parquet(f"{out}/batch={number}")

    stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(put).trigger(availableNow=True).start().awaitTermination()


@contextmanager
def state_store(spark: SparkSession) -> Iterator[None]:
    """The state store that streams with several states for a key need, for the streams that start inside."""
    name, before = "spark.sql.streaming.stateStore.providerClass", spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def results(stream: DataFrame, mode: str = "append", keys: list[str] | None = None, each: Callable | None = None, states: bool = False) -> DataFrame:
    """Runs a stream over what is there and reads its result; with keys, the last update of each; with states, in state_store()."""
    spark = stream.sparkSession
    folder = f"{shared_dir(spark)}/stream-{uuid.uuid4()}"
    with state_store(spark) if states else nullcontext():
        run_available(stream, f"{folder}/out", f"{folder}/checkpoint", mode, each)
    rows = spark.read.parquet(f"{folder}/out")
    if keys:
        w = Window.partitionBy(*keys).orderBy(F.desc("batch"))
        rows = rows.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")
    return rows.drop("batch")


def windowed_bars(trades: DataFrame, keys: list[str], time: str, size: str, order: list[str], delay: str | None = CLOSE_DELAY) -> DataFrame:
    """Bars of tumbling, epoch-aligned, half-open windows that close `delay` after their end by event time; rows that come later
    are dropped. Without a delay windows never close: a late row gives its bar anew, and the state is one row a bar."""
    at = F.struct(*order)
    return (
        (trades.withWatermark(time, delay) if delay else trades)
        .groupBy(*keys, F.window(time, size))
        .agg(F.min_by("price", at).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", at).alias("close"), F.sum("quantity").alias("base_volume"), F.count(F.lit(1)).alias("trade_count"))
        .select(*keys, F.col("window.start").alias("window_start"), "open", "high", "low", "close", "base_volume", "trade_count")
    )


def deduplicated(trades: DataFrame, keys: list[str], time: str, delay: str = "1 day") -> DataFrame:
    """The first row of each identifier, remembered until the watermark passes it. Rows without an identifier all stay."""
    known = trades.filter(F.col("trade_id").isNotNull()).withWatermark(time, delay).dropDuplicatesWithinWatermark([*keys, "trade_id"])
    return known.unionByName(trades.filter(F.col("trade_id").isNull()))


def hysteresis(refreshes: DataFrame, key: str, time: str, grace: int, key_type: str = "long") -> DataFrame:
    """Exit grace across refreshes, a key at a time; the stream's twin of exit_grace()."""

    def step(s: dict, r: dict) -> dict | None:
        if r["rank"] is not None:
            s.update(left=-1, rank=int(r["rank"]), top=True, alive=True)
            return {key: r[key], time: r[time], "in_grace": False, "exit_started": None, "shown_rank": int(r["rank"])}
        if not s["top"]:
            return None
        if s["left"] < 0:
            s["left"] = int(r[time])
        s["alive"] = s["alive"] and bool(r["eligible"])
        if s["alive"] and r[time] - s["left"] < grace:
            return {key: r[key], time: r[time], "in_grace": True, "exit_started": s["left"], "shown_rank": s["rank"]}
        s["top"] = False
        return None

    start = {"left": -1, "rank": 0, "top": False, "alive": True}
    return stateful(refreshes, [key], time, start, step, f"{key} {key_type}, {time} int, in_grace boolean, exit_started int, shown_rank long", "left long, rank long, top boolean, alive boolean")


def lifecycle_rule(state: str, status: str, tradable: bool, official_past: bool, first_snapshot: bool) -> str:
    """lifecycle_step() for one row; an empty state is unknown."""
    if status == "delisted":
        return "relist_pending"
    if not state:
        if status == "preopen":
            return "pending_official" if official_past else "pending"
        return "active_new" if tradable and (official_past or not first_snapshot) else "baseline"
    return "active_new" if tradable and state in ("relist_pending", "pending", "pending_official") else state


def lifecycle(snapshots: DataFrame, key: str, order: str) -> DataFrame:
    """Listing state and generation of each key after each snapshot row; each activation starts a generation."""

    def step(s: dict, r: dict) -> dict:
        after = lifecycle_rule(s["state"], r["status"], bool(r["tradable"]), bool(r["official_past"]), bool(r["first_snapshot"]))
        s["generation"] += int(after == "active_new" and s["state"] != "active_new")
        s["state"] = after
        return {key: r[key], order: r[order], "state": after, "generation": s["generation"]}

    return stateful(snapshots, [key], order, {"state": "", "generation": 0}, step, f"{key} long, {order} long, state string, generation long", "state string, generation long")


def book_validity(messages: DataFrame, key: str, order: str) -> DataFrame:
    """Replay of linked book messages: after a gap a generation is invalid until the next authority."""

    def step(s: dict, r: dict) -> dict:
        gap = False
        if r["kind"] == "snapshot":
            s.update(segment=s["segment"] + 1, valid=True)
        else:
            gap = s["started"] and r["prev_seq"] is not None and int(r["prev_seq"]) != s["last"]
            s["valid"] = s["valid"] and not gap
        s.update(last=int(r["seq"]), started=True)
        return {"seq": r["seq"], "valid": bool(s["valid"] and s["segment"] > 0), "break": bool(gap)}

    start = {"segment": 0, "valid": True, "last": 0, "started": False}
    return stateful(messages, [key], order, start, step, "seq long, valid boolean, break boolean", "segment long, valid boolean, last long, started boolean")


def silences(events: DataFrame, key: str, time: str, threshold: int) -> DataFrame:
    """Times without an event longer than the threshold, told when the next event comes."""

    def step(s: dict, r: dict) -> dict | None:
        before, s["last"] = s["last"], int(r[time])
        if before >= 0 and r[time] - before > threshold:
            return {key: r[key], "silent_from": before, "silent_to": int(r[time])}
        return None

    return stateful(events, [key], time, {"last": -1}, step, f"{key} string, silent_from long, silent_to long", "last long")


def slo_monitor(samples: DataFrame, key: str, slot: str, slots: int, slo_ns: int) -> DataFrame:
    """Transitions between met and breached of a rolling histogram over the last `slots` slots. The state is the histogram of each
    live slot; a sample older than that belongs to no window that is still to be told, and is passed over. Batches should hold whole slots: each slot's state is
    told as of the batch it comes in."""
    size = len(BOUNDS_NS)

    def run(k: tuple, batches: Iterator[pd.DataFrame], kept: GroupState) -> Iterator[pd.DataFrame]:
        old, counts, tops, breached = kept.get if kept.exists else ([], [], [], False)
        live = {int(s): [list(counts[i * size : (i + 1) * size]), int(tops[i])] for i, s in enumerate(old)}
        made, came = [], {}
        for chunk in batches:  # only counts of a slot outlive their chunk
            buckets = pd.Series(BOUNDS_NS, dtype="int64").searchsorted(chunk["lag_ns"])
            for now, part in chunk.assign(_b=buckets).groupby(slot):
                added = came.setdefault(int(now), [[0] * size, 0])
                for b, n in part["_b"].value_counts().items():
                    added[0][int(b)] += int(n)
                added[1] = max(added[1], int(part["lag_ns"].max()))
        for now in sorted(came):
            if live and now <= max(live) - slots:
                continue
            slot_counts, top = live.setdefault(now, [[0] * size, 0])
            live[now] = [[a + b for a, b in zip(slot_counts, came[now][0], strict=True)], max(top, came[now][1])]
            live = {s: v for s, v in live.items() if s > max(live) - slots}
            total = [sum(v[0][i] for v in live.values()) for i in range(size)]
            rank, seen, p99 = max(1, -(-99 * sum(total) // 100)), 0, None
            for i, n in enumerate(total):
                seen += n
                if seen >= rank:
                    p99 = BOUNDS_NS[i]
                    break
            state = max(v[1] for v in live.values()) > slo_ns or (p99 or 0) > slo_ns
            if state != breached:
                made.append({key: k[0], slot: int(now), "state": state})
                breached = state
        kept.update((list(live), [n for v in live.values() for n in v[0]], [v[1] for v in live.values()], breached))
        yield pd.DataFrame(made, columns=[key, slot, "state"])

    return samples.groupBy(key).applyInPandasWithState(
        run, f"{key} string, {slot} long, state boolean", "slots array<long>, counts array<long>, tops array<long>, breached boolean", "append", GroupStateTimeout.NoTimeout
    )
