"""Order books: continuity rules, segments, validity, level lifetimes, window-end states, deep snapshots."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import HOUR, floor_to, imbalance, microprice, mid
from .ordered import carried, carried_all

NUMBER = "decimal(18,9)"


def segmented(messages: DataFrame, keys: list[str], order: list[str], width: int) -> DataFrame:
    """Adds `segment`: how many authoritative messages (kind = snapshot) came so far. Segments do not depend on each other,
    since an authority replaces all state; segment 0 has none.

    Authorities are counted inside stretches of `width` of the first order column, and the counts of those before added."""
    one = F.when(F.col("kind") == "snapshot", 1).otherwise(0)
    rows = carried(messages, keys, [floor_to(order[0], width)], "_before", F.sum(one), F.sum)
    run = Window.partitionBy(*keys, "_s0").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("segment", F.sum(one).over(run) + F.coalesce("_before", F.lit(0))).drop("_before", "_s0")


# Continuity: whether a message breaks its segment. Each rule sees the number of the segment's message before it (`_last`), the largest
# number so far (`_seen`) and the message's place in the segment, from 1 (`_place`).

def _link() -> Column:
    """prev_seq names the last seq. A heartbeat repeats it (seq = prev_seq); a maintenance reset goes back (seq < prev_seq)."""
    return F.col("prev_seq") != F.col("_last")


def _range_ids() -> Column:
    """first_seq .. seq must reach up to the next number; messages that end before it are stale, not wrong."""
    return (F.col("seq") > F.col("_seen")) & (F.col("first_seq") > F.col("_seen") + 1)


def _named_previous() -> Column:
    """The first update covers the snapshot's number; later ones name the number before (prev_seq)."""
    covers = (F.col("first_seq") <= F.col("_last")) & (F.col("seq") >= F.col("_last"))
    return F.when(F.col("_place") == 2, ~covers).otherwise(F.col("prev_seq") != F.col("_last"))


def _overlap_then_link() -> Column:
    """The first update overlaps the snapshot; then prev_seq links exactly. A prev_seq of 0 resets."""
    overlaps = (F.col("prev_seq") < F.col("_last")) & (F.col("seq") > F.col("_last"))
    return (F.col("prev_seq") != 0) & F.when(F.col("_place") == 2, ~overlaps).otherwise(F.col("prev_seq") != F.col("_last"))


def _monotone() -> Column:
    """Numbers only grow; a jump is no break, a repeat or a step back is."""
    return F.col("seq") <= F.col("_last")


def _snapshot_chain() -> Column:
    """Snapshots reset; numbers between them carry no rule."""
    return F.lit(False)


CONTINUITY: dict[str, Callable[[], Column]] = {
    "okx": _link,
    "binance_spot": _range_ids,
    "binance_futures": _named_previous,
    "bybit": _snapshot_chain,
    "bitget": _overlap_then_link,
    "kraken_futures": _monotone,
}


def validated(messages: DataFrame, keys: list[str], order: list[str], rule: str, width: int) -> DataFrame:
    """Adds segment (see segmented()), `break` and `valid`: a segment is invalid from its first break on, and before any
    authority.

    A prefix scan: what a segment's earlier stretches (`width` of the first order column) leave to the later ones is the last and the
    largest number, the number of messages, and whether one was a break; so a long segment, also the one before any authority, is the
    work of many tasks.
    """
    rows = segmented(messages, keys, order, width)
    by, stretch = [*keys, "segment"], [floor_to(order[0], width)]
    last = lambda c: F.last(c, ignorenulls=True)
    rows = carried_all(rows, by, stretch, {"_b_last": (F.max_by("seq", F.struct(*order)), last), "_b_seen": (F.max("seq"), F.max), "_b_place": (F.count(F.lit(1)), F.sum)})
    w = Window.partitionBy(*by, "_s0").orderBy(*order)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns(
        {"_last": F.coalesce(F.lag("seq").over(w), F.col("_b_last")), "_seen": F.greatest(F.max("seq").over(before), F.col("_b_seen")), "_place": F.row_number().over(w) + F.coalesce("_b_place", F.lit(0))}
    )
    gap = F.coalesce(F.when(F.col("kind") == "snapshot", F.lit(False)).otherwise(CONTINUITY[rule]()), F.lit(False))
    rows = rows.withColumn("break", gap).drop("_s0", "_last", "_seen", "_place", "_b_last", "_b_seen", "_b_place")
    rows = carried_all(rows, by, stretch, {"_broken": (F.max(F.col("break").cast("int")), F.max)})
    broken = F.greatest(F.max(F.col("break").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)), F.coalesce("_broken", F.lit(0)))
    return rows.withColumn("valid", (F.col("segment") > 0) & (broken == 0)).drop("_s0", "_broken")


def exploded_levels(messages: DataFrame, keep: list[str]) -> DataFrame:
    """A row for each level of a message: side, place, price, quantity, from [[price, quantity], ...] texts."""
    sides = F.array(F.struct(F.lit("bid").alias("side"), F.col("bids").alias("levels")), F.struct(F.lit("ask").alias("side"), F.col("asks").alias("levels")))
    rows = messages.select(*keep, F.explode(sides).alias("_s")).select(*keep, F.col("_s.side").alias("side"), F.posexplode("_s.levels").alias("place", "_l"))
    return rows.select(*keep, "side", "place", F.get("_l", F.lit(0)).cast(NUMBER).alias("price"), F.get("_l", F.lit(1)).cast(NUMBER).alias("quantity"))


def lifetimes(levels: DataFrame, keys: list[str], order: str, time: str, until: str) -> DataFrame:
    """How long each level's quantity stands: [from, to) in each segment, side and price. Of several changes of a price in
    one message the last counts; a quantity of 0 takes the level away; a level stands at most until the segment's end."""
    last = Window.partitionBy(*keys, "segment", "side", "price", order).orderBy(F.desc("place"))
    once = levels.withColumn("_n", F.row_number().over(last)).filter("_n = 1").drop("_n")
    w = Window.partitionBy(*keys, "segment", "side", "price").orderBy(order)
    stand = once.withColumns({"from_ns": F.col(time), "to_ns": F.coalesce(F.lead(time).over(w), F.col(until))})
    return stand.filter("quantity > 0 AND from_ns < to_ns").select(*keys, "segment", "side", "price", "quantity", "from_ns", "to_ns")


def segment_ends(messages: DataFrame, keys: list[str], time: str, end: int) -> DataFrame:
    """keys, segment, until: when the next segment starts, or the job's end."""
    starts = messages.groupBy(*keys, "segment").agg(F.min(time).alias("_start"))
    w = Window.partitionBy(*keys).orderBy("segment")
    return starts.select(*keys, "segment", F.coalesce(F.lead("_start").over(w), F.lit(end)).alias("until"))


def states_at(stands: DataFrame, keys: list[str], interval: int) -> DataFrame:
    """Levels that stand at each window end: a lifetime is put out once for each end in [from, to), which is an interval
    join without comparing pairs."""
    first = F.col("from_ns") + F.pmod(-F.col("from_ns"), F.lit(interval))
    ends = stands.withColumn("_first", first).filter("_first < to_ns")
    return ends.select(*keys, "side", "price", "quantity", F.explode(F.sequence("_first", F.col("to_ns") - 1, F.lit(interval).cast("long"))).alias("window_end_ns"))


def update_counts(messages: DataFrame, keys: list[str], time: str, interval: int) -> DataFrame:
    """Of each window: its end, and the number of messages in it that are neither an authority nor a heartbeat, which repeats the last
    number (seq = prev_seq) and changes nothing."""
    end = (floor_to(time, interval) + interval).alias("window_end_ns")
    return messages.filter("kind <> 'snapshot' AND NOT seq <=> prev_seq").groupBy(*keys, end).agg(F.count(F.lit(1)).alias("updates"))


def valid_at_ends(messages: DataFrame, keys: list[str], order: str, time: str, interval: int) -> DataFrame:
    """keys, window_end_ns, valid: as of the last message up to each window's end. Only ends of windows with messages have a row; each
    holds until the next one."""
    end = (F.col(time) + F.pmod(-F.col(time), F.lit(interval))).alias("window_end_ns")
    return messages.groupBy(*keys, end).agg(F.max_by("valid", F.struct(time, order)).alias("valid"))


def only_valid(features: DataFrame, validity: DataFrame, keys: list[str], kept: list[str]) -> DataFrame:
    """The features with `valid`, all but keys and `kept` null where the book was not valid at the window's end. Both sides are one
    sequence of ends for each key, in which features take the last validity."""
    names = [c for c in features.columns if c not in (*keys, "window_end_ns")]
    rows = features.withColumn("_is", F.lit(True)).unionByName(validity.select(*keys, "window_end_ns", F.col("valid").alias("_valid")), allowMissingColumns=True)
    so_far = Window.partitionBy(*keys).orderBy("window_end_ns", F.col("_valid").isNull()).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("valid", F.coalesce(F.last("_valid", ignorenulls=True).over(so_far), F.lit(False))).filter("_is")
    return rows.select(*keys, "window_end_ns", *[F.col(c) if c in kept else F.when(F.col("valid"), F.col(c)).alias(c) for c in names], "valid")


def book_features(levels: DataFrame, keys: list[str], depths: tuple[int, ...] = (1, 5)) -> DataFrame:
    """Mid, spread, microprice, quantity and notional of the best levels, and imbalance, of each key's book."""
    better = F.when(F.col("side") == "bid", -F.col("price")).otherwise(F.col("price"))
    w = Window.partitionBy(*keys, "side").orderBy(better)
    rows = levels.withColumns({"level": F.row_number().over(w)})
    at = lambda side, n: (F.col("side") == side) & (F.col("level") <= n)
    pick = lambda side, c: F.max(F.when(at(side, 1), F.col(c)))
    sums = []
    for n in depths:
        for side in ("bid", "ask"):
            sums += [
                F.coalesce(F.sum(F.when(at(side, n), F.col("quantity"))), F.lit(0)).cast("double").alias(f"{side}_quantity_{n}"),
                F.coalesce(F.sum(F.when(at(side, n), F.col("price") * F.col("quantity"))), F.lit(0)).cast("double").alias(f"{side}_notional_{n}"),
            ]
    best = {f"{s}_{c}": pick(s, c).cast("double").alias(f"{s}_{c}") for s in ("bid", "ask") for c in ("price", "quantity")}
    rows = rows.groupBy(*keys).agg(*best.values(), *sums)
    b, bq, a, aq = (F.col(c) for c in ("bid_price", "bid_quantity", "ask_price", "ask_quantity"))
    top = depths[-1]
    return rows.withColumns({"mid": mid(b, a), "spread": a - b, "microprice": microprice(b, bq, a, aq), f"imbalance_{top}": imbalance(F.col(f"bid_notional_{top}"), F.col(f"ask_notional_{top}"))})


def last_authority(messages: DataFrame, keys: list[str], order: list[str], columns: list[str], width: int) -> DataFrame:
    """As of each message: the columns of the newest authoritative message so far, also from earlier stretches of `width` of
    the first order column."""
    authority = F.when(F.col("kind") == "snapshot", F.struct(*columns))
    newest = F.max_by(authority, F.when(F.col("kind") == "snapshot", F.struct(*order)))
    rows = carried(messages, keys, [floor_to(order[0], width)], "_before", newest, lambda c: F.last(c, ignorenulls=True))
    run = Window.partitionBy(*keys, "_s0").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    latest = F.last(authority, ignorenulls=True).over(run)
    return rows.withColumn("authority", F.coalesce(latest, "_before")).drop("_before", "_s0")


def valid_coverage(messages: DataFrame, keys: list[str], time: str, interval: int) -> DataFrame:
    """Of each window: how long the book was valid, and how old its last message is at the window's end.

    A message's state lasts until the next one, also of a later hour; a state that spans windows is cut at each.
    """
    rows = carried(messages, keys, [floor_to(time, HOUR)], "_after", F.min(time), F.min, ahead=True)
    w = Window.partitionBy(*keys, "_s0").orderBy(time)
    rows = rows.withColumn("_next", F.coalesce(F.lead(time).over(w), "_after")).filter(F.col("_next") > F.col(time))
    start = F.col(time) - F.pmod(F.col(time), F.lit(interval))
    cut = rows.select(*keys, F.col(time).alias("_t"), "_next", "valid", F.explode(F.sequence(start, F.col("_next") - 1, F.lit(interval).cast("long"))).alias("window_start_ns"))
    length = F.least(F.col("_next"), F.col("window_start_ns") + interval) - F.greatest(F.col("_t"), F.col("window_start_ns"))
    return cut.groupBy(*keys, "window_start_ns").agg(
        F.sum(F.when(F.col("valid"), length).otherwise(0)).alias("valid_ns"),
        (F.col("window_start_ns") + interval - F.max("_t")).alias("staleness_ns"),
    )


def deep_features(snapshots: DataFrame, keys: list[str], time: str, interval: int, bands_bps: tuple[int, ...] = (10, 50)) -> DataFrame:
    """Of each window: number of deep snapshots, and minimum, mean, maximum and last of their notional curves by side and
    distance from mid. Nothing is carried over from other windows."""
    keep = [*keys, time, "_id"]
    rows = snapshots.withColumn("_id", F.monotonically_increasing_id())
    levels = exploded_levels(rows, keep)
    best = Window.partitionBy("_id")
    bid, ask = (F.max(F.when(F.col("side") == "bid", F.col("price"))).over(best), F.min(F.when(F.col("side") == "ask", F.col("price"))).over(best))
    near = levels.withColumn("_mid", (bid + ask) / 2).withColumn("_bps", F.abs(F.col("price") - F.col("_mid")) / F.nullif("_mid", F.lit(0)) * 10_000)
    curve = [
        F.coalesce(F.sum(F.when((F.col("side") == s) & (F.col("_bps") <= b), F.col("price") * F.col("quantity"))), F.lit(0)).cast("double").alias(f"{s}_{b}")
        for s in ("bid", "ask") for b in bands_bps
    ]
    one = near.groupBy(*keep).agg(*curve)
    names = [f"{s}_{b}" for s in ("bid", "ask") for b in bands_bps]
    start = F.col(time) - F.pmod(F.col(time), F.lit(interval))
    stats = [f(n).alias(f"{n}_{k}") for n in names for k, f in (("min", F.min), ("mean", F.avg), ("max", F.max))]
    ends = [F.max_by(n, F.struct(time, "_id")).alias(f"{n}_end") for n in names]
    return one.groupBy(*keys, start.alias("window_start_ns")).agg(F.count(F.lit(1)).alias("snapshots"), *stats, *ends)


def _checksum_text(number: str) -> str:
    return number.replace(".", "").lstrip("0")


def checksum_chain(messages: DataFrame, keys: list[str], order: str, depth: int = 10) -> DataFrame:
    """Folds each segment's messages in order, trims each side to `depth` levels after each, and compares the CRC32 of the
    best ten asks and bids with the message's checksum: keys, order, computed, matches.

    The trimmed levels get no delete message, so the state depends on all that came before; only this rule needs a fold, one
    for each segment, so that instruments with many snapshots are spread.
    """
    groups = [*keys, "segment"]
    schema = ", ".join(f"`{c}` {t}" for c, t in messages.dtypes if c in (*groups, order)) + ", computed long, matches boolean"
    names = [c for c in messages.columns if c in (*groups, order)]

    def fold(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(order)
        book: dict[str, dict[str, str]] = {"bids": {}, "asks": {}}
        computed = []
        for kind, bids, asks in zip(rows["kind"], rows["bids"], rows["asks"], strict=True):
            for side, changes in (("bids", bids), ("asks", asks)):
                if kind == "snapshot":
                    book[side] = {}
                levels = book[side]
                for price, quantity in changes if changes is not None else ():
                    if float(quantity) == 0:
                        levels.pop(price, None)
                    else:
                        levels[price] = quantity
                best = sorted(levels, key=float, reverse=side == "bids")
                for price in best[depth:]:
                    del levels[price]
            text = "".join(_checksum_text(p) + _checksum_text(book[s][p]) for s in ("asks", "bids") for p in sorted(book[s], key=float, reverse=s == "bids")[:10])
            computed.append(zlib.crc32(text.encode()))
        return rows[names].assign(computed=computed, matches=[c == e for c, e in zip(computed, rows["checksum"], strict=True)])

    return messages.groupBy(*groups).applyInPandas(fold, schema)

