"""Exact reconciliation of what was accepted, stored and planned."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import floor_to
from .ordered import positions


def reconciled(left: DataFrame, right: DataFrame, keys: list[str], facts: list[str]) -> DataFrame:
    """Both sides' rows by key, with `state` (equal, different, missing_left, missing_right) and the facts that differ.

    One full outer join; facts are compared null-safely.
    """
    a = left.select(*keys, *[F.col(f).alias(f"left_{f}") for f in facts], F.lit(True).alias("_l"))
    b = right.select(*keys, *[F.col(f).alias(f"right_{f}") for f in facts], F.lit(True).alias("_r"))
    both = a.join(b, keys, "full_outer")
    differing = F.array_compact(F.array(*[F.when(~F.col(f"left_{f}").eqNullSafe(F.col(f"right_{f}")), F.lit(f)) for f in facts]))
    state = (
        F.when(F.col("_l").isNull(), "missing_left").when(F.col("_r").isNull(), "missing_right")
        .when(F.size(differing) > 0, "different").otherwise("equal")
    )
    found = both.withColumns({"state": state, "_d": differing})
    in_both = F.col("state") == "different"
    return found.withColumn("differing", F.when(in_both, F.array_join("_d", ",")).otherwise("")).drop("_l", "_r", "_d")


def dealt(rows: DataFrame, *keys: str) -> DataFrame:
    """The rows by hash of the keys, in as many partitions as the session's shuffles have. Adaptive execution leaves a given number as it
    is; it merges others by their compressed bytes, which of narrow rows puts many millions into a task."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def one_sided(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that only one side has, with the side. Both anti-joins use the same shuffles of the keys."""
    left, right = dealt(left.select(*keys), *keys), dealt(right.select(*keys), *keys)
    only = lambda a, b, side: a.join(b, keys, "left_anti").select(*keys, F.lit(side).alias("side"))
    return only(left, right, "left").unionAll(only(right, left, "right"))


def set_differences(left: DataFrame, right: DataFrame, columns: list[str]) -> DataFrame:
    """Rows (with their multiplicity) that one side has more often than the other."""
    a, b = left.select(*columns), right.select(*columns)
    return a.exceptAll(b).withColumn("side", F.lit("left")).unionAll(b.exceptAll(a).withColumn("side", F.lit("right")))


def inconsistent(rows: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Keys with more than one value in any of the columns; minima and maxima tell, without distinct counts."""
    agg = [F.min(c).alias(f"min_{c}") for c in columns] + [F.max(c).alias(f"max_{c}") for c in columns]
    different = reduce(lambda a, b: a | b, [F.col(f"min_{c}") != F.col(f"max_{c}") for c in columns])
    return rows.groupBy(*keys).agg(*agg).filter(different)


def ordinal_gaps(rows: DataFrame, keys: list[str], ordinal: str, start: int = 0) -> DataFrame:
    """Whether each key's ordinals are start, start + 1, ... without gaps or repeats."""
    found = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min(ordinal).alias("first"), F.max(ordinal).alias("last"), F.count_distinct(ordinal).alias("different"))
    return found.withColumn("contiguous", (F.col("first") == start) & (F.col("last") == F.col("n") - 1 + start) & (F.col("different") == F.col("n")))


def second_buckets(plan: DataFrame, actual: DataFrame, keys: list[str], due: str, at: str, key: str, size: str, grid: DataFrame, tolerance: int) -> DataFrame:
    """For each second of a grid: what was scheduled, accepted of it (early, late), and admitted in that second itself.

    Plan and actual rows meet once, on the event; both groupings are over seconds, and empty seconds stay as zeros.
    """
    both = plan.join(actual.select(*keys, key, F.col(at).alias("_at")), [*keys, key], "left")
    lateness = F.col("_at") - F.col(due)
    by_due = both.groupBy(*keys, F.col(due).alias("second")).agg(
        F.count(F.lit(1)).alias("scheduled"), F.sum(size).alias("scheduled_bytes"), F.count("_at").alias("accepted"),
        F.count(F.when(lateness < 0, 1)).alias("early"), F.count(F.when(lateness > 0, 1)).alias("late"),
        F.count(F.when(F.abs(lateness) > tolerance, 1)).alias("out_of_window"),
    )
    by_actual = actual.groupBy(*keys, F.col(at).alias("second")).agg(F.count(F.lit(1)).alias("admitted"))
    rows = grid.join(by_due, [*keys, "second"], "left").join(by_actual, [*keys, "second"], "left")
    counts = ["scheduled", "scheduled_bytes", "accepted", "early", "late", "out_of_window", "admitted"]
    return rows.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in counts})


def stream_summary(rows: DataFrame, stream: str, second: str, size: str, burst: Column, target: int) -> DataFrame:
    """Roll-up of each stream: records, bytes, those in burst seconds, and whether it reached its target."""
    return (
        rows.groupBy(stream)
        .agg(F.count(F.lit(1)).alias("records"), F.sum(size).alias("bytes"), F.count(F.when(burst, 1)).alias("burst_records"), F.max(second).alias("last_second"))
        .withColumn("passed", F.col("records") >= target)
    )


def merged_traces(parts: list[DataFrame], due: str, key: str) -> tuple[DataFrame, DataFrame]:
    """All partitions' rows in (due, key) order, and the keys that stand in more than one row."""
    whole = reduce(DataFrame.unionByName, parts)
    repeated = whole.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return whole.orderBy(due, key), repeated


def trace_places(rows: DataFrame, due: str, key: str, part: str, width: int = 1 << 16) -> DataFrame:
    """The place of each row, from 1, in the order of (due, key, part) of the whole trace. Places are counted inside stretches (a due
    time and `width` keys), and those of the stretches before are added, so that no task sees more than one of them."""
    return positions(rows, [], [due, key, part], [F.col(due), floor_to(key, width)], "place")


def set_digest(rows: DataFrame, keys: list[str], digest: str, level_digits: int = 2, levels: int = 3) -> DataFrame:
    """One SHA-256 for each key's set of row digests, whatever their order and partitioning.

    A tree: digests (in hex) that share their first level_digits * levels digits are sorted and hashed together, then the
    hashes of each higher level in the order of those digits. A leaf holds the set's share by 16 to the power of all digits
    (16.8 million leaves by default), an inner node at most 16 to the power of level_digits.
    """
    prefix = F.substring(digest, 1, level_digits * levels).alias("_p")
    nodes = rows.groupBy(*keys, prefix).agg(F.sha2(F.concat_ws("", F.sort_array(F.collect_list(digest))), 256).alias("_hash"), F.count(F.lit(1)).alias("_n"))
    for level in range(levels - 1, -1, -1):
        inner = F.concat_ws("", F.transform(F.sort_array(F.collect_list(F.struct("_p", "_hash"))), lambda x: x["_hash"]))
        above = F.substring("_p", 1, level_digits * level).alias("_p")
        nodes = nodes.groupBy(*keys, *([above] if level else [])).agg(F.sha2(inner, 256).alias("_hash"), F.sum("_n").alias("_n"))
    return nodes.select(*keys, F.col("_hash").alias("digest"), F.col("_n").alias("rows"))
