"""Running values over long histories: each stretch of a key's order is one task's work, not the whole history."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def stretches(stretch: list[Column]) -> dict[str, Column]:
    """The names under which carried() adds a row's stretch, to partition windows by beside the keys."""
    return {f"_s{i}": c for i, c in enumerate(stretch)}


def carried_all(rows: DataFrame, keys: list[str], stretch: list[Column], facts: dict[str, tuple[Column, Callable[[Column], Column]]], ahead: bool = False) -> DataFrame:
    """carried() for several facts at once: name -> (fact, across). All must combine associatively, as `across` is applied to the
    facts of stretches, not to rows."""
    parts = stretches(stretch)
    rows = rows.withColumns(parts)
    by = [*keys, *parts]
    order = Window.partitionBy(*keys).orderBy(*parts)
    order = order.rowsBetween(1, Window.unboundedFollowing) if ahead else order.rowsBetween(Window.unboundedPreceding, -1)
    found = rows.groupBy(*by).agg(*[fact.alias(f"_fact_{n}") for n, (fact, _) in facts.items()])
    found = found.select(*[F.col(c).alias(f"_of{i}") for i, c in enumerate(by)], *[across(F.col(f"_fact_{n}")).over(order).alias(n) for n, (_, across) in facts.items()])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_of{i}")) for i, c in enumerate(by)])
    return rows.join(found, same).drop(*[f"_of{i}" for i in range(len(by))])


def carried(
    rows: DataFrame, keys: list[str], stretch: list[Column], name: str, fact: Column, across: Callable[[Column], Column], ahead: bool = False
) -> DataFrame:
    """Adds the row's stretch (see stretches()) and `name`: `across` over the facts of all stretches of the key before the
    row's own, or after it if `ahead`; null where there are none.

    `stretch` must rise with the order of the rows, so that a window inside it, put together with what is carried, gives
    what a window over the whole key would. A fact is one small row for each stretch, pre-aggregated before it is shuffled.
    Null keys and null stretches are keys and stretches of their own, nulls first.
    """
    return carried_all(rows, keys, stretch, {name: (fact, across)}, ahead)


def positions(rows: DataFrame, keys: list[str], order: list[str], stretch: list[Column], name: str = "position") -> DataFrame:
    """Adds each row's number, from 1, in the order of its key. Rows that tie in all of `order` are numbered in any order."""
    parts = stretches(stretch)
    rows = carried(rows, keys, stretch, "_before", F.count(F.lit(1)), F.sum)
    place = F.row_number().over(Window.partitionBy(*keys, *parts).orderBy(*order)) + F.coalesce("_before", F.lit(0))
    return rows.withColumn(name, place.cast("long")).drop("_before", *parts)


def order_digest(rows: DataFrame, keys: list[str], position: str, digest: str, block: int = 1000, levels: int = 3) -> DataFrame:
    """One SHA-256 for each key's sequence of row digests (in hex), in the order of their positions from 1; another order gives another.

    A tree: the digests of each `block` positions are hashed together in order, then the hashes of each `block` blocks, and so on for
    `levels` levels; what is left is hashed once more. A node holds at most `block` digests, the last one the key's share by block
    to the power of levels.
    """
    nodes = rows.select(*keys, (F.col(position) - 1).alias("_at"), F.col(digest).alias("_hash"), F.lit(1).cast("long").alias("_n"))
    for level in range(levels + 1):
        above = F.floor(F.col("_at") / block).alias("_at") if level < levels else F.lit(0).alias("_at")
        inner = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_at", "_hash"))), lambda x: x["_hash"]), "")
        nodes = nodes.withColumn("_above", above).groupBy(*keys, "_above").agg(F.sha2(inner, 256).alias("_hash"), F.sum("_n").alias("_n")).withColumnRenamed("_above", "_at")
    return nodes.select(*keys, F.col("_hash").alias("digest"), F.col("_n").alias("rows"))
