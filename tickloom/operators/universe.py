"""Instrument universe: catalog changes, ranking, hysteresis, capacity, assignment."""

from __future__ import annotations

from fractions import Fraction
from functools import reduce
from math import ceil
from operator import and_

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import SECOND
from .reconcile import set_digest

# Reasons for being in the universe, as bit flags.
FIXED, NEW_LISTING, TOP_N, TOP_N_GRACE = 1, 2, 4, 8


def top_n(catalog: DataFrame, scope: list[str], n: int, now_ns: Column | int, max_age_ns: int) -> DataFrame:
    """The n largest by turnover in each scope and quote asset, ties by key: of those present, tradable, covered, with a
    turnover in their quote asset that is not from the future and not too old."""
    now = F.lit(now_ns) if isinstance(now_ns, int) else now_ns
    age = now - F.col("turnover_observed_at_ns")
    fit = F.col("present") & F.col("tradable") & F.col("covered") & (F.col("turnover_currency") == F.col("quote_asset")) & (age >= 0) & (age <= max_age_ns)
    w = Window.partitionBy(*scope, "quote_asset").orderBy(F.desc("turnover"), "instrument_key")
    return catalog.filter(fit).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def bound_turnover(catalog: DataFrame, observed: DataFrame, revisions: DataFrame, keys: list[str]) -> DataFrame:
    """The catalog's rows with the newest turnover (turnover, turnover_currency, turnover_observed_at_ns) that was taken from the
    catalog revision that they are of, while that revision was valid; a turnover of another revision binds to nobody.

    `revisions` has catalog_revision, valid_from_ns and valid_to_ns (half-open). Observations are reduced to one for each key and
    revision before they meet the catalog.
    """
    taken = observed.join(revisions, "catalog_revision").filter("turnover_observed_at_ns >= valid_from_ns AND turnover_observed_at_ns < valid_to_ns")
    value = F.struct("turnover", "turnover_currency", "turnover_observed_at_ns")
    newest = taken.groupBy(*keys, "catalog_revision").agg(F.max_by(value, F.struct("turnover_observed_at_ns", "turnover")).alias("_t"))
    return catalog.join(newest, [*keys, "catalog_revision"], "left").select(*catalog.columns, "_t.*")


def active_new_listings(catalog: DataFrame, now_ns: int, duration_ns: int) -> DataFrame:
    """Listings in their half-open capture window [start, start + duration)."""
    start = F.col("new_listing_started_at_ns")
    return catalog.filter(F.col("present") & F.col("tradable") & (F.col("listing_state") == "active_new") & F.col("new_listing_eligible") & (start <= now_ns) & (F.lit(now_ns) - start < duration_ns))


def exit_grace(history: DataFrame, keys: list[str], time: str, grace: int) -> DataFrame:
    """For each refresh of each key: whether it is in grace after leaving the top, when it left and its last rank.

    `history` has a row for each refresh and key, with `rank` (null outside the top) and `eligible`. The reason for a key's
    stay is found with running windows: the last refresh in the top, the first one after it, and whether the key was
    ineligible since. A key's ranks are rare rows of its own history, so no refresh has to wait for another's result.
    """
    w = Window.partitionBy(*keys).orderBy(time)
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    rows = history.withColumns(
        {
            "_top": F.last(F.when(F.col("rank").isNotNull(), F.col(time)), ignorenulls=True).over(run),
            "_rank": F.last("rank", ignorenulls=True).over(run),
        }
    )
    since = Window.partitionBy(*keys, "_top").orderBy(time).rowsBetween(Window.unboundedPreceding, 0)
    out = F.col("rank").isNull() & F.col("_top").isNotNull()
    rows = rows.withColumns({"_exit": F.min(F.when(out, F.col(time))).over(since), "_broken": F.max(F.when(out & ~F.col("eligible"), 1).otherwise(0)).over(since)})
    # Once the grace is over it does not come back, even if time is uneven: it only grows.
    in_grace = out & (F.col("_broken") == 0) & (F.col(time) - F.col("_exit") < grace)
    return rows.withColumns(
        {"in_grace": F.coalesce(in_grace, F.lit(False)), "exit_started": F.when(in_grace, F.col("_exit")), "shown_rank": F.when(in_grace, F.col("_rank")).otherwise(F.col("rank"))}
    ).drop("_top", "_rank", "_exit", "_broken")


def universe(parts: dict[int, DataFrame], keys: list[str]) -> DataFrame:
    """Union of candidate sets with all their reasons as flags, and the priority that follows (0 fixed, 1 new, 2 top)."""
    tagged = [f.select(*keys, F.lit(reason).alias("reason")) for reason, f in parts.items()]
    rows = tagged[0]
    for t in tagged[1:]:
        rows = rows.unionByName(t)
    reasons = F.col("reasons")
    priority = F.when(reasons.bitwiseAND(FIXED) > 0, 0).when(reasons.bitwiseAND(NEW_LISTING) > 0, 1).otherwise(2)
    return rows.groupBy(*keys).agg(F.bit_or("reason").alias("reasons")).withColumn("priority", priority)


def changed(before: DataFrame, after: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """Added, removed and updated rows between two snapshots, with previous and current values."""
    side = lambda f, n: f.select(*keys, F.struct(*fields).alias(n))
    both = side(before, "previous").join(side(after, "current"), keys, "full_outer")
    kind = F.when(F.col("previous").isNull(), "added").when(F.col("current").isNull(), "removed").otherwise("updated")
    return both.filter(~F.col("previous").eqNullSafe(F.col("current"))).withColumn("change", kind)


def change_feed(changes: list[DataFrame], keys: list[str]) -> DataFrame:
    """Change sets (keys, change, revision, stream) as one feed with identifiers that depend on their content alone."""
    rows = changes[0]
    for c in changes[1:]:
        rows = rows.unionByName(c)
    return rows.withColumn("event_id", F.sha2(F.to_json(F.struct("stream", "revision", *keys, "change")), 256))


def feed_order(feed: DataFrame, keys: list[str]) -> DataFrame:
    """The feed's position by catalog revision, stream, ordinal and identifier, in each key."""
    w = Window.partitionBy(*keys).orderBy("revision", "stream", "event_id")
    return feed.withColumn("position", F.row_number().over(w))


def replay_outcome(snapshots: DataFrame, keys: list[str], arrival: str, time: str, digest: str) -> DataFrame:
    """What applying each arriving snapshot does: applied, replay (same time and content), conflict (same time, other
    content) or stale (older than the newest applied)."""
    run = Window.partitionBy(*keys).orderBy(arrival).rowsBetween(Window.unboundedPreceding, -1)
    newest = F.max(time).over(run)
    rows = snapshots.withColumn("_newest", newest)
    first = F.first(digest).over(Window.partitionBy(*keys, time).orderBy(arrival))
    state = (
        F.when(F.col("_newest").isNull() | (F.col(time) > F.col("_newest")), "applied").when(F.col(time) < F.col("_newest"), "stale")
        .when(F.col(digest) == first, "replay").otherwise("conflict")
    )
    return rows.withColumn("outcome", state).drop("_newest")


def content_digest(rows: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """One digest of each key's rows, whatever their order; a row's own digest first, so that little is gathered."""
    one = rows.select(*keys, F.sha2(F.to_json(F.struct(*columns)), 256).alias("_d"))
    return set_digest(one, keys, "_d")


def turnover_applied(catalog: DataFrame, turnover: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """The catalog with a turnover snapshot (uncovered keys get null; `turnover_changed` tells), and the snapshot's violations:
    keys that are not present in the catalog, or with another currency than the quote asset."""
    new = turnover.select(*keys, F.col("value").alias("_v"), F.col("currency").alias("_c"))
    applied = catalog.join(new, keys, "left").withColumn("turnover_changed", ~F.col("turnover").eqNullSafe(F.col("_v")))
    applied = applied.withColumn("turnover", F.col("_v")).drop("_v", "_c")
    known = catalog.filter("present").select(*keys, "quote_asset")
    checked = new.join(known, keys, "left")
    reason = F.when(F.col("quote_asset").isNull(), "not_present").when(F.col("_c") != F.col("quote_asset"), "currency")
    return applied, checked.withColumn("reason", reason).filter("reason IS NOT NULL").select(*keys, "reason")


def resolved_requests(requests: DataFrame, catalog: DataFrame) -> DataFrame:
    """Each request's instrument: an exact key wins, else the only present and tradable instrument of that pair.

    status: exact, exact_unavailable, pair, none, ambiguous.
    """
    usable = F.col("present") & F.col("tradable")
    by_key = catalog.select(F.col("instrument_key").alias("request"), usable.alias("_usable"))
    by_pair = catalog.filter(usable).groupBy(F.col("canonical_pair").alias("request")).agg(F.count(F.lit(1)).alias("_n"), F.min("instrument_key").alias("_only"))
    rows = requests.join(by_key, "request", "left").join(by_pair, "request", "left")
    status = (
        F.when(F.col("_usable"), "exact").when(F.col("_usable").isNotNull(), "exact_unavailable")
        .when(F.col("_n") == 1, "pair").when(F.col("_n") > 1, "ambiguous").otherwise("none")
    )
    key = F.when(F.col("_usable"), F.col("request")).when(F.col("_usable").isNull() & (F.col("_n") == 1), F.col("_only"))
    return rows.select("request", status.alias("status"), key.alias("instrument_key"))


def confirmed_announcements(hints: DataFrame, catalog: DataFrame) -> DataFrame:
    """Announcements that exactly one instrument matches, by key (and pair, if given) or by pair, observed no earlier than
    announced. Both matches are equi-joins; the time condition is checked on their rows."""
    c = catalog.select("instrument_key", "canonical_pair", "observed_at_ns")
    keyed = hints.filter("hint_key IS NOT NULL").join(c, F.col("hint_key") == F.col("instrument_key")).filter("hint_pair IS NULL OR hint_pair = canonical_pair")
    paired = hints.filter("hint_key IS NULL").join(c, F.col("hint_pair") == F.col("canonical_pair"))
    rows = keyed.unionByName(paired).filter("announced_at_ns <= observed_at_ns")
    return rows.groupBy("hint_id").agg(F.count(F.lit(1)).alias("_n"), F.min("instrument_key").alias("instrument_key")).filter("_n = 1").drop("_n")


def admitted(candidates: DataFrame, scope: list[str], slots: Column) -> DataFrame:
    """Whether each candidate fits its scope's slots: the worst of the top go first, then the latest new listings; fixed
    ones never. `order` is the place among the admitted."""
    worst = F.when(F.col("priority") == 2, -F.col("rank")).when(F.col("priority") == 1, -F.col("first_seen_ns")).otherwise(0)
    eviction = Window.partitionBy(*scope).orderBy((2 - F.col("priority")), worst, "instrument_key")
    rows = candidates.withColumns({"_place": F.row_number().over(eviction), "_all": F.count(F.lit(1)).over(Window.partitionBy(*scope)), "_slots": slots})
    rows = rows.withColumn("admitted", (F.col("priority") == 0) | (F.col("_place") > F.col("_all") - F.col("_slots")))
    best = F.when(F.col("priority") == 2, F.col("rank")).when(F.col("priority") == 1, F.col("first_seen_ns")).otherwise(0)
    order = Window.partitionBy(*scope, "admitted").orderBy("priority", best, "instrument_key")
    return rows.withColumn("order", F.when(F.col("admitted"), F.row_number().over(order))).drop("_place", "_all", "_slots")


def connection_chunks(candidates: DataFrame, exchange: list[str], scope: list[str], per_connection: int, connections: int) -> DataFrame:
    """Connections of each exchange dealt to its scopes' chunks: those with fixed instruments first, then the best head
    chunk each time, which is the order of all chunks by their candidates' keys."""
    best = F.when(F.col("priority") == 2, F.col("rank")).when(F.col("priority") == 1, F.col("first_seen_ns")).otherwise(0).cast("long")
    w = Window.partitionBy(*exchange, *scope).orderBy("priority", best, "instrument_key")
    rows = candidates.withColumn("chunk", F.floor((F.row_number().over(w) - 1) / per_connection).cast("long"))
    chunks = rows.groupBy(*exchange, *scope, "chunk").agg(F.sort_array(F.collect_list(F.struct("priority", best.alias("best"), "instrument_key"))).alias("members"))
    last = F.struct(F.lit(3).cast(dict(candidates.dtypes)["priority"]).alias("priority"), F.lit(2**63 - 1).cast("long").alias("best"), F.lit("").alias("instrument_key"))
    padded = F.concat("members", F.array_repeat(last, F.lit(per_connection) - F.size("members")))
    fixed = F.get("members", F.lit(0))["priority"] == 0
    deal = Window.partitionBy(*exchange).orderBy(F.desc("fixed"), "padded", *scope)
    return chunks.select("*", padded.alias("padded"), fixed.alias("fixed")).withColumn("connection", F.row_number().over(deal)).filter(F.col("connection") <= connections).drop("padded")


def packed(rows: DataFrame, bucket: list[str], key: str, size: int) -> DataFrame:
    """Chunks of fixed size in each bucket, by sorted key."""
    w = Window.partitionBy(*bucket).orderBy(key)
    return rows.withColumn("chunk", F.floor((F.row_number().over(w) - 1) / size).cast("long"))


def rendezvous(keys: DataFrame, key: str, buckets: DataFrame, bucket: str, block: int = 1000) -> DataFrame:
    """Each key's bucket: that with the largest digest of key and bucket; ties by bucket. Fails without buckets.

    Buckets ride along as arrays of at most about `block` names. A key meets each array once and keeps its best of it, and the best
    of those is the largest of a partial aggregate; so however many buckets there are, a key costs a row for each thousand of them,
    and no row is wider than a thousand names.
    """
    named = buckets.select(F.col(bucket).alias("_b")).filter("_b IS NOT NULL").distinct()
    n = named.count()
    if not n:
        raise ValueError("a bucket is needed")
    count = -(-n // block)
    blocks = named.groupBy(F.pmod(F.xxhash64("_b"), F.lit(count)).alias("_block")).agg(F.collect_list("_b").alias("_names"))
    wide = keys.withColumn("_key", F.monotonically_increasing_id()).withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long"))))
    digest = lambda b: F.struct(F.sha2(F.concat(F.col(key), F.lit("\0"), b), 256).alias("d"), b.alias("b"))
    best = wide.join(blocks, "_block").withColumn("_best", F.array_max(F.transform("_names", digest)))
    if count == 1:
        return best.select(*keys.columns, F.col("_best.b").alias(bucket))
    kept = [F.first(c).alias(c) for c in keys.columns]
    return best.groupBy("_key").agg(*kept, F.max("_best")["b"].alias(bucket)).drop("_key")


def capacity(egresses: DataFrame, keys: list[str], per_connection: int, per_instrument: int) -> DataFrame:
    """Connections, subscription and instrument slots, and request concurrency of the reachable egresses."""
    up = egresses.filter("reachable").groupBy(*keys).agg(F.count(F.lit(1)).alias("egresses"), F.sum("connections").alias("ws_connections"), F.sum("http_concurrency").alias("http_concurrency"))
    return up.withColumns({"subscription_slots": F.col("ws_connections") * per_connection, "instrument_slots": F.col("ws_connections") * (per_connection // per_instrument)})


def stretched(demands: DataFrame, group: list[str], rate: str) -> DataFrame:
    """Effective intervals under a group's rate limit (units a second): fixed-cadence demand first, the rest stretched by the
    same factor max(1, required / remaining), rounded up to whole nanoseconds. Null where nothing remains for the rest.

    Demand is jobs * cost / interval. Spark sums jobs * cost by group and interval; the ratio of a group's few distinct
    intervals is then taken in whole-number fractions, so that the ceiling is exact.
    """
    load = (F.col("jobs") * F.col("cost")).cast("decimal(28,9)")
    per = demands.groupBy(*group, "requested_ns").agg(
        F.coalesce(F.sum(F.when(F.col("fixed"), load)), F.lit(0)).cast("string").alias("_fixed"),
        F.coalesce(F.sum(F.when(~F.col("fixed"), load)), F.lit(0)).cast("string").alias("_rest"),
        F.max(F.col(rate).cast("decimal(28,9)")).cast("string").alias("_rate"),
    )

    def stretch(rows: pd.DataFrame) -> pd.DataFrame:
        interval = [Fraction(int(v), SECOND) for v in rows["requested_ns"]]
        demand = {c: sum((Fraction(v) / i for v, i in zip(rows[c], interval, strict=True)), Fraction(0)) for c in ("_fixed", "_rest")}
        left = max(map(Fraction, rows["_rate"])) - demand["_fixed"]
        stretched_ns = [ceil(i * SECOND * max(Fraction(1), demand["_rest"] / left)) if left > 0 else None for i in interval]
        return rows[[*group, "requested_ns"]].assign(_stretched=pd.array(stretched_ns, "Int64"))

    kinds = dict(demands.dtypes)
    found = per.groupBy(*group).applyInPandas(stretch, ", ".join([*[f"`{c}` {kinds[c]}" for c in group], f"requested_ns {kinds['requested_ns']}", "_stretched long"]))
    same = [F.col(f"d.{c}").eqNullSafe(F.col(f"f.{c}")) for c in (*group, "requested_ns")]
    rows = demands.alias("d").join(found.alias("f"), reduce(and_, same)).select("d.*", "f._stretched")
    return rows.withColumn("effective_ns", F.when(F.col("fixed"), F.col("requested_ns")).otherwise(F.col("_stretched"))).drop("_stretched")


def broken_page_chains(pages: DataFrame, keys: list[str], page: str, cursor: str, following: str) -> DataFrame:
    """Pages whose cursor is not the one that the page before named; the first has none, and the last names none."""
    w = Window.partitionBy(*keys).orderBy(page)
    rows = pages.withColumns({"_named": F.lag(following).over(w), "_later": F.lead(page).over(w)})
    good = F.col(cursor).eqNullSafe(F.col("_named")) & (F.col("_later").isNotNull() == F.col(following).isNotNull())
    return rows.filter(~good).drop("_named", "_later")


def lifecycle_step(prior: Column, status: Column, tradable: Column, official_past: Column, first_snapshot: Column) -> Column:
    """The state after a snapshot row, from the state before (null: unknown)."""
    pre = F.when(official_past, "pending_official").otherwise("pending")
    fresh = (
        F.when(status == "delisted", "relist_pending").when(status == "preopen", pre)
        .when(tradable & (~first_snapshot | official_past), "active_new").otherwise("baseline")
    )
    return (
        F.when(prior.isNull(), fresh).when(status == "delisted", "relist_pending")
        .when(prior.isin("relist_pending", "pending", "pending_official") & tradable, "active_new").otherwise(prior)
    )
