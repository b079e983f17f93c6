"""Service-level monitoring: rolling histograms, transitions, counters, samples, states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.histograms import BOUNDS_NS, as_array, bucket_counts, nearest_rank
from ..functions.scalar import floor_to
from .ordered import carried

WINDOW_SECONDS = 60
OTHER = "_other"
MAX_LABELS = 64


def rolling_histogram(samples: DataFrame, keys: list[str], second: str, lag_ns: str, seconds: int = WINDOW_SECONDS) -> DataFrame:
    """For each second with samples: the histogram of the last `seconds` whole seconds, with p50, p95 and p99.

    Samples are first counted by second, so that the range frame runs over seconds, not samples.
    """
    by_second = samples.groupBy(*keys, second).agg(F.count(F.lit(1)).alias("n"), F.max(lag_ns).alias("top"), *bucket_counts(lag_ns))
    frame = Window.partitionBy(*keys).orderBy(second).rangeBetween(-(seconds - 1), 0)
    sums = {f"b{i}": F.sum(f"b{i}").over(frame) for i in range(len(BOUNDS_NS))}
    rolled = by_second.select(*keys, second, F.sum("n").over(frame).alias("samples"), F.max("top").over(frame).alias("lag_max_ns"), *[c.alias(n) for n, c in sums.items()])
    counts = as_array()
    return rolled.select(*keys, second, "samples", "lag_max_ns", *[nearest_rank(counts, p).alias(f"p{p}_ns") for p in (50, 95, 99)])


def transitions(rows: DataFrame, keys: list[str], order: list[str], state: Column, initial=None) -> DataFrame:
    """The rows at which a state differs from the one before; the first row counts against `initial`."""
    w = Window.partitionBy(*keys).orderBy(*order)
    marked = rows.withColumn("state", state).withColumn("previous", F.lag("state", 1).over(w))
    before = F.coalesce("previous", F.lit(initial)) if initial is not None else F.col("previous")
    return marked.withColumn("previous", before).filter(~F.col("state").eqNullSafe(F.col("previous")))


def slo_transitions(rolled: DataFrame, keys: list[str], second: str, slo_ns: int) -> DataFrame:
    """Changes between met and breached: breached if the rolling maximum or p99 exceeds the objective."""
    return transitions(rolled, keys, [second], (F.col("lag_max_ns") > slo_ns) | (F.col("p99_ns") > slo_ns), initial=False)


def interval_changes(rows: DataFrame, keys: list[str], order: list[str], effective: str) -> DataFrame:
    """Changes of an effective interval, as stretch or recover; unchanged ones are left out."""
    w = Window.partitionBy(*keys).orderBy(*order)
    marked = rows.withColumn("previous_effective", F.lag(effective).over(w))
    return marked.filter(F.col("previous_effective") != F.col(effective)).withColumn(
        "direction", F.when(F.col(effective) > F.col("previous_effective"), "stretch").otherwise("recover")
    )


def largest_gap(rows: DataFrame, keys: list[str], time: str) -> DataFrame:
    """The longest time between neighbouring samples; 0 for a single one."""
    w = Window.partitionBy(*keys).orderBy(time)
    return rows.withColumn("gap", F.col(time) - F.lag(time).over(w)).groupBy(*keys).agg(F.coalesce(F.max("gap"), F.lit(0)).alias("max_gap"), F.count(F.lit(1)).alias("samples"))


def counter_violations(rows: DataFrame, keys: list[str], order: list[str], counters: list[str]) -> DataFrame:
    """Rows where a cumulative counter, or an element of an array of them, is smaller than before."""
    w = Window.partitionBy(*keys).orderBy(*order)
    types = dict(rows.dtypes)

    def fell(c: str) -> Column:
        before = F.lag(c).over(w)
        if types[c].startswith("array"):
            return F.exists(F.arrays_zip(F.col(c).alias("now"), before.alias("was")), lambda x: x["now"] < x["was"])
        return F.col(c) < before

    flags = rows.select("*", *[F.coalesce(fell(c), F.lit(False)).alias(f"_{c}") for c in counters])
    broken = F.array_compact(F.array(*[F.when(F.col(f"_{c}"), F.lit(c)) for c in counters]))
    return flags.withColumn("broken", broken).filter(F.size("broken") > 0).drop(*[f"_{c}" for c in counters])


def counter_deltas(rows: DataFrame, keys: list[str], order: list[str], counter: str) -> DataFrame:
    """Growth since the row before; a counter that fell has restarted from zero, and the first row counts whole."""
    w = Window.partitionBy(*keys).orderBy(*order)
    before = F.lag(counter).over(w)
    delta = F.when(before.isNull() | (F.col(counter) < before), F.col(counter)).otherwise(F.col(counter) - before)
    return rows.withColumns({"delta": delta, "restarted": F.coalesce(F.col(counter) < before, F.lit(False))})


def round_peaks(samples: DataFrame, keys: list[str], round_col: str, values: list[str]) -> DataFrame:
    """Values summed over workers in each round, then their maximum over rounds."""
    rounds = samples.groupBy(*keys, round_col).agg(*[F.sum(v).alias(v) for v in values])
    return rounds.groupBy(*keys).agg(F.count(F.lit(1)).alias("rounds"), *[F.max(v).alias(f"peak_{v}") for v in values])


def resource_summary(samples: DataFrame, keys: list[str], round_col: str, time: str, value: str, warm_up: int) -> DataFrame:
    """Peak, growth after warm-up, and least-squares slope a minute (never below zero) of a value summed by round.

    `time` is in seconds. Sums and their differences are exact decimals: the slope does not depend on the partitioning, and
    large values do not cancel out.
    """
    number = lambda c: F.col(c).cast("decimal(19,0)")
    rounds = samples.groupBy(*keys, round_col).agg(F.min(time).alias("t"), F.sum(value).alias("v"))
    first = Window.partitionBy(*keys)
    after = rounds.withColumn("x", F.col("t") - F.min("t").over(first)).withColumn("late", F.col("x") >= warm_up)
    base = F.min(F.when(F.col("late"), F.struct("x", "v")))
    late = lambda c: F.sum(F.when(F.col("late"), c))
    sums = after.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rounds"),
        F.max("v").alias("peak"),
        (F.max(F.struct("x", "v"))["v"] - base["v"]).alias("growth"),
        F.count(F.when(F.col("late"), 1)).alias("n"),
        late(number("x")).alias("sx"),
        late(number("v")).alias("sy"),
        late((number("x") * number("v")).cast("decimal(38,0)")).alias("sxy"),
        late((number("x") * number("x")).cast("decimal(38,0)")).alias("sxx"),
    )
    d = lambda c: F.col(c).cast("decimal(38,0)")
    top, bottom = d("n") * d("sxy") - d("sx") * d("sy"), d("n") * d("sxx") - d("sx") * d("sx")
    slope = F.when(bottom > 0, F.greatest(F.lit(0.0), top.cast("double") * 60 / bottom.cast("double")))
    return sums.select(*keys, "rounds", "peak", "growth", slope.alias("slope_per_minute"))


def health_summary(samples: DataFrame, keys: list[str], scheduled: str, started: str, completed: str, duration: int, interval: int, critical: Column) -> DataFrame:
    """Whether sampling covered a run: expected and actual counts, required and actual coverage, largest gap."""
    w = Window.partitionBy(*keys).orderBy(scheduled)
    expected = max(2, -(-duration // interval) - 1)
    required = max(0, duration - 2 * interval)
    rows = samples.withColumns({"_gap": F.col(scheduled) - F.lag(scheduled).over(w), "_critical": critical.cast("int")})
    found = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("sample_count"), (F.max(completed) - F.min(started)).alias("coverage"),
        F.coalesce(F.max("_gap"), F.lit(0)).alias("max_gap"), F.sum("_critical").alias("critical_count"),
    )
    return found.withColumns(
        {
            "expected_count": F.lit(expected), "required_coverage": F.lit(required), "count_valid": F.col("sample_count") >= expected,
            "coverage_valid": F.col("coverage") >= required, "healthy": F.col("critical_count") == 0,
        }
    )


def conservation_breaks(snapshots: DataFrame, whole: dict[str, list[str]], arrays: dict[str, str]) -> DataFrame:
    """Snapshots whose totals differ from the sum of their parts, or from the sum of an array of series."""
    checks = [F.when(F.col(total) != sum((F.col(p) for p in parts), F.lit(0)), F.lit(total)) for total, parts in whole.items()]
    zero = F.lit(0).cast("long")
    checks += [F.when(F.col(total) != F.aggregate(series, zero, lambda s, x: s + x), F.lit(f"{total}:{series}")) for total, series in arrays.items()]
    return snapshots.withColumn("breaks", F.array_compact(F.array(*checks))).filter(F.size("breaks") > 0)


def bounded_labels(rows: DataFrame, label: str, allowed: list[str]) -> DataFrame:
    """Labels outside an allow list of at most MAX_LABELS fold into one, so that the number of series stays bounded."""
    if len(set(allowed)) > MAX_LABELS:
        raise ValueError(f"more than {MAX_LABELS} labels")
    return rows.withColumn(label, F.when(F.col(label).isin(*allowed), F.col(label)).otherwise(OTHER))


def failure_runs(log: DataFrame, keys: list[str], order: list[str], failed: Column, until: str) -> DataFrame:
    """After each entry: how many failures in a row it ends, and the latest cooldown deadline so far."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = log.withColumn("_failed", failed).withColumn("_run", F.sum((~F.col("_failed")).cast("int")).over(w))
    run = Window.partitionBy(*keys, "_run").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumns(
        {"consecutive_failures": F.sum(F.col("_failed").cast("int")).over(run), "cooldown_until": F.max(F.when(F.col("_failed"), F.col(until))).over(w)}
    ).drop("_failed", "_run")


def invalid_transitions(log: DataFrame, keys: list[str], order: list[str], state: str, allowed: list[tuple[str | None, str]]) -> DataFrame:
    """Entries whose state may not follow the one before; None stands for the first entry."""
    w = Window.partitionBy(*keys).orderBy(*order)
    marked = log.withColumn("previous", F.lag(state).over(w))
    legal = F.lit(False)
    for before, now in allowed:
        legal = legal | (F.col("previous").eqNullSafe(F.lit(before)) & (F.col(state) == now))
    return marked.filter(~legal)


def oldest_open_age(records: DataFrame, samples: DataFrame, keys: list[str], accepted: str, done: str, at: str, threshold: int, bucket: int) -> DataFrame:
    """For each sample time: the age of the oldest record accepted by then and not done, and whether it is over the threshold.
    Records without an end are open for good.

    In the order of acceptance, the oldest open record at a time is the first whose end lies behind it; so only those count that are
    open longer than all before them, and each of them from the end of the longest one before. These and the samples are one
    sequence, in which a sample takes the last such record before it. Both the longest end and the last record are carried over
    stretches of `bucket` time units, so that rows stay as many as records and samples, and no task gets a key's whole history.
    """
    end = F.coalesce(F.col(done), F.lit((1 << 63) - 1))
    rows = records.select(*keys, F.col(accepted).alias("_a"), end.alias("_d")).filter("_a < _d")
    rows = carried(rows, keys, [floor_to("_a", bucket)], "_before", F.max("_d"), F.max)
    earlier = Window.partitionBy(*keys, "_s0").orderBy("_a").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_longest", F.greatest(F.max("_d").over(earlier), F.col("_before")))
    steps = rows.filter("_longest IS NULL OR _d > _longest").select(*keys, F.greatest("_longest", "_a").alias("_at"), F.lit(0).alias("_kind"), F.struct("_d", "_a").alias("_open"))
    hits = samples.select(*keys, F.col(at).alias("_at"), F.lit(1).alias("_kind"), F.lit(None).cast("struct<_d:bigint,_a:bigint>").alias("_open"))
    both = steps.withColumn("_open", F.struct(F.col("_open._d").cast("long").alias("_d"), F.col("_open._a").cast("long").alias("_a"))).unionByName(hits)
    # Of two steps at one time the one with the later end came last.
    newest = F.max_by("_open", F.when(F.col("_open").isNotNull(), F.struct("_at", "_open")))
    both = carried(both, keys, [floor_to("_at", bucket)], "_before", newest, lambda c: F.last(c, ignorenulls=True))
    so_far = Window.partitionBy(*keys, "_s0").orderBy("_at", "_kind", "_open").rowsBetween(Window.unboundedPreceding, 0)
    last = F.coalesce(F.last("_open", ignorenulls=True).over(so_far), F.col("_before"))
    told = both.withColumn("_last", last).filter("_kind = 1")
    oldest = F.when((F.col("_last._d") > F.col("_at")) & (F.col("_last._a") <= F.col("_at")), F.col("_last._a"))
    age = F.col("_at") - oldest
    return told.select(*keys, F.col("_at").alias(at), age.alias("age"), F.coalesce(age > threshold, F.lit(False)).alias("critical"))
