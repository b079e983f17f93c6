"""Fixed-bucket latency histograms: counts by bucket, exact merges, nearest-rank quantiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Inclusive upper bounds in nanoseconds.
BOUNDS_NS = [
    0, 100_000, 250_000, 500_000, 1_000_000, 2_500_000, 5_000_000, 10_000_000, 25_000_000, 50_000_000, 100_000_000,
    250_000_000, 500_000_000, 750_000_000, 1_000_000_000, 1_500_000_000, 2_000_000_000, 3_000_000_000, 5_000_000_000,
    10_000_000_000, 60_000_000_000, 2**63 - 1,
]


def bucket_of(lag_ns: Column | str) -> Column:
    """Number (from 0) of the first bucket whose bound is not below the lag; one case per bound, in codegen."""
    lag = F.col(lag_ns) if isinstance(lag_ns, str) else lag_ns
    found = F.when(lag <= BOUNDS_NS[0], 0)
    for i, bound in enumerate(BOUNDS_NS[1:], 1):
        found = found.when(lag <= bound, i)
    return found


def bucket_counts(lag_ns: Column | str) -> list[Column]:
    """One count for each bucket; sums of flags, so that partial aggregates stay small."""
    bucket = bucket_of(lag_ns)
    return [F.count(F.when(bucket == i, True)).alias(f"b{i}") for i in range(len(BOUNDS_NS))]


def as_array() -> Column:
    return F.array(*[F.col(f"b{i}") for i in range(len(BOUNDS_NS))])


def nearest_rank(counts: Column, percent: int) -> Column:
    """Upper bound of the bucket that holds the sample of rank max(1, ceil(percent * n / 100)); null without samples."""
    zero = F.lit(0).cast("long")
    total = F.aggregate(counts, zero, lambda s, x: s + x)
    rank = F.greatest(F.lit(1).cast("long"), F.ceil(total * percent / F.lit(100)).cast("long"))
    start = F.struct(zero.alias("sum"), F.lit(0).alias("at"))
    reached = F.aggregate(
        counts,
        start,
        lambda s, x: F.struct((s["sum"] + x).alias("sum"), (s["at"] + (s["sum"] + x < rank).cast("int")).alias("at")),
    )
    bounds = F.array(*[F.lit(b).cast("long") for b in BOUNDS_NS])
    return F.when(total > 0, F.get(bounds, reached["at"]))


def histogram(rows: DataFrame, keys: list[str], lag_ns: str) -> DataFrame:
    """keys, samples, lag_total_ns, lag_max_ns, buckets of each group."""
    return (
        rows.groupBy(*keys)
        .agg(
            F.count(lag_ns).alias("samples"),
            F.sum(F.col(lag_ns).cast("decimal(38,0)")).alias("lag_total_ns"),
            F.max(lag_ns).alias("lag_max_ns"),
            *bucket_counts(lag_ns),
        )
        .select(*keys, "samples", "lag_total_ns", "lag_max_ns", as_array().alias("buckets"))
    )


def merged(histograms: DataFrame, keys: list[str]) -> DataFrame:
    """Histograms of the same keys added up, bucket by bucket."""
    flat = histograms.select(*keys, "samples", "lag_total_ns", "lag_max_ns", *[F.get("buckets", F.lit(i)).alias(f"b{i}") for i in range(len(BOUNDS_NS))])
    sums = [F.sum(f"b{i}").alias(f"b{i}") for i in range(len(BOUNDS_NS))]
    totals = [F.sum("samples").alias("samples"), F.sum("lag_total_ns").alias("lag_total_ns"), F.max("lag_max_ns").alias("lag_max_ns")]
    return flat.groupBy(*keys).agg(*totals, *sums).select(*keys, "samples", "lag_total_ns", "lag_max_ns", as_array().alias("buckets"))
