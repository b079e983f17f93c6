"""Revisions of derived hours, acknowledgements, receipts and retention."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalar import HOUR, floor_to
from .ordered import carried


def publish_revision(frame: DataFrame, root: str, revisions: DataFrame | None, key: dict[str, str], revision: int, lineage: list[str], row_digest: str) -> DataFrame:
    """Writes an immutable rev=N of a dataset partition, and only then gives its manifest row, with what it supersedes.

    A revision without a manifest row is invisible to readers; a crash before the row leaves nothing visible.
    """
    path = "/".join([root, *[f"{k}={v}" for k, v in key.items()], f"rev={revision}"])
    frame.write.mode("error").option("compression", "zstd").parquet(path)
    back = frame.sparkSession.read.parquet(path)
    facts = back.agg(F.count(F.lit(1)).alias("records"), F.sha2(F.coalesce(F.sum(F.conv(F.substring(row_digest, 1, 12), 16, 10).cast("decimal(38,0)")), F.lit(0)).cast("string"), 256).alias("content"))
    row = facts.select(*[F.lit(v).alias(k) for k, v in key.items()], F.lit(revision).alias("rev"), F.lit(path).alias("path"), "records", "content", F.lit(",".join(sorted(lineage))).alias("lineage"))
    if revisions is None:
        return row.withColumn("supersedes", F.lit(None).cast("int"))
    older = revisions.filter(reduce(lambda a, b: a & b, [F.col(k) == v for k, v in key.items()])).agg(F.max("rev").alias("supersedes"))
    return row.crossJoin(F.broadcast(older))  # two single rows


def latest_revisions(revisions: DataFrame, keys: list[str]) -> DataFrame:
    """The highest committed revision of each partition key."""
    newest = revisions.filter("committed").groupBy(*keys).agg(F.max("rev").alias("rev"))
    return revisions.join(newest, [*keys, "rev"], "left_semi")


def read_latest(spark: SparkSession, revisions: DataFrame, keys: list[str], root: str) -> DataFrame:
    """The data of the latest revisions under root, with the partition columns. Revisions join the folders' own columns, so
    that Spark prunes folders where it can and no list of paths passes through the driver."""
    newest = latest_revisions(revisions, keys).select(*keys, "rev")
    return spark.read.parquet(root).join(newest, [*keys, "rev"], "left_semi")


def affected_hours(late: DataFrame, snapshots: DataFrame, keys: list[str], time: str, horizon_ns: int, max_age_ns: int) -> DataFrame:
    """Hours whose revisions late inputs touch: from the input's own to that of the next authoritative snapshot, or of the
    horizon if there is none; inputs older than the bound are left to explicit reprocessing (`too_late`).

    The next snapshot comes from one ordered stream of both, not from a range join: of the same hour, else the first of
    the hours after.
    """
    both = late.select(*keys, F.col(time).alias("_t"), F.lit(False).alias("_s"), "received_at_ns").unionByName(
        snapshots.select(*keys, F.col(time).alias("_t"), F.lit(True).alias("_s"), F.lit(None).cast("long").alias("received_at_ns"))
    )
    snapshot = F.min(F.when(F.col("_s"), F.col("_t")))
    both = carried(both, keys, [floor_to("_t", HOUR)], "_after", snapshot, F.min, ahead=True)
    ahead = Window.partitionBy(*keys, "_s0").orderBy("_t").rangeBetween(1, Window.unboundedFollowing)
    rows = both.withColumn("_next", F.coalesce(snapshot.over(ahead), "_after")).filter(~F.col("_s"))
    last = F.least(F.coalesce(F.col("_next"), F.col("_t") + horizon_ns), F.col("_t") + horizon_ns)
    hours = F.explode(F.sequence(floor_to("_t", HOUR), floor_to(last - 1, HOUR), F.lit(HOUR))).alias("hour_ns")
    late_ = (F.col("received_at_ns") - F.col("_t") > max_age_ns).alias("too_late")
    return rows.select(*keys, hours, late_).groupBy(*keys, "hour_ns").agg(F.count(F.lit(1)).alias("inputs"), F.min("too_late").alias("too_late"))


def eligibility(sources: DataFrame, receipts: DataFrame, acks: DataFrame, required: list[str], now_ns: int, grace_ns: int, fence_ns: int) -> DataFrame:
    """Whether a source may be cleaned up, and what blocks it: missing or weak receipts, no acknowledgement, its grace, or
    the fence behind which revisions may still come."""
    strong = receipts.filter("strong").groupBy("manifest_sha256").agg(F.array_sort(F.collect_set("target")).alias("_targets"))
    rows = sources.join(strong, "manifest_sha256", "left").join(acks.select("manifest_sha256", F.lit(True).alias("_ack")).distinct(), "manifest_sha256", "left")
    lacks = F.size(F.array_except(F.array(*map(F.lit, required)), F.coalesce("_targets", F.array().cast("array<string>")))) > 0
    blocks = {
        "receipts": lacks,
        "acknowledgement": F.col("_ack").isNull(),
        "grace": F.lit(now_ns) - F.col("closed_at_ns") < grace_ns,
        "revision_fence": F.col("last_event_ns") >= fence_ns,
    }
    blocked = F.array_compact(F.array(*[F.when(b, F.lit(n)) for n, b in blocks.items()]))
    return rows.withColumn("blocked_by", blocked).withColumn("eligible", F.size("blocked_by") == 0).drop("_targets", "_ack")


def acknowledged(inputs: DataFrame, commits: DataFrame, enabled: list[str], key: str) -> DataFrame:
    """Inputs for which every enabled dataset has committed."""
    done = commits.filter(F.col("dataset").isin(*enabled)).groupBy(key).agg(F.count_distinct("dataset").alias("_n")).filter(F.col("_n") == len(set(enabled)))
    return inputs.join(done, key, "left_semi")


def receipt_mismatches(manifests: DataFrame, receipts: DataFrame, key: str, facts: dict[str, str]) -> DataFrame:
    """Receipts whose stored facts differ from their manifest's, with the facts' names."""
    both = receipts.join(manifests, key)
    wrong = F.array_compact(F.array(*[F.when(~F.col(stored).eqNullSafe(F.col(declared)), F.lit(stored)) for stored, declared in facts.items()]))
    return both.withColumn("mismatches", wrong).filter(F.size("mismatches") > 0)


def abandoned_jobs(jobs: DataFrame, tombstones: DataFrame, key: str) -> DataFrame:
    """Jobs with the state they take when their source is gone: pending optional ones are abandoned."""
    gone = tombstones.select(key, F.lit(True).alias("_gone")).distinct()
    drop = (F.col("state") == "pending") & F.col("optional") & F.coalesce("_gone", F.lit(False))
    return jobs.join(gone, key, "left").withColumn("next_state", F.when(drop, "abandoned").otherwise(F.col("state"))).drop("_gone")


def materialization_identity(inputs: DataFrame, keys: list[str], sha: str, config: str, code: str, schemas: dict[str, int]) -> DataFrame:
    """Identity of a materialization: its set of inputs, configuration, code and schema versions, whatever the order."""
    fixed = [config, code, *[f"{n}={v}" for n, v in sorted(schemas.items())]]
    return inputs.groupBy(*keys).agg(F.sha2(F.concat_ws("|", F.concat_ws(",", F.sort_array(F.collect_set(sha))), *map(F.lit, fixed)), 256).alias("identity"))


def lineage(rows: DataFrame, keys: list[str], sha: str) -> DataFrame:
    """All inputs that contributed to each output partition, also those of earlier hours."""
    return rows.groupBy(*keys).agg(F.sort_array(F.collect_set(sha)).alias("inputs"))


def committed_if_current(state: DataFrame, proposals: DataFrame, keys: list[str]) -> DataFrame:
    """Proposed states with `accepted`: only those made from the revisions that are current (null: none yet), and of several for
    one key only that of the smallest proposal number. An accepted one raises the revision."""
    rows = proposals.join(state.select(*keys, F.col("revision").alias("_now")), keys, "left")
    fresh = F.col("expected_revision").eqNullSafe(F.col("_now"))
    w = Window.partitionBy(*keys, fresh).orderBy("proposal")
    rows = rows.withColumn("accepted", fresh & (F.row_number().over(w) == 1))
    return rows.withColumn("revision", F.when(F.col("accepted"), F.coalesce("_now", F.lit(0)) + 1).otherwise(F.col("_now"))).drop("_now")
