"""Raw event parts: discovery, scans of compressed JSON lines, salvage, sinks, manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.histograms import as_array, bucket_counts
from ..functions.scalar import encode_key, packed_digest, storage_hour, unpacked_digest
from ..operators.reconcile import reconciled
from ..schemas import ENVELOPE, PART_KEYS
from . import parts

#: Rows of the table of capabilities up to which it is broadcast.
MAX_BROADCAST_CAPABILITIES = 10_000


def inventory(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """path, size and sha256 of each file under root; unfinished files (.partial) are left out."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    return files.filter(~F.col("path").endswith(".partial")).select("path", F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"))


def inventory_differences(declared: DataFrame, observed: DataFrame) -> DataFrame:
    """Files that are missing, unexpected or changed against a declared inventory."""
    a = declared.select("path", F.struct("size", "sha256").alias("_declared"))
    b = observed.select("path", F.struct("size", "sha256").alias("_observed"))
    both = a.join(b, "path", "full_outer").filter(~F.col("_declared").eqNullSafe(F.col("_observed")))
    return both.select("path", F.when(F.col("_observed").isNull(), "missing").when(F.col("_declared").isNull(), "unexpected").otherwise("changed").alias("difference"))


def discovered_parts(manifests: DataFrame, files: DataFrame, tombstones: DataFrame, versions: tuple[int, ...] = (1,)) -> DataFrame:
    """Manifests of closed parts: supported, with their data in place at the declared size and digest, and no tombstone; in
    manifest order (`place`), not path order."""
    there = files.select(F.col("path").alias("data_path"), F.col("size").alias("_size"), packed_digest("sha256").alias("_sha"))
    fit = manifests.filter(F.col("schema_version").isin(*versions)).withColumns({"manifest_sha256": packed_digest("manifest_sha256"), "_own": packed_digest("data_sha256")})
    fit = fit.join(there, "data_path").filter((F.col("data_size") == F.col("_size")) & (F.col("_own") == F.col("_sha"))).drop("_size", "_sha", "_own")
    alive = fit.join(tombstones.select(packed_digest("manifest_sha256").alias("manifest_sha256")), "manifest_sha256", "left_anti")
    alive = alive.withColumn("manifest_sha256", unpacked_digest("manifest_sha256"))
    return alive.withColumn("place", F.row_number().over(Window.partitionBy("exchange").orderBy("manifest_sha256")))


def scan_parts(spark: SparkSession, root: str, suffix: str = ".jsonl.zst", split_bytes: int = parts.SPLIT_BYTES) -> DataFrame:
    """Raw envelopes of all parts under root, with path and record_index (from 0, in file order).

    A part is read by several tasks, each a range of its frames (see parts.scan_frames()). Parsing is the JVM's, by the explicit
    schema. Fails on a frame that cannot be read: parts are closed, and salvage() is for those that are not.
    """
    frames = parts.scan_frames(spark, root, suffix, split_bytes)
    whole = frames.filter(F.col("ok") | F.raise_error(F.concat(F.lit("a frame cannot be read: "), F.col("path"))).cast("boolean"))
    lines = parts.numbered(whole)
    text_payload = F.get_json_object("line", "$.payload")
    parsed = lines.select("path", "record_index", "line", F.from_json("line", ENVELOPE).alias("_e"))
    return parsed.select("path", "record_index", *[F.col(f"_e.{f}").alias(f) for f in ENVELOPE.names if f != "payload"], text_payload.alias("payload"))


def salvage(spark: SparkSession, root: str, suffix: str = ".partial") -> tuple[DataFrame, DataFrame]:
    """Rows of unfinished parts up to their first bad frame, and for each file how many bytes are valid and how many go to
    quarantine."""
    return parts.salvaged(spark, root, suffix)


def write_hours(events: DataFrame, root: str, rows_per_file: int = 5_000_000) -> None:
    """Raw events as Parquet by exchange, market, instrument, stream and hour of receipt."""
    scope = lambda c, none: F.coalesce(encode_key(c), F.lit(none))
    rows = events.withColumns(
        {"p_exchange": F.col("exchange"), "p_market": F.coalesce("market", F.lit("_market")), "p_key": scope("instrument_key", "_control"), "p_stream": F.col("logical_stream"), "p_hour": F.replace(storage_hour("received_at_ns"), F.lit("/"), F.lit("-"))}
    )
    folders = ["p_exchange", "p_market", "p_key", "p_stream", "p_hour"]
    rows.write.partitionBy(*folders).option("compression", "zstd").option("maxRecordsPerFile", rows_per_file).mode("append").parquet(root)


def part_facts(events: DataFrame, keys: list[str] = PART_KEYS, lag_ns: str | None = None) -> DataFrame:
    """Summary facts of each part: counts, first and last times, sequence range, distinct sets, control counters, hours."""
    sets = [F.array_join(F.sort_array(F.collect_set(c)), ",").alias(f"{c}s") for c in ("connection_id", "egress_id") if c in events.columns]
    lags = bucket_counts(lag_ns) if lag_ns else []
    facts = events.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("records"), F.min("received_at_ns").alias("first_received_ns"), F.max("received_at_ns").alias("last_received_ns"), F.min("writer_sequence").alias("first_sequence"),
        F.max("writer_sequence").alias("last_sequence"), F.count_distinct(storage_hour("received_at_ns")).alias("hours"), *sets, *lags,
    )
    return facts.select(*[c for c in facts.columns if not (lag_ns and c[0] == "b" and c[1:].isdigit())], *([as_array().alias("buckets")] if lag_ns else []))


def verified(declared: DataFrame, actual: DataFrame, keys: list[str], facts: list[str]) -> DataFrame:
    """Declared against recomputed facts of each part: which differ, and whether the part holds more than one hour."""
    return reconciled(declared, actual, keys, facts)


def sequence_breaks(events: DataFrame, keys: list[str] = PART_KEYS, order: str = "record_index") -> DataFrame:
    """Records whose sequence does not grow strictly inside their part."""
    w = Window.partitionBy(*keys).orderBy(order)
    return events.withColumn("previous_sequence", F.lag("writer_sequence").over(w)).filter(F.col("previous_sequence") >= F.col("writer_sequence"))


def dispositions(manifests: DataFrame, files: DataFrame, intents: DataFrame, tombstones: DataFrame) -> DataFrame:
    """What became of each manifest's data: present, changed, cleanup_pending, tombstoned (its proof binds the exact digests)
    or missing without explanation."""
    there = files.select(F.col("path").alias("data_path"), packed_digest("sha256").alias("_sha"))
    wish = intents.select(packed_digest("manifest_sha256").alias("_id"), F.lit(True).alias("_intent"))
    gone = tombstones.select(packed_digest("manifest_sha256").alias("_id"), packed_digest("data_sha256").alias("_proof"))
    own = manifests.withColumns({"_id": packed_digest("manifest_sha256"), "_own": packed_digest("data_sha256")})
    # Whether the file is the declared one is told before the next shuffle, which need not carry its digest.
    seen = own.join(there, "data_path", "left").withColumn("_same", F.when(F.col("_sha").isNotNull(), F.coalesce(F.col("_sha") == F.col("_own"), F.lit(False)))).drop("_sha")
    rows = seen.join(wish, "_id", "left").join(gone, "_id", "left")
    state = (
        F.when(F.col("_proof") == F.col("_own"), "tombstoned").when(F.col("_proof").isNotNull(), "proof_mismatch")
        .when(F.col("_same"), F.when(F.col("_intent"), "cleanup_pending").otherwise("present"))
        .when(F.col("_same").isNotNull(), "changed").otherwise("missing_unexplained")
    )
    return rows.withColumn("disposition", state).drop("_id", "_own", "_same", "_intent", "_proof")


def with_capability(rows: DataFrame, capabilities: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with their market's capabilities. The dimension has a row for each exchange and market, a few dozen; more than
    MAX_BROADCAST_CAPABILITIES are joined by a shuffle."""
    small = capabilities.limit(MAX_BROADCAST_CAPABILITIES + 1).count() <= MAX_BROADCAST_CAPABILITIES
    return rows.join(F.broadcast(capabilities) if small else capabilities, keys, "left")


