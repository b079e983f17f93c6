"""Exact deduplication by content sort."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .textops import lower_az, partitions, text_of

#: Characters of text in a range key. Longer common prefixes are told apart by the key's second part, a hash.
PREFIX = 64
#: Rows of the sample that finds texts too frequent for one partition, for each partition.
SAMPLE_PER_PARTITION = 200


def _hot_texts(docs: DataFrame, text_col: str, n: int) -> dict[int, int]:
    """Hash -> number of salts, for normalised texts with at least about half of a mean partition.

    Reads a sample of at most about SAMPLE_PER_PARTITION rows a partition; a text needs 1/(2n) of the
    sample to be returned, so that there are at most 2n of them.
    """
    want, rows = SAMPLE_PER_PARTITION * n, docs.count()
    least = max(8.0, min(want, rows) / (2 * n))
    sample = docs.select(F.col(text_col).alias("_text")).sample(fraction=min(1.0, want / max(rows, 1)), seed=17)
    found = sample.groupBy(F.xxhash64(lower_az(text_of("_text"))).alias("_h")).agg(F.count("*").alias("n")).filter(F.col("n") >= least)
    return {r["_h"]: max(2, round(r["n"] / least) * 2) for r in found.collect()}


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "min",
    carry: bool = False,
) -> DataFrame:
    """One row per input row: <id_col>, keep_id, group_size, kept, text_sha256 (and _row, if carry).

    Texts are equal if identical after lower-casing A-Z; null counts as empty. Of equal texts the row
    with the smallest (keep="min") or largest ("max") identifier stays.

    The normalised texts are range-partitioned by sampled splitters on (prefix, hash), sorted inside
    each partition by Spark's external sort, and full neighbours are compared in that order. That is the only
    shuffle of the texts. A text
    that the sample shows to be frequent gets a salt in the range key, so that its rows fill several
    partitions; its few runs are then merged by digest.

    Defined cases: empty table - empty result; null identifiers rank behind all others (keep_id is
    null only if a group has no identifier); rows that repeat an identifier and a text are equal rows of
    which one stays; other columns are ignored, whatever their names, and come back in the struct `_row`
    if carry is set.
    """
    if keep not in ("min", "max"):
        raise ValueError("keep is min or max")
    spark = docs.sparkSession
    n = partitions(spark)
    base = docs.select(
        F.col(id_col).alias("_id"),
        lower_az(text_of(text_col)).alias("_norm"),
        *([F.struct("*").alias("_row")] if carry else []),
    ).withColumns({"_prefix": F.substring("_norm", 1, PREFIX), "_h": F.xxhash64("_norm")})
    hot = _hot_texts(docs, text_col, n)
    if hot:
        salts = spark.createDataFrame(list(hot.items()), "_h long, _salts int")
        base = base.join(F.broadcast(salts), "_h", "left")  # at most 2n rows
        base = base.withColumn(
            "_salt",
            F.when(F.col("_salts").isNotNull(), F.pmod(F.xxhash64("_id"), F.col("_salts"))).otherwise(0),
        )
    # The range partitions serve the windows, so that the texts are shuffled once: both have the same keys.
    keys = ["_prefix", "_h", *(["_salt"] if hot else [])]
    sorted_ = base.repartitionByRange(n, *keys)
    run = Window.partitionBy(*keys, "_norm")
    order = F.col("_id").asc_nulls_last() if keep == "min" else F.col("_id").desc_nulls_last()
    best = F.min if keep == "min" else F.max
    runs = sorted_.select(
        "_id",
        F.row_number().over(run.orderBy(order)).alias("_rank"),
        best("_id").over(run).alias("_keep"),
        F.count(F.lit(1)).over(run).alias("_size"),
        F.sha2("_norm", 256).alias("text_sha256"),
        *(["_row"] if carry else []),
    )
    if hot:
        merged = (
            base.filter(F.col("_salts").isNotNull())
            .groupBy(F.sha2("_norm", 256).alias("_sha"))
            .agg(best("_id").alias("_hot_keep"), F.count(F.lit(1)).alias("_hot_size"))
        )
        runs = runs.join(F.broadcast(merged), F.col("text_sha256") == F.col("_sha"), "left")  # at most 2n rows
        keep_id, size = F.coalesce("_hot_keep", "_keep"), F.coalesce("_hot_size", "_size")
    else:
        keep_id, size = F.col("_keep"), F.col("_size")
    return runs.select(
        F.col("_id").alias(id_col),
        keep_id.alias("keep_id"),
        size.alias("group_size"),
        ((F.col("_rank") == 1) & F.col("_id").eqNullSafe(keep_id)).alias("kept"),
        "text_sha256",
        *(["_row"] if carry else []),
    )
