"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, collocations, decontam, fingerprints, language_id, licenses, periodic, quality, secret_scan, warc
from .exact_dedup import exact_dedup
from .near_dedup import near_duplicates
from .suffix_dedup import repeated_spans
from .textops import shared_dir


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_spans(read(spark, sf_dir, "documents"), keep="none").drop("spans", "kept_bytes")


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(read(spark, sf_dir, "documents")).drop("spans")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, read(spark, sf_dir, "labels")))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contained_items(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_scan(read(spark, sf_dir, "documents")).drop("found", "links")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read(spark, sf_dir, "documents"), keep="max")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = language_id.train(docs.filter(~language_id.held_out() & F.col("doc_id").isNotNull()))
    return language_id.identify(docs, model, carry={"held_out": language_id.held_out()})


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"), words=4)


#: Larger pages than this are stored and digested as chunks; small, so that pages of common size use the chunk table.
PAGE_CHUNK_BYTES = 16 << 10


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    archive = warc.write_warc(pages, f"{shared_dir(spark)}/warc-{uuid.uuid4()}", chunk_bytes=PAGE_CHUNK_BYTES)
    return warc.read_records(spark, archive, dict(pages.dtypes)["page_id"]).drop("url")


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coded = bpe.bpe_encode(read(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN, decode=True)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.neighbour_likeness(read(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.periodic_runs(periodic.with_planted_periods(read(spark, sf_dir, "documents")))
    line = lambda r: F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")])
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p"))))
    length, period = -best["l"], best["p"]
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["s"].alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).cast("long").alias("exponent_milli"),
        F.sha2(F.concat_ws("", F.transform("runs", lambda r: F.concat(line(r), F.lit("\n")))), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_suffix_dedup": op1_suffix_dedup,
        "op2_license_scan": op2_license_scan,
        "op3_quality": op3_quality,
        "op4_decontamination": op4_decontamination,
        "op5_secret_scan": op5_secret_scan,
        "op6_exact_dedup": op6_exact_dedup,
        "op7_language_id": op7_language_id,
        "op8_near_dedup": op8_near_dedup,
        "op9_warc": op9_warc,
        "op10_byte_bpe": op10_byte_bpe,
        "op11_fingerprints": op11_fingerprints,
        "op12_collocations": op12_collocations,
        "op13_periodic_runs": op13_periodic_runs,
    }


AZ = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def oracle_sql() -> dict[str, str]:
    return {
        "op2_license_scan": licenses.oracle_sql(),
        "op4_decontamination": decontam.oracle_sql(),
        "op5_secret_scan": secret_scan.oracle_sql(),
        "op6_exact_dedup": f"""
WITH n AS (SELECT doc_id, {AZ.format('text')} AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(t) AS text_sha256
FROM n WINDOW w AS (PARTITION BY t)""",
        "op12_collocations": collocations.oracle_sql(),
        "op9_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
r AS (SELECT *, row_number() OVER (PARTITION BY html ORDER BY page_id DESC NULLS LAST) > 1 AND strlen(html) >= 1000 AS again, max(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN first END AS refers_to FROM r""",
    }
