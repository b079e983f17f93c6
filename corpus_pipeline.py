"""From raw documents to token ids: the stages of the corpus pipeline.

Each stage takes all rows that the one before kept, whatever their identifiers and further columns, and an empty table too;
null texts count as empty.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import bpe, quality
from tickloom.llm.decontam import contained_items
from tickloom.llm.exact_dedup import exact_dedup
from tickloom.llm.near_dedup import near_duplicates
from tickloom.llm.textops import checkpointed, shared_dir

#: The stages train a classifier and verify links on full sets; SQL expresses neither.
ORACLE_SQL = None
RANKS = "byte_bpe_50k.tiktoken"
#: Dropped documents up to which their identifiers are broadcast; beyond that the join shuffles.
MAX_BROADCAST_IDS = 500_000
DIGEST = "_read_sha256"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def without(docs: DataFrame, ids: DataFrame, key: str = "doc_id") -> DataFrame:
    """The documents whose key is not among ids."""
    ids = checkpointed(ids.distinct())
    small = ids.limit(MAX_BROADCAST_IDS + 1).count() <= MAX_BROADCAST_IDS
    return docs.join(F.broadcast(ids) if small else ids, key, "left_anti")


def digested(docs: DataFrame, *columns: str) -> DataFrame:
    """The documents with DIGEST, of all that the columns hold: what is decided by them alone holds for all rows that share
    it and for no other, whatever their doc_id."""
    told = F.concat(*[F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), F.col(c)), F.lit("-")) for c in columns])
    return docs.withColumn(DIGEST, F.unhex(F.sha2(told, 256)))


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the co-trained quality classifier rejects go, each by what it holds, with or without a doc_id."""
    model = quality.train(docs, read(spark, sf_dir, "labels"))
    rows = digested(docs, *[c for c in ("text", "source", "lang", "n_chars") if c in docs.columns])
    return without(rows, quality.score(rows, model, DIGEST).filter("NOT kept").select(DIGEST), DIGEST).select(docs.columns)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays: that with the smallest doc_id, or one without where none has any. Rows
    that share a doc_id are told apart by their texts."""
    return exact_dedup(docs, carry=True).filter("kept").select("_row.*")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: that with the smallest doc_id. Rows that share a doc_id belong to
    one group and stay or go together; rows without a doc_id are in no group and stay."""
    return without(docs, near_duplicates(docs).filter("NOT kept").select("doc_id")).select(docs.columns)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text contains a benchmark item go, each by its text, with or without a doc_id."""
    rows = digested(docs, "text")
    return without(rows, contained_items(rows, read(spark, sf_dir, "benchmark"), DIGEST).select(DIGEST), DIGEST).select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (32-bit little-endian numbers), decoded_sha256 (of the bytes that the ids give back), for each
    row, also those that share a doc_id or have none."""
    ranks = public_tokenizers.path(RANKS)
    coded = bpe.bpe_encode(docs, ranks, public_tokenizers.PATTERN, decode=True)
    return coded.withColumn("decoded_sha256", F.sha2("decoded", 256)).drop("decoded")


STAGES = [
    ("quality", good),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("decontamination", clean),
    ("byte_bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over documents. What a stage keeps is written to the shared folder, so that no later
    one works it out again."""
    docs, folder = read(spark, sf_dir, "documents"), f"{shared_dir(spark)}/pipeline-{uuid.uuid4()}"
    for name, stage in STAGES:
        if name != STAGES[0][0]:
            docs.write.parquet(f"{folder}/{name}")
            docs = spark.read.parquet(f"{folder}/{name}")
        docs = stage(spark, docs, sf_dir)
    return docs
