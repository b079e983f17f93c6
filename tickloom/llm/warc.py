"""WARC archives as chunked record tables."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from datetime import UTC, datetime
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shipping import ship
from .textops import keyed, text_of

CHUNK_BYTES = 1 << 20
#: Payloads shorter than this are stored again, not referred to.
MIN_REVISIT_BYTES = 1000
#: Groups of equal payloads up to which their digests are broadcast; beyond that the join shuffles.
MAX_BROADCAST_GROUPS = 100_000


class Archive(NamedTuple):
    """A folder of WARC files. All its records name its warcinfo record, whose random identifier no
    payload can hold: the reader splits the files at it, so that Spark can read parts of a file by themselves."""

    path: str
    info_id: str

    @property
    def start(self) -> str:
        return f"WARC/1.0\r\nWARC-Warcinfo-ID: <urn:uuid:{self.info_id}>\r\n"


def _record_id(archive: Archive, row: Column, segment: Column) -> Column:
    """A record's URN: a UUID (of version 8) of the archive, the row's number and the segment's."""
    h = F.sha2(F.concat_ws(":", F.lit(archive.info_id), row, segment), 256)
    part = lambda at, n: F.substring(h, at, n)
    return F.when(row.isNotNull(), F.concat(F.lit("<urn:uuid:"), part(1, 8), F.lit("-"), part(9, 4), F.lit("-8"), part(14, 3), F.lit("-8"), part(18, 3), F.lit("-"), part(21, 12), F.lit(">")))


def _line(name: str, value: Column) -> Column:
    return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n")), F.lit(""))


def write_warc(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    chunk_bytes: int = CHUNK_BYTES,
    min_revisit: int = MIN_REVISIT_BYTES,
) -> Archive:
    """Writes a record for each page under path, as Spark's text writer deals out the rows.

    A warcinfo record comes first. A payload of more than chunk_bytes becomes several records (segments, numbered from 1,
    as the format has them), so that no record outgrows a chunk. Of equal payloads of at least min_revisit bytes, that
    of the largest identifier is a response, and the others are revisit records without a block. Numbers of pages stand in
    fields of their own (Page-ID, Refers-To-Page-ID), since the format's own name records.

    Rows are numbered where they are read: pages is a table, or a frame cut by a checkpoint.

    Defined cases: a null payload is empty; a null identifier or URL leaves its header out, or names an unknown page (a page without identifier
    is never referred to if another has an identifier); pages that repeat an identifier are records of
    their own; line breaks in a URL are written as %0D and %0A.
    """
    spark = pages.sparkSession
    rows = keyed(pages, id_col, url_col, html_col).withColumn("_payload", text_of(f"_{html_col}").cast("binary"))
    long_ = F.octet_length("_payload") >= min_revisit
    rows = rows.withColumn("_key", F.when(long_, F.sha2("_payload", 256)))
    groups = (
        rows.filter(long_)
        .groupBy("_key")
        .agg(F.max(F.struct("_id", "_row")).alias("_first"), F.count(F.lit(1)).alias("_copies"))
        .filter("_copies > 1")
        .select("_key", F.col("_first._id").alias("_first_id"), F.col("_first._row").alias("_first_row"))
    )
    small = groups.limit(MAX_BROADCAST_GROUPS + 1).count() <= MAX_BROADCAST_GROUPS
    rows = rows.join(F.broadcast(groups) if small else groups, "_key", "left")
    revisit = F.coalesce(F.col("_first_row") != F.col("_row"), F.lit(False))
    size = F.octet_length("_payload")
    count = F.when(revisit, 1).otherwise(F.greatest(F.lit(1), F.ceil(size / F.lit(chunk_bytes)))).cast("int")
    # A payload is cut once, and its segments do not carry it: they have a block each, and no other text.
    cut = F.transform(F.sequence(F.lit(1), count), lambda i: F.substring("_payload", (i - 1) * chunk_bytes + 1, F.lit(chunk_bytes)))
    segments = rows.select(
        "_row", "_id", f"_{url_col}", "_first_id", "_first_row", revisit.alias("_revisit"), count.alias("_count"), size.alias("_size"),
        F.sha1("_payload").alias("_digest"), F.posexplode(F.when(revisit, F.array(F.lit(b""))).otherwise(cut)).alias("_at", "_block"),
    ).withColumn("_segment", F.col("_at") + 1)
    url = F.replace(F.replace(F.col(f"_{url_col}"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    kind = F.when(F.col("_revisit"), "revisit").when(F.col("_segment") > 1, "continuation").otherwise("response")
    archive = Archive(path, str(uuid.uuid4()))
    date = datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    one, segment = F.lit(1), F.col("_segment")
    head = F.concat(
        F.lit(archive.start),
        _line("WARC-Type", kind),
        _line("WARC-Record-ID", _record_id(archive, F.col("_row"), segment)),
        _line("WARC-Date", F.lit(date)),
        _line("Page-ID", F.col("_id")),
        _line("WARC-Target-URI", F.coalesce(url, F.lit("urn:page:unknown"))),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("_digest"))),
        _line("Payload-Length", F.col("_size")),
        _line("WARC-Profile", F.when(F.col("_revisit"), F.lit("http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"))),
        _line("WARC-Refers-To", F.when(F.col("_revisit"), _record_id(archive, F.col("_first_row"), one))),
        _line("Refers-To-Page-ID", F.when(F.col("_revisit"), F.col("_first_id"))),
        _line("WARC-Segment-Number", F.when(F.col("_count") > 1, segment)),
        _line("WARC-Segment-Origin-ID", F.when(segment > 1, _record_id(archive, F.col("_row"), one))),
        _line("WARC-Segment-Total-Length", F.when((F.col("_count") > 1) & (segment == F.col("_count")), F.col("_size"))),
        _line("Segment-Count", F.when(F.col("_count") > 1, F.col("_count"))),
        _line("Record-Row", F.col("_row")),
        _line("Content-Length", F.octet_length("_block")),
        F.lit("\r\n"),
    )
    # The writer ends each row with a line feed, the last byte of a record.
    record = F.concat(head.cast("binary"), F.col("_block"), F.lit(b"\r\n\r")).cast("string")
    block_ = "software: tickloom\r\nformat: WARC File Format 1.0\r\n"
    info = f"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{archive.info_id}>\r\nWARC-Date: {date}\r\nContent-Type: application/warc-fields\r\n"
    info += f"Content-Length: {len(block_)}\r\n\r\n{block_}\r\n\r"
    spark.createDataFrame([(info,)], "value string").coalesce(1).write.text(path, lineSep="\n")
    segments.select(record.alias("value")).write.mode("append").text(path, lineSep="\n")
    return archive


def open_warc(spark: SparkSession, path: str) -> Archive:
    """An archive that write_warc() left under path."""
    kinds = spark.read.text(path, lineSep="\r\n\r\n").filter(F.col("value").startswith("WARC/1.0\r\nWARC-Type: warcinfo\r\n"))
    for row in kinds.head(1):
        return Archive(path, row.value.split("WARC-Record-ID: <urn:uuid:")[1].split(">")[0])
    raise ValueError(f"no archive at {path}")


def read_chunks(spark: SparkSession, archive: Archive) -> DataFrame:
    """The chunk table: record_row, chunk, chunks, page_id, url, record_type, refers_to, digest, length
    (both as declared; of the whole payload), block. A row for each record; a long payload has several.

    The warcinfo record has no row. Fails on a block whose length is not the declared one.
    """
    value = F.col("value")
    inner = F.when(value.startswith(archive.start), F.substr(value, F.lit(len(archive.start) + 1))).otherwise(value)
    head = F.substring_index("_record", "\r\n\r\n", 1)
    field = lambda name: F.nullif(F.regexp_extract("_head", rf"(?:^|\r\n){name}: ([^\r\n]*)", 1), F.lit(""))
    raw = F.col("_record").cast("binary")
    length = field("Content-Length").cast("int")
    start = F.octet_length("_head") + 4
    rest = F.octet_length("_record") - start - length
    block = F.when(
        rest.isin(0, 4), F.substring(raw, start + 1, length)
    ).otherwise(F.raise_error(F.lit("a WARC record's length differs from its Content-Length")).cast("binary"))
    return (
        spark.read.text(archive.path, lineSep=f"\r\n\r\n{archive.start}")
        .select(inner.alias("_record"))
        .filter(~F.col("_record").startswith("WARC/1.0\r\nWARC-Type: warcinfo\r\n"))
        .select("_record", head.alias("_head"))
        .select(
            field("Record-Row").cast("long").alias("record_row"),
            F.coalesce(field("WARC-Segment-Number").cast("int"), F.lit(1)).alias("chunk"),
            F.coalesce(field("Segment-Count").cast("int"), F.lit(1)).alias("chunks"),
            field("Page-ID").alias("page_id"),
            F.nullif(field("WARC-Target-URI"), F.lit("urn:page:unknown")).alias("url"),
            field("WARC-Type").alias("record_type"),
            field("Refers-To-Page-ID").alias("refers_to"),
            F.substring(field("WARC-Payload-Digest"), 6, 40).alias("digest"),
            field("Payload-Length").cast("long").alias("length"),
            block.alias("block"),
        )
    )


_DIGESTED = "record_row long, page_id string, url string, record_type string, refers_to string, digest string, length long, chunks int, seen int, payload_bytes long, payload_digest string"


def _digest_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums up each record's chunks, which come in order: its bytes and a digest carried from chunk to chunk."""
    names = [x.split()[0] for x in _DIGESTED.split(", ")]
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}
    schema = pa.schema([(n, kinds[x.split()[1]]) for n, x in zip(names, _DIGESTED.split(", "), strict=True)])
    now, sha, size, seen = None, None, 0, 0

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([now | {"seen": seen, "payload_bytes": size, "payload_digest": sha.hexdigest()}], schema)

    for batch in batches:
        for i in range(batch.num_rows):
            row = {n: batch.column(n)[i].as_py() for n in batch.schema.names if n != "block"}
            if now is None or row["record_row"] != now["record_row"]:
                if now is not None:
                    yield done()
                now, sha, size, seen = {n: row[n] for n in names if n in row}, hashlib.sha1(), 0, 0
            block = batch.column("block")[i].as_buffer()
            sha.update(block)
            size, seen = size + block.size, seen + 1
    if now is not None:
        yield done()


def read_records(spark: SparkSession, archive: Archive, id_type: str = "long") -> DataFrame:
    """One row per page: page_id, url, record_type, refers_to, payload_bytes, payload_digest.

    Length and digest are taken from the blocks, and must be the declared ones. A record of one chunk is
    digested where it is read. The chunks of longer ones meet in chunk order in one task, which holds a
    chunk at a time. A revisit has no block; its length and digest are those that it declares.
    """
    ship(spark)
    chunks = read_chunks(spark, archive)
    single = chunks.filter("chunks = 1").select(
        "page_id", "url", "record_type", "refers_to", "digest", "length",
        F.when(F.col("record_type") == "revisit", F.col("length")).otherwise(F.octet_length("block")).cast("long").alias("payload_bytes"),
        F.when(F.col("record_type") == "revisit", F.col("digest")).otherwise(F.sha1("block")).alias("payload_digest"),
    )
    long_ = (
        chunks.filter("chunks > 1")
        .repartition("record_row")
        .sortWithinPartitions("record_row", "chunk")
        .mapInArrow(_digest_chunks, _DIGESTED)
        .filter(
            (F.col("seen") == F.col("chunks")) | F.raise_error(F.lit("a WARC record lacks chunks")).cast("boolean")
        )
    )
    found = single.unionByName(long_.select(single.columns))
    right = F.col("payload_digest").eqNullSafe(F.col("digest")) & F.col("payload_bytes").eqNullSafe(F.col("length"))
    return found.filter(right | F.raise_error(F.lit("a WARC payload differs from its digest")).cast("boolean")).select(
        F.col("page_id").cast(id_type).alias("page_id"),
        "url",
        "record_type",
        F.col("refers_to").cast(id_type).alias("refers_to"),
        "payload_bytes",
        "payload_digest",
    )
