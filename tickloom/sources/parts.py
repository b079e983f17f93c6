"""Parts of zstd frames of JSON lines as a Spark data source: written by tasks, read a range of frames at a time."""

from __future__ import annotations

import json
import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from ..shared import shared_dir
from ..shipping import ship

#: Bytes of a part that one task reads, whole frames of them.
SPLIT_BYTES = 32 << 20
#: Ranges smaller than SPLIT_BYTES that a scan is cut into at most, beside one for each part.
MAX_RANGES = 256
#: Lines of a frame, and of a batch that a reader hands over.
FRAME_LINES, BATCH_LINES = 10_000, 4096
_MAGIC = b"\x28\xb5\x2f\xfd"
_LINES = "path string, frame_start long, frame_end long, line_no long, line string, ok boolean"


def _files(root: str):
    """The file system of a path or URI that any of pyarrow's file systems know, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(root) if ":" in root else (fs.LocalFileSystem(), root)


def frame_end(source, start: int, size: int) -> int | None:
    """Where the frame that starts at `start` ends, by its header and those of its blocks, without what they hold; null where there is
    no whole frame."""
    import zstandard

    source.seek(start)
    head = source.read(min(18, size - start))
    if head[:4] != _MAGIC:
        return None
    try:
        at = start + zstandard.frame_header_size(head)
        checksum = zstandard.get_frame_parameters(head).has_checksum
    except zstandard.ZstdError:
        return None
    while True:
        if at + 3 > size:
            return None
        source.seek(at)
        block = int.from_bytes(source.read(3), "little")
        last, kind, length = block & 1, block >> 1 & 3, block >> 3
        if kind == 3:
            return None
        at += 3 + (1 if kind == 1 else length)
        if last:
            at += 4 * checksum
            return at if at <= size else None


def frame_lines(source, start: int, end: int) -> list[str] | None:
    """The lines of a frame, each of them JSON; null if it cannot be read."""
    import zstandard

    source.seek(start)
    try:
        lines = zstandard.ZstdDecompressor().decompressobj().decompress(source.read(end - start)).decode().splitlines()
        for line in lines:
            json.loads(line)
    except (zstandard.ZstdError, ValueError):
        return None
    return lines


@dataclass
class _Range(InputPartition):
    path: str
    size: int
    start: int
    end: int


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.root, self.suffix, self.split = options["path"], options.get("suffix", ".jsonl.zst"), int(options.get("splitbytes", SPLIT_BYTES))

    def partitions(self) -> list[InputPartition]:
        """Ranges of the files' sizes alone; tasks find the frames that begin in theirs. A splitBytes below SPLIT_BYTES makes
        MAX_RANGES of them and one a part at most: as each task walks over the frames before its own, the walks then grow with the
        bytes, not with their square."""
        from pyarrow import fs

        files, inner = _files(self.root)
        found = files.get_file_info(fs.FileSelector(inner, recursive=True))
        parts = [f for f in found if f.is_file and f.path.endswith(self.suffix)]
        split = max(self.split, min(SPLIT_BYTES, -(-sum(f.size for f in parts) // MAX_RANGES)))
        return [_Range(f.path, f.size, at, min(at + split, f.size)) for f in parts for at in range(0, f.size, split)]

    def read(self, partition: _Range) -> Iterator[pa.RecordBatch]:
        """Lines of the frames that begin in the range; a frame that cannot be read is one row without a line, and ends the part."""
        kinds = pa.schema([("path", pa.string()), ("frame_start", pa.int64()), ("frame_end", pa.int64()), ("line_no", pa.int64()), ("line", pa.string()), ("ok", pa.bool_())])
        files, _ = _files(self.root)
        with files.open_input_file(partition.path) as source:
            at, size = 0, partition.size
            while at < partition.end:
                end = frame_end(source, at, size)
                if at >= partition.start:
                    lines = None if end is None else frame_lines(source, at, end)
                    rows = [None] if lines is None else lines
                    upto = size if end is None else end
                    for i in range(0, max(1, len(rows)), BATCH_LINES):
                        some = rows[i : i + BATCH_LINES]
                        n = len(some)
                        columns = [[partition.path] * n, [at] * n, [upto] * n, range(i, i + n), some, [lines is not None] * n]
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds.types, strict=True)], schema=kinds)
                if end is None:
                    return
                at = end


@dataclass
class _Written(WriterCommitMessage):
    paths: list[str]


class _Writer(DataSourceWriter):
    """A part for each value of the first column, as the rows come sorted by it. A part is .partial until the job commits."""

    def __init__(self, options: dict):
        self.root, self.frame, self.suffix = options["path"], int(options.get("framelines", FRAME_LINES)), options.get("suffix", ".jsonl.zst")

    def write(self, iterator) -> _Written:
        import zstandard

        files, inner = _files(self.root)
        files.create_dir(inner, recursive=True)
        attempt, paths = uuid.uuid4().hex, []
        part, out, lines = None, None, []

        def flush() -> None:
            if lines:
                text = "".join(line + "\n" for line in lines).encode()
                out.write(zstandard.ZstdCompressor(write_checksum=True).compress(text))
                lines.clear()

        for row in iterator:
            if out is None or row[0] != part:
                if out is not None:
                    flush()
                    out.close()
                part = row[0]
                paths.append(posixpath.join(inner, f"{part}-{attempt}{self.suffix}"))
                out = files.open_output_stream(paths[-1] + ".partial")
            lines.append(row[1])
            if len(lines) >= self.frame:
                flush()
        if out is not None:
            flush()
            out.close()
        return _Written(paths)

    def commit(self, messages) -> None:
        files, _ = _files(self.root)
        for path in [p for m in messages if m for p in m.paths]:
            files.move(path + ".partial", path)

    def abort(self, messages) -> None:
        files, _ = _files(self.root)
        for path in [p for m in messages if m for p in m.paths]:
            files.delete_file(path + ".partial")


class JsonParts(DataSource):
    """Format `jsonparts`; options path, suffix, splitBytes (reading), frameLines (writing)."""

    @classmethod
    def name(cls) -> str:
        return "jsonparts"

    def schema(self) -> str:
        return _LINES

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader({k.lower(): v for k, v in self.options.items()})

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return _Writer({k.lower(): v for k, v in self.options.items()})


def _registered(spark: SparkSession) -> SparkSession:
    ship(spark)
    spark.dataSource.register(JsonParts)
    return spark


def write_parts(rows: DataFrame, part: str, order: str, line: str, root: str, frame_lines: int = FRAME_LINES) -> None:
    """Writes each part's lines, in order, as frames of so many lines. Parts that a failed job leaves are .partial and are read by nobody."""
    _registered(rows.sparkSession)
    sorted_ = rows.repartition(part).sortWithinPartitions(part, order).select(F.col(part).cast("string").alias("part"), F.col(line).alias("line"))
    sorted_.write.format("jsonparts").mode("append").option("frameLines", frame_lines).save(root)


def scan_frames(spark: SparkSession, root: str, suffix: str = ".jsonl.zst", split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """path, frame_start, frame_end, line_no (in the frame), line, ok: of all parts under root, in tasks of split_bytes of a part. A
    task walks over the frames before its own by their headers alone. A frame that cannot be read is one row that is not ok, to the end
    of the part if its end cannot be told."""
    return _registered(spark).read.format("jsonparts").option("suffix", suffix).option("splitBytes", split_bytes).load(root)


def numbered(lines: DataFrame, frames: DataFrame | None = None) -> DataFrame:
    """path, record_index (from 0, in the order of the part), line. The lines before each frame are summed over one row a frame;
    `frames` (path, frame_start, _n), if it is known, spares reading the parts for that."""
    frames = frames or lines.groupBy("path", "frame_start").agg(F.count("line").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy("path").orderBy("frame_start").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    frames = frames.select("path", "frame_start", before.alias("_before"))
    return lines.join(frames, ["path", "frame_start"]).select("path", (F.col("_before") + F.col("line_no")).alias("record_index"), "line")


def salvaged(spark: SparkSession, root: str, suffix: str = ".partial", split_bytes: int = SPLIT_BYTES) -> tuple[DataFrame, DataFrame]:
    """Of unfinished parts: path, record_index and line of what stands before the first frame that cannot be read; and for each part
    valid_bytes, invalid_bytes (to quarantine) and records. Parts are read in ranges, and no task holds more than a frame."""
    lines = scan_frames(spark, root, suffix, split_bytes)
    bad = F.min(F.when(~F.col("ok"), F.col("frame_start")))
    frames = lines.groupBy("path", "frame_start", "frame_end", "ok").agg(F.count("line").alias("_n"))
    ends = frames.groupBy("path").agg(bad.alias("_bad"), F.max("frame_end").alias("_size"))
    valid = F.coalesce("_bad", "_size")
    facts = frames.join(ends, "path").groupBy("path").agg(
        F.first(valid).alias("valid_bytes"),
        F.first(F.col("_size") - valid).alias("invalid_bytes"),
        F.sum(F.when(F.col("frame_start") < valid, F.col("_n")).otherwise(0)).alias("records"),
    )
    good = lines.join(ends, "path").filter(F.col("frame_start") < valid).drop("_bad", "_size")
    return numbered(good), facts


def evidence(
    spark: SparkSession, root: str, declared: DataFrame, part: Column, max_rows: int, max_bytes: int, max_line_bytes: int,
    suffix: str = ".jsonl.zst", split_bytes: int = SPLIT_BYTES,
) -> tuple[DataFrame, DataFrame]:
    """Parts that have to be what is declared of them (part, rows, bytes: of the lines with their ends), within bounds: part,
    record_index and line of those that are accepted, and for every part its verdict, rows and bytes.

    A part (`part` tells its name by its path) is refused as a whole, for the first of: undeclared, missing (a file without a frame
    too), rows_over, bytes_over (as declared or as found), damaged (a frame cannot be read), line_over, rows_differ, bytes_differ.
    A null declaration differs from everything. Parts are read twice: for the facts, of which a row for each frame is kept in the
    shared folder, and then for the lines of accepted ones, so that nothing of a refused part is handed on. A part's name is taken once a file.
    """
    lines = scan_frames(spark, root, suffix, split_bytes)
    size = F.octet_length("line").cast("long")
    facts = f"{shared_dir(spark)}/facts-{uuid.uuid4()}"
    lines.groupBy("path", "frame_start").agg(
        F.count("line").alias("_n"), F.sum(size + 1).alias("_size"), F.max(size).alias("_most"), F.every("ok").alias("_ok")
    ).write.parquet(facts)
    frames = spark.read.parquet(facts)
    paths = frames.groupBy("path").agg(F.sum("_n").alias("_n"), F.sum("_size").alias("_size"), F.max("_most").alias("_most"), F.every("_ok").alias("_ok")).withColumn("part", part)
    found = paths.groupBy("part").agg(
        F.sum("_n").alias("rows"), F.coalesce(F.sum("_size"), F.lit(0)).alias("bytes"),
        F.coalesce(F.max("_most"), F.lit(0)).alias("_longest"), F.every("_ok").alias("_whole"),
    )
    told = declared.select("part", F.col("rows").alias("_rows"), F.col("bytes").alias("_bytes"), F.lit(True).alias("_told"))
    verdict = (
        F.when(F.col("_told").isNull(), "undeclared").when(F.col("_whole").isNull(), "missing")
        .when(F.greatest("rows", "_rows") > max_rows, "rows_over").when(F.greatest("bytes", "_bytes") > max_bytes, "bytes_over")
        .when(~F.col("_whole"), "damaged").when(F.col("_longest") > max_line_bytes, "line_over")
        .when(~F.col("rows").eqNullSafe(F.col("_rows")), "rows_differ").when(~F.col("bytes").eqNullSafe(F.col("_bytes")), "bytes_differ")
        .otherwise("accepted")
    )
    verdicts = found.join(told, "part", "full").select("part", verdict.alias("verdict"), "rows", "bytes")
    accepted = paths.select("path", "part").join(verdicts.filter("verdict = 'accepted'").select("part"), "part", "left_semi")
    given = numbered(lines.join(accepted.select("path"), "path", "left_semi"), frames.select("path", "frame_start", "_n"))
    return given.join(accepted, "path").select("part", "record_index", "line"), verdicts
