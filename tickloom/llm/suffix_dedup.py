"""Removal of repeated passages with longest-previous-factor arrays over suffix-sorted windows."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shipping import ship
from .features import map_rows
from .textops import shared_dir, text_of

#: Bytes of a gram. The gram of least hash in a window decides where the window is compared.
GRAM = 32
#: Windows of a segment at most; bounds a row where one gram stays the least for long (periodic texts).
MAX_WINDOWS = 1024
#: Windows of a text that are cut into segments at once; bounds memory for very long texts.
BLOCK_WINDOWS = 1 << 20
#: Bytes of segments that are suffix-sorted at once.
CHUNK_BYTES = 1 << 20
#: Distinct segments up to which those of one least gram are sorted in one task. The windows of larger
#: groups are counted by digest over all tasks: exact too, but not by the factor array.
MAX_GROUP = 2000

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_Q = 0x9E3779B97F4A7C15
_Q_INVERSE = pow(_Q, -1, 1 << 64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _span_hashes(raw: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """64-bit hashes of all strings of size bytes, put together from those of powers of two."""
    rng = np.random.default_rng(size * 1000 + seed)
    odd = lambda: np.uint64(int(rng.integers(0, 1 << 62)) * 2 + 1)
    n = len(raw) - size + 1
    part, width, found, done = (raw.astype(np.uint64) + np.uint64(1)) * odd(), 1, None, 0
    while True:
        if size & width:
            piece = part[done : done + n]
            found = _mixed(piece * odd()) if found is None else _mixed(found * odd() + piece)
            done += width
        if done == size:
            return found
        part = _mixed(part[: len(part) - width] * odd() + part[width:])
        width *= 2


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each width neighbours: of a block's rest and the next block's beginning."""
    n = len(x)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = x
    grid = padded.reshape(blocks, width)
    begin = np.minimum.accumulate(grid, axis=1).ravel()
    rest = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(rest[: n - width + 1], begin[width - 1 : n])


def segments(raw: bytes, length: int) -> dict[str, np.ndarray] | None:
    """The segments of a whole text (see _segments()), worked out a block of windows at a time."""
    if len(raw) < length:
        return None
    parts = []
    for at in range(0, len(raw) - length + 1, BLOCK_WINDOWS):
        part = _segments(raw[at : at + BLOCK_WINDOWS + length - 1], length)
        part["start"] += at
        parts.append(part)
    return {n: np.concatenate([p[n] for p in parts]) for n in parts[0]}


def _segments(raw: bytes, length: int) -> dict[str, np.ndarray]:
    """Cuts a text's windows (strings of length bytes, one for each start) into segments of neighbouring
    windows with the same least gram hash. Equal windows have equal ones, wherever they stand.

    start, count (windows), least, content (hash of the segment's bytes), again (the least gram
    stands in the segment more than once, so that its own windows may repeat).
    """
    text = np.frombuffer(raw, np.uint8)
    width = length - GRAM + 1
    grams = _span_hashes(text, GRAM)
    least = _sliding_least(grams, width)
    n = len(least)
    starts = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    runs = np.diff(np.append(starts, n))
    pieces = -(-runs // MAX_WINDOWS)
    if len(pieces) != pieces.sum():
        inside = np.arange(int(pieces.sum())) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        starts = np.repeat(starts, pieces) + inside * MAX_WINDOWS
    ends = np.append(starts[1:], n)
    values = least[starts]
    ahead = np.cumprod(np.full(len(grams), _Q, np.uint64))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(grams * ahead, dtype=np.uint64)])
    back = np.cumprod(np.full(len(grams), _Q_INVERSE, np.uint64))[starts]
    last = ends + width - 1  # grams [start, last) lie in the segment
    content = _mixed((total[last] - total[starts]) * back + (ends - starts).astype(np.uint64))
    known = np.unique(values)
    maybe = np.zeros(1 << 16, bool)
    maybe[(known & np.uint64(0xFFFF)).astype(np.int64)] = True
    at = np.flatnonzero(maybe[(grams & np.uint64(0xFFFF)).astype(np.int64)])
    number = np.searchsorted(known, grams[at])
    real = (number < len(known)) & (known[np.minimum(number, len(known) - 1)] == grams[at])
    places = np.sort(number[real] * (1 << 40) + at[real])
    mine = np.searchsorted(known, values) * (1 << 40)
    again = np.searchsorted(places, mine + last) - np.searchsorted(places, mine + starts) > 1
    return {"start": starts, "count": ends - starts, "least": values, "content": content, "again": again}


def _smaller_before(place: np.ndarray, lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry in suffix order the nearest one before it that stands earlier in the text (or -1),
    and the length that both have in common. lcp[i] is that of entries i - 1 and i."""
    j, common = np.arange(len(place)) - 1, lcp.copy()
    open_ = np.flatnonzero((j >= 0) & (place[j] > place))
    while len(open_):
        via = j[open_]
        common[open_] = np.minimum(common[open_], common[via])
        j[open_] = j[via]
        open_ = open_[(j[open_] >= 0) & (place[j[open_]] > place[open_])]
    return j, np.where(j >= 0, common, 0)


def _dense(keys: np.ndarray) -> np.ndarray:
    """The rank of each key among the distinct ones."""
    order = np.argsort(keys)
    sorted_ = keys[order]
    rank = np.empty(len(keys), np.uint32)
    rank[order] = np.concatenate([[0], np.cumsum(sorted_[1:] != sorted_[:-1])]) if len(keys) else 0
    return rank


def _pairs(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return first.astype(np.uint64) << np.uint64(32) | second


def suffix_ranks(text: np.ndarray, length: int) -> dict[int, np.ndarray]:
    """Width -> rank of the string of so many bytes at each place in their order, for 8, 16, 32 ... up to length bytes, each
    width found from the one half as wide."""
    words = np.ndarray(len(text) - 7, ">u8", np.ascontiguousarray(text), strides=(1,)).astype(np.uint64)
    width, ranks = 8, {8: _dense(words)}
    while 2 * width <= length:
        half = ranks[width]
        ranks[2 * width] = _dense(_pairs(half[:-width], half[width:]))
        width *= 2
    return ranks


def longest_previous_factors(text: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window start (ascending) the length, up to `length`, of the longest string from there on
    that also starts at an earlier one, and that earlier start (or -1). `length` is at least 8.

    The windows are put in suffix order by their ranks, and neighbours' common prefixes measured from wide to narrow ranks.
    """
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    ranks = suffix_ranks(text, length)
    widest = max(ranks)
    order = np.argsort(_pairs(ranks[widest][starts], ranks[widest][starts + length - widest]), kind="stable")
    place = starts[order]
    a, b, common = place[:-1], place[1:], np.zeros(len(place) - 1, np.int64)
    for width in sorted(ranks, reverse=True):
        at = np.flatnonzero(common + width <= length)
        at = at[ranks[width][a[at] + common[at]] == ranks[width][b[at] + common[at]]]
        common[at] += width
    open_ = np.flatnonzero(common < length)
    while len(open_):
        open_ = open_[text[a[open_] + common[open_]] == text[b[open_] + common[open_]]]
        common[open_] += 1
        open_ = open_[common[open_] < length]
    lcp = np.concatenate([[0], common])
    before, with_before = _smaller_before(place, lcp)
    after, with_after = _smaller_before(place[::-1], np.concatenate([[0], common[::-1]]))
    after, with_after = np.where(after >= 0, len(place) - 1 - after, -1)[::-1], with_after[::-1]
    nearer = with_before >= with_after
    source = np.where(nearer, before, after)
    factor, earlier = np.zeros(len(starts), np.int64), np.full(len(starts), -1)
    factor[order] = np.maximum(with_before, with_after)
    earlier[order] = np.where(source >= 0, place[source], -1)
    return factor, earlier


def _repeated(texts: list[bytes], counts: list[int], length: int, keep_first: bool) -> np.ndarray:
    """Marks the windows to remove, in the joined texts of segments that come in text order."""
    text = np.frombuffer(b"".join(texts), np.uint8)
    sizes, counts_ = np.array([len(t) for t in texts]), np.array(counts)
    begins = np.cumsum(sizes) - sizes
    inside = np.arange(int(counts_.sum())) - np.repeat(np.cumsum(counts_) - counts_, counts_)
    windows = np.repeat(begins, counts_) + inside
    factor, earlier = longest_previous_factors(text, windows, length)
    later = factor >= length
    removed = np.zeros(len(text), bool)
    removed[windows[later]] = True
    if not keep_first:
        removed[earlier[later]] = True
    return removed


def _sort_chunks(length: int, keep_first: bool):
    """For rows sorted by least gram: marks repeated windows among the segments of as many whole groups as
    fill a chunk. Gives rows id, key, start, end (of windows)."""
    names = ["_id", "_key", "start", "end"]

    def done(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
        rows = list({r[:3]: r for r in rows}.values())  # equal rows of the table share their segments
        rows.sort(key=lambda r: (r[0] is not None, r[0], r[1], r[2]))
        removed = _repeated([r[5] for r in rows], [r[3] for r in rows], length, keep_first)
        out, at = [], 0
        for id_, key, start, count, whole, text in rows:
            if not whole:
                mask = removed[at : at + count]
                edges = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8)))
                out += [(id_, key, start + int(a), start + int(b)) for a, b in zip(edges[::2], edges[1::2], strict=True)]
            at += len(text)
        columns = list(zip(*out, strict=True)) or [(), (), (), ()]
        kinds = [id_type, pa.int64(), pa.int32(), pa.int32()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size, now = [], 0, None
        for batch in batches:
            lists = {n: batch.column(n).to_pylist() for n in ("least", "_id", "_key", "start", "count", "whole")}
            text, id_type = batch.column("text"), batch.column("_id").type
            for i in range(batch.num_rows):
                if lists["least"][i] != now and size >= CHUNK_BYTES:
                    yield done(rows, id_type)
                    rows, size = [], 0
                now = lists["least"][i]
                rows.append((*(lists[n][i] for n in ("_id", "_key", "start", "count", "whole")), text[i].as_py()))
                size += len(rows[-1][5])
        if rows:
            yield done(rows, id_type)

    return run


def _window_digests(length: int):
    """A row for each window of each segment: its two hashes, and where it stands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                text = np.frombuffer(row.column("text")[0].as_py(), np.uint8)
                n = len(text) - length + 1
                same = pa.array(np.zeros(n, np.int64))
                start = row.column("start")[0].as_py()
                yield pa.RecordBatch.from_arrays(
                    [
                        row.column("_id").take(same), row.column("_key").take(same), row.column("whole").take(same),
                        pa.array(np.arange(start, start + n), pa.int32()),
                        *[pa.array(_span_hashes(text, length, seed).view(np.int64)) for seed in (1, 2)],
                    ],
                    names=["_id", "_key", "whole", "start", "d1", "d2"],
                )

    return run


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 200, keep: str = "first", carry: bool = False) -> DataFrame:
    """One row per input row: <id_col>, n_bytes, n_removed, n_spans, kept_sha256, spans (array of start, end in bytes),
    kept_bytes (binary; and _row, if carry).

    Whole texts are UTF-8 bytes, null counts as empty; matches do not cross documents. Every byte is removed that a string
    of `length` bytes covers which also starts elsewhere: earlier, in the order of identifiers and within a document
    (keep="first"), or anywhere (keep="none"). Strings are judged on the input.

    The windows of each text are cut into segments by their least gram (see segments()). Segments whose least
    gram stands nowhere else are done. Segments with the same bytes repeat as wholes. One of each of the
    rest, with its text, meets the others of its least gram in one task, which sorts their windows as
    suffixes and builds the longest-previous-factor array: previous and next smaller positions in suffix order
    give the earlier matches. The windows of least grams with more than MAX_GROUP distinct segments are
    counted by 128-bit digest instead, so that no task meets them all. Memory in a task is bounded by blocks of windows and
    by the longest row.

    Defined cases: texts shorter than `length` lose nothing; rows of equal identifier and text share their marks
    (with keep="first" they count as one document); null
    identifiers come first; other columns are ignored, and come back in the struct `_row` if carry is set.
    """
    if length < 2 * GRAM or keep not in ("first", "none"):
        raise ValueError(f"length is at least {2 * GRAM}, keep is first or none")
    spark = docs.sparkSession
    ship(spark)
    keep_first = keep == "first"
    folder = f"{shared_dir(spark)}/suffix-{uuid.uuid4()}"

    def saved(frame: DataFrame, name: str) -> DataFrame:
        frame.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    # The key tells rows of one identifier apart by their texts; rows that are equal share their marks.
    texts = docs.select(
        F.col(id_col).alias("_id"), F.xxhash64(text_of(text_col)).alias("_key"), text_of(text_col).cast("binary").alias("_text"),
        *([F.struct("*").alias("_row")] if carry else []),
    )
    id_type = dict(texts.dtypes)["_id"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column("_text")
            parts, rows = [], []
            for i in range(batch.num_rows):
                if (found := segments(text[i].as_buffer(), length)) is not None:
                    parts.append(found)
                    rows.append(np.full(len(found["start"]), i))
            if parts:
                at = pa.array(np.concatenate(rows))
                whole = {n: np.concatenate([p[n] for p in parts]) for n in parts[0]}
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("_id").take(at), batch.column("_key").take(at), pa.array(whole["start"], pa.int32()), pa.array(whole["count"], pa.int32()),
                        pa.array(whole["least"].view(np.int64)), pa.array(whole["content"].view(np.int64)), pa.array(whole["again"]),
                    ],
                    names=["_id", "_key", "start", "count", "least", "content", "again"],
                )

    all_ = saved(
        texts.select("_id", "_key", "_text").mapInArrow(cut, f"_id {id_type}, _key long, start int, count int, least long, content long, again boolean"),
        "segments",
    )
    shared = all_.groupBy("least").agg(F.count(F.lit(1)).alias("n"), F.max("again").alias("a")).filter("n > 1 OR a").select("least")
    mine = saved(all_.join(shared, "least", "left_semi"), "shared")
    place = F.struct("_id", "_key", "start", "count")
    distinct = mine.groupBy("least", "content").agg(F.count(F.lit(1)).alias("copies"), F.min(place).alias("first"), F.max("again").alias("again"))
    distinct = saved(distinct, "distinct")
    groups = distinct.groupBy("least").agg(F.count(F.lit(1)).alias("members"), F.max("again").alias("any_again")).filter("members > 1 OR any_again")
    # A segment with copies is removed as a whole, but for its first place if that is to be kept.
    compared = distinct.join(groups, "least").select(
        "first.*", "least", "members", ((F.col("copies") > 1) & F.lit(not keep_first)).alias("whole")
    )

    def same_text(i: str, k: str):
        return F.col("_id").eqNullSafe(F.col(i)) & (F.col("_key") == F.col(k))

    # Both sides are shuffled, whatever their size: what is compared grows with the documents.
    wanted = compared.withColumnsRenamed({"_id": "_i", "_key": "_k"}).hint("shuffle_merge")
    pieces = texts.join(wanted, same_text("_i", "_k")).select(
        "_id", "_key", "start", "count", "least", "members", "whole", F.substring("_text", F.col("start") + 1, F.col("count") + length - 1).alias("text")
    )
    pieces = saved(pieces, "pieces")
    few = pieces.filter(F.col("members") <= MAX_GROUP).repartition("least").sortWithinPartitions("least")
    spans_schema = f"_id {id_type}, _key long, start int, end int"
    marks = few.mapInArrow(_sort_chunks(length, keep_first), spans_schema)
    if not pieces.filter(F.col("members") > MAX_GROUP).isEmpty():
        many = pieces.filter(F.col("members") > MAX_GROUP).mapInArrow(
            _window_digests(length), f"_id {id_type}, _key long, whole boolean, start int, d1 long, d2 long"
        )
        many = saved(many.dropDuplicates(["_id", "_key", "start"]), "windows")
        counts = many.groupBy("d1", "d2").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("_id", "_key", "start")).alias("first")).filter("n > 1")
        again = many.filter(~F.col("whole")).join(counts, ["d1", "d2"])
        if keep_first:
            again = again.filter(~F.struct("_id", "_key", "start").eqNullSafe(F.col("first")))
        marks = marks.union(again.select("_id", "_key", "start", (F.col("start") + 1).alias("end")))
    copied = mine.join(distinct.filter("copies > 1").select("least", "content", "first"), ["least", "content"])
    if keep_first:
        copied = copied.filter(~place.eqNullSafe(F.col("first")))
    marks = marks.union(copied.select("_id", "_key", "start", (F.col("start") + F.col("count")).alias("end")))
    lists = marks.groupBy("_id", "_key").agg(F.collect_list(F.struct("start", "end")).alias("list"))
    lists = lists.withColumnsRenamed({"_id": "_i", "_key": "_k"}).hint("shuffle_merge")

    def remove(columns: dict[str, list]) -> dict[str, pa.Array]:
        kept, spans = [], []
        for raw, marked in zip(columns["_text"], columns["list"], strict=True):
            merged: list[list[int]] = []
            for a, b in sorted((m["start"], m["end"] - 1 + length) for m in marked or []):
                if merged and a <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], b)
                else:
                    merged.append([a, b])
            ends = [0, *(x for m in merged for x in m), len(raw)]
            kept.append(b"".join(raw[a:b] for a, b in zip(ends[::2], ends[1::2], strict=True)) if merged else raw)
            spans.append([{"start": a, "end": b} for a, b in merged])
        return {
            "n_bytes": pa.array([len(r) for r in columns["_text"]], pa.int64()),
            "n_removed": pa.array([len(r) - len(k) for r, k in zip(columns["_text"], kept, strict=True)], pa.int64()),
            "n_spans": pa.array([len(s) for s in spans], pa.int64()),
            "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept]),
            "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
            "kept_bytes": pa.array(kept, pa.binary()),
        }

    given = texts.join(lists, same_text("_i", "_k"), "left").drop("_key", "_i", "_k")
    passed = [c for c in given.columns if c not in ("_text", "list")]
    made = "n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,end:long>>, kept_bytes binary"
    schema = ", ".join([f"`{c}` {t}" for c, t in given.dtypes if c in passed] + [made])
    return given.mapInArrow(map_rows(passed, remove), schema).withColumnRenamed("_id", id_col)
