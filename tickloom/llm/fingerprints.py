"""Improbable-feature digests: rare byte windows in chained Bloom filters, compared by their bits."""

from __future__ import annotations

import base64
import hashlib
import json
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..shipping import ship
from .textops import partitions, text_of
from .workers import give_back


class Level(NamedTuple):
    """Windows of one size; a feature has to be the rarest of `width` neighbours for `votes` of their groups."""

    width: int
    votes: int
    from_chars: int
    to_chars: int


#: The ranges overlap by more than a text shrinks when a third of it is replaced, so that the two always share a level.
LEVELS = [Level(4, 1, 0, 128), Level(16, 4, 64, 512), Level(32, 8, 256, 1 << 62)]
#: Steps of a window's entropy, from 0 (all bytes differ) to BINS (all are the same).
BINS = 1000
#: Windows with less entropy than this share of the most are taken only where a text has no others near.
WEAK = 0.125
#: Bits of a filter, features that it takes, and bits for each feature.
FILTER_BITS, FILTER_FEATURES, BITS_EACH = 1024, 80, 5
#: Bytes of texts whose windows are worked out together; a longer text is worked out alone.
BLOCK_BYTES = 1 << 19

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def entropy_bins(text: np.ndarray, width: int) -> np.ndarray:
    """For each window of `width` bytes how little entropy it has, in BINS steps.

    The sum of n log n over the bytes' counts n in a window follows from that of the window before: the byte that leaves and the
    byte that enters each change one count, which is that of its like among the width - 1 bytes after or before it.
    """
    n = len(text) - width + 1
    ahead, behind = np.zeros(len(text), np.uint8), np.zeros(len(text), np.uint8)
    for apart in range(1, width):
        same = (text[:-apart] == text[apart:]).view(np.uint8)
        ahead[:-apart] += same
        behind[apart:] += same
    counts = np.arange(width + 1, dtype=np.float64)
    sums = np.round(counts * np.log2(np.maximum(counts, 1)) * 65536).astype(np.int64)
    steps = np.diff(sums)
    first = int(sums[np.bincount(text[:width], minlength=256)].sum())
    change = steps[behind[width:]] - steps[ahead[: n - 1]]
    total = first + np.concatenate([np.zeros(1, np.int64), np.cumsum(change)])
    return total * BINS // sums[width]


def rarity(counts: np.ndarray) -> np.ndarray:
    """Rank of each step of entropy: the fewer windows of all texts have it, the lower; weak ones come last."""
    weak = np.arange(BINS + 1) > BINS * (1 - WEAK)
    rank = np.empty(BINS + 1, np.int64)
    rank[np.lexsort((np.arange(BINS + 1), counts, weak))] = np.arange(BINS + 1)
    return rank


def _least_of(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each `width` neighbours: of a block's rest and the next block's beginning."""
    blocks = -(-len(keys) // width)
    grid = np.full(blocks * width, np.iinfo(np.int64).max)
    grid[: len(keys)] = keys
    grid = grid.reshape(blocks, width)
    begin = np.minimum.accumulate(grid, axis=1).ravel()
    rest = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(rest[: len(keys) - width + 1], begin[width - 1 : len(keys)])


def _joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts in one array, and the number of each byte's text."""
    return np.frombuffer(b"".join(texts), np.uint8), np.repeat(np.arange(len(texts), dtype=np.int32), [len(t) for t in texts])


def entropy_counts(texts: list[bytes], width: int) -> np.ndarray:
    """How many windows of the texts have each step of entropy."""
    text, number = _joined(texts)
    if len(text) < width:
        return np.zeros(BINS + 1, np.int64)
    bins = entropy_bins(text, width)
    return np.bincount(bins[number[: len(bins)] == number[width - 1 :]], minlength=BINS + 1)


def features(texts: list[bytes], level: Level, rank: np.ndarray) -> list[np.ndarray]:
    """The hashes of each text's selected windows, in the order of the text, each once.

    Of each `width` neighbouring windows one of lowest rank gets a vote, and those with enough votes are selected. Of equal ranks a
    hash of the first four bytes decides, and where a text repeats itself, the place modulo `width`, so that such stretches have
    features too. A text that has windows, but none with enough votes, gives those of lowest rank; one that is shorter than a window
    is its own feature.
    """
    width = level.width
    text, number = _joined(texts)
    edges = np.cumsum([0, *map(len, texts)])
    out = [np.zeros(0, np.uint64)] * len(texts)
    if len(text) >= width:
        bins = entropy_bins(text, width)
        place = np.arange(len(bins))
        ranks = np.where(number[: len(bins)] == number[width - 1 :], rank[bins], BINS + 1)
        begin = np.ndarray(len(bins), ">u4", text, strides=(1,)).astype(np.uint32) * np.uint32(0x9E3779B1) >> np.uint32(20)
        keys = ((ranks << 12 | begin) << 5 | (place - edges[number[: len(bins)]]) % width) << 34 | place
        chosen = np.zeros(0, np.int64)
        if len(keys) >= width:
            whole = number[: len(keys) - width + 1] == number[2 * width - 2 :]
            winners = _least_of(keys, width)[whole] & (1 << 34) - 1
            chosen = np.flatnonzero(np.bincount(winners, minlength=len(keys)) >= level.votes)
        bare = np.ones(len(texts), bool)
        bare[number[chosen]] = False
        more = [chosen]
        for i in np.flatnonzero(bare & (np.diff(edges) >= width)):
            some = ranks[edges[i] : edges[i + 1] - width + 1]
            more.append(edges[i] + np.flatnonzero(some == some.min()))
        chosen = np.sort(np.concatenate(more))
        hashes = np.full(len(chosen), 0x9E3779B97F4A7C15, np.uint64)
        padded = np.concatenate([text, np.zeros(8, np.uint8)])
        for at in range(0, width, 8):
            step = min(8, width - at)
            cell = np.ndarray(len(padded) - step + 1, f">u{step}", padded, strides=(1,))[chosen + at].astype(np.uint64)
            hashes = _mixed(hashes * np.uint64(0xD6E8FEB86659FD93) + cell)
        cuts = np.searchsorted(chosen, edges)
        for i in range(len(texts)):
            mine = hashes[cuts[i] : cuts[i + 1]]
            if len(mine) > 1:
                mine = mine[np.sort(np.unique(mine, return_index=True)[1])]
            out[i] = mine
    for i, t in enumerate(texts):
        if 0 < len(t) < width:
            out[i] = np.frombuffer(hashlib.sha256(t).digest()[:8], "<u8").astype(np.uint64)
    return out


class Digest(NamedTuple):
    """Filters of one level, a row of bits each, and how many features they hold."""

    width: int
    count: int
    bits: np.ndarray


def bloom_chain(width: int, hashes: np.ndarray) -> Digest:
    """A filter for each FILTER_FEATURES features, in their order."""
    chain = np.zeros((-(-len(hashes) // FILTER_FEATURES), FILTER_BITS), bool)
    row = np.arange(len(hashes)) // FILTER_FEATURES
    size = FILTER_BITS.bit_length() - 1
    for k in range(BITS_EACH):
        chain[row, (hashes >> np.uint64(k * size)).astype(np.int64) & FILTER_BITS - 1] = True
    return Digest(width, len(hashes), chain)


def digests(texts: list[str], ranks: dict[int, np.ndarray]) -> list[list[Digest]]:
    """The digests of each text, one for each level that its length is in; none if it is empty."""
    raw = [t.encode() for t in texts]
    out: list[list[Digest]] = [[] for _ in texts]
    for level in LEVELS:
        mine = [i for i, t in enumerate(texts) if t and level.from_chars <= len(t) < level.to_chars]
        if mine:
            for i, found in zip(mine, features([raw[i] for i in mine], level, ranks[level.width]), strict=True):
                out[i].append(bloom_chain(level.width, found))
    return out


def written(digest: list[Digest]) -> str:
    """Level, number of features and filters (base 64), for each level."""
    return ";".join(f"{d.width}:{d.count}:{base64.b64encode(np.packbits(d.bits)).decode()}" for d in digest)


def read(fingerprint: str) -> list[Digest]:
    out = []
    for part in filter(None, fingerprint.split(";")):
        width, count, bits = part.split(":")
        raw = np.unpackbits(np.frombuffer(base64.b64decode(bits), np.uint8)).reshape(-1, FILTER_BITS).astype(bool)
        out.append(Digest(int(width), int(count), raw))
    return out


def _chain_likeness(one: Digest, two: Digest) -> float:
    """For each filter the best overlap with one of the other chain, weighted by features. An overlap counts from what chance
    gives filters with as many bits (0) to all bits of the fuller one (1)."""
    a, b = one.bits.astype(np.float32), two.bits.astype(np.float32)
    na, nb = a.sum(1), b.sum(1)
    best_a, best_b = np.zeros(len(a), np.float32), np.zeros(len(b), np.float32)
    step = max(1, (1 << 20) // len(b))
    for at in range(0, len(a), step):
        some = na[at : at + step, None]
        chance = some * nb / FILTER_BITS
        full = np.maximum(some, nb)
        share = np.maximum(0, a[at : at + step] @ b.T - chance) / (full - chance)
        best_a[at : at + step] = share.max(1)
        best_b = np.maximum(best_b, share.max(0))

    def weights(d: Digest) -> np.ndarray:
        w = np.full(len(d.bits), FILTER_FEATURES, np.float64)
        w[-1] = d.count - FILTER_FEATURES * (len(d.bits) - 1)
        return w

    wa, wb = weights(one), weights(two)
    return float((best_a @ wa + best_b @ wb) / (wa.sum() + wb.sum()))


def likeness(one: list[Digest], two: list[Digest]) -> float:
    """0 to 1: 1 for equal digests, also of two empty texts; 0 if they share no level. Of several levels that they share each
    counts by its features. Time grows with the product of the two chains' numbers of filters."""
    if not one and not two:
        return 1.0
    other = {d.width: d for d in two}
    total = weight = 0.0
    for d in one:
        if (e := other.get(d.width)) is not None:
            total += (d.count + e.count) * _chain_likeness(d, e)
            weight += d.count + e.count
    return min(1.0, total / weight) if weight else 0.0


def edited_text(text: str, following: str) -> str:
    """The text with its last third replaced by as much of the following one's beginning."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def _blocks(batches: Iterator[pa.RecordBatch], column: str, weight: int) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    for batch in batches:
        values, start, size = [], 0, 0
        source = batch.column(column)
        for i in range(batch.num_rows):
            values.append(source[i].as_py())
            size += len(values[-1])
            if size >= weight or i == batch.num_rows - 1:
                yield batch.slice(start, i + 1 - start), values
                values, start, size = [], i + 1, 0


def entropy_ranks(docs: DataFrame, text_col: str = "text") -> dict[int, np.ndarray]:
    """Level's width -> rarity() of the entropies of all windows of all texts. The driver gets BINS + 1 counts for each level."""
    ship(docs.sparkSession)
    texts = docs.select(text_of(text_col).alias("_text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = {level.width: np.zeros(BINS + 1, np.int64) for level in LEVELS}
        for _, values in _blocks(batches, "_text", BLOCK_BYTES):
            for level in LEVELS:
                if mine := [t.encode() for t in values if level.from_chars <= len(t) < level.to_chars]:
                    totals[level.width] += entropy_counts(mine, level.width)
        for width, found in totals.items():
            at = np.flatnonzero(found)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), width), pa.int32()), pa.array(at, pa.int32()), pa.array(found[at])], names=["width", "bin", "n"])
        give_back()

    counts = {level.width: np.zeros(BINS + 1, np.int64) for level in LEVELS}
    for r in texts.mapInArrow(count, "width int, bin int, n long").groupBy("width", "bin").agg(F.sum("n").alias("n")).collect():
        counts[r["width"]][r["bin"]] = r["n"]
    return {width: rarity(found) for width, found in counts.items()}


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: <id_col>, fingerprint (string; equal for equal texts, empty for empty ones).

    All windows of 4, 16 or 32 bytes of a text (see LEVELS) are ranked by their entropy: the fewer windows of all texts have as much,
    the rarer. The rarest among neighbours are hashed into Bloom filters, the next one begun when one is full. likeness() compares
    what read() makes of two fingerprints. Null counts as empty; a text is held whole in one task; other columns are ignored.
    """
    ranks = docs.sparkSession.sparkContext.broadcast(entropy_ranks(docs, text_col))
    texts = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, values in _blocks(batches, "_text", BLOCK_BYTES):
            yield pa.RecordBatch.from_arrays([part.column("_id"), pa.array([written(d) for d in digests(values, ranks.value)], pa.string())], names=["_id", "fingerprint"])
        give_back()

    return texts.mapInArrow(run, f"_id {dict(texts.dtypes)['_id']}, fingerprint string").withColumnRenamed("_id", id_col)


def _ranges(texts: DataFrame, n: int) -> list[dict]:
    """The largest (_id, _hash) of at most n ranges of about as many rows, largest first. The driver gets only these."""
    keys = texts.select("_id", "_hash").repartitionByRange(n, F.col("_id").desc_nulls_last(), F.col("_hash").desc())
    tops = keys.groupBy(F.spark_partition_id().alias("p")).agg(F.max(F.struct("_id", "_hash")).alias("top"))
    return [r["top"].asDict() for r in sorted(tops.collect(), key=lambda r: r["p"])]


def neighbour_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: <id_col>, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    Each text is compared with the next one by descending identifier (the first one, for the last), and with its edited text: its last
    floor(n_chars / 3) code points replaced by the first as many of the next text, or by all of it if that has fewer.

    Texts are shuffled once, into ranges of identifiers that are sorted by Spark; each range also gets the first row of the range
    that follows, so that every row meets its next one in its own task.

    Defined cases: null counts as empty; null identifiers come last; rows that repeat an identifier are in the order of their texts'
    hashes; the only row of a table is its own next; other columns are ignored. A text and the one after it are held whole.
    """
    spark = docs.sparkSession
    n = partitions(spark)
    ranks = spark.sparkContext.broadcast(entropy_ranks(docs, text_col))
    texts = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text")).withColumn("_hash", F.xxhash64("_text"))
    id_type = dict(texts.dtypes)["_id"]
    tops = _ranges(texts, n)
    bounds = F.from_json(F.lit(json.dumps(tops)), f"array<struct<_id:{id_type},_hash:bigint>>")
    # The range of a row, found by halving, is the last one whose largest key is not below the row's.
    key = F.struct("_id", "_hash")
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(max(1, len(tops)).bit_length()))])

    def further(low: Column, step: Column) -> Column:
        return F.when((low + step < len(tops)) & (F.get(bounds, low + step) >= key), low + step).otherwise(low)

    placed = texts.withColumn("_range", F.aggregate(steps, F.lit(0), further))
    at = F.col("_range")
    homes = F.array(F.struct(at.alias("part"), F.lit(False).alias("guest")))
    guests = F.array(F.struct(F.pmod(at - 1, F.lit(max(1, len(tops)))).alias("part"), F.lit(True).alias("guest")))
    is_top = F.get(bounds, at).eqNullSafe(key)
    dealt = placed.select("_id", "_hash", "_text", F.explode(F.when(is_top, F.concat(homes, guests)).otherwise(homes)).alias("_at"))
    dealt = dealt.select("_id", "_hash", "_text", "_at.part", "_at.guest")
    ordered = dealt.repartitionById(max(1, len(tops)), F.col("part").cast("int"))
    ordered = ordered.sortWithinPartitions("guest", F.col("_id").desc_nulls_last(), F.col("_hash").desc())

    def compared(rows: list[tuple], found: list[list[Digest]], kind: pa.DataType) -> pa.RecordBatch:
        """All rows but the last one."""
        texts_ = [t for _, t in rows]
        edited = [edited_text(a, b) for a, b in zip(texts_, texts_[1:], strict=False)]
        edited_found = digests(edited, ranks.value)
        own = found[:-1]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([i for i, _ in rows[:-1]], kind),
                pa.array([len(t) for t in texts_[:-1]], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
                pa.array([written(d) for d in own], pa.string()),
                pa.array([written(d) for d in edited_found], pa.string()),
                pa.array([likeness(a, b) for a, b in zip(own, edited_found, strict=True)], pa.float64()),
                pa.array([likeness(a, b) for a, b in zip(own, found[1:], strict=True)], pa.float64()),
            ],
            names=["_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        found: list[list[Digest]] = []
        ended = False
        for part, values in _blocks(batches, "_text", BLOCK_BYTES):
            guests = part.column("guest").to_pylist()
            take = next((i + 1 for i, g in enumerate(guests) if g), len(guests))  # rows equal to a range's largest have a guest each
            if ended or not take:
                continue
            ended = guests[take - 1]
            rows += list(zip(part.column("_id").to_pylist(), values, strict=True))[:take]
            found += digests(values[:take], ranks.value)
            if len(rows) > 1:
                yield compared(rows, found, part.column("_id").type)
                rows, found = rows[-1:], found[-1:]
        give_back()

    made = ordered.select("_id", "_text", "guest").mapInArrow(
        run,
        f"_id {id_type}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
    )
    return made.withColumnRenamed("_id", id_col)
