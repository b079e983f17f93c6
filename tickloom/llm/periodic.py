"""Periodic runs of words: maximal pairs from a bottom-up LCP-interval tree."""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shipping import ship
from .textops import text_of
from .workers import give_back

#: Words whose suffixes are sorted together; a longer text is a block of its own.
BLOCK_WORDS = 200_000

Run = tuple[int, int, int]


def suffix_order(symbols: np.ndarray) -> tuple[np.ndarray, dict[int, np.ndarray]]:
    """The order of the suffixes, by prefix doubling over those that are not told apart yet, and width -> group of the string
    of so many symbols at each place (equal strings share a group). Repeated strings must not reach the array's end."""
    order = np.argsort(symbols, kind="stable")
    ordered = symbols[order]
    first = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    group = np.empty(len(symbols), np.int64)
    group[order] = np.maximum.accumulate(np.where(first, np.arange(len(symbols)), 0))
    width, groups = 1, {1: group}
    while True:
        alone = first & np.append(first[1:], True)
        slots = np.flatnonzero(~alone)
        if not len(slots):
            return order, groups
        open_ = order[slots]
        mine, follows = group[open_], group[open_ + width]
        again = np.lexsort((follows, mine))
        open_, mine, follows = open_[again], mine[again], follows[again]
        order[slots] = open_
        new = np.concatenate([[True], (mine[1:] != mine[:-1]) | (follows[1:] != follows[:-1])])
        first[slots] = new
        group = group.copy()
        group[open_] = slots[np.maximum.accumulate(np.where(new, np.arange(len(slots)), 0))]
        width *= 2
        groups[width] = group


def common_prefixes(order: np.ndarray, groups: dict[int, np.ndarray], least: int) -> tuple[np.ndarray, np.ndarray]:
    """Where neighbours in suffix order share `least` symbols or more, as indices of the second of the two, and how many."""
    at = np.arange(1, len(order))
    if enough := [w for w in groups if w <= least]:
        whole = groups[max(enough)]
        at = at[whole[order[at - 1]] == whole[order[at]]]
    a, b, common = order[at - 1], order[at], np.zeros(len(at), np.int64)
    for width in sorted(groups, reverse=True):
        inside = np.flatnonzero(b + common < len(order))
        inside = inside[a[inside] + common[inside] < len(order)]
        same = inside[groups[width][a[inside] + common[inside]] == groups[width][b[inside] + common[inside]]]
        common[same] += width
    long = common >= least
    return at[long], common[long]


def _meet(one: list[int], two: list[int], lcp: int, left: np.ndarray, reach: int, found: list[Run]) -> list[int]:
    """Reports the maximal pairs between two children of an interval, and gives their places in one list.

    Places that an interval has within `lcp // reach` of each other overlap in most of the common string, so that they lie in one
    periodic stretch, a whole number of periods apart: all but the first have the same word on their left. So for each place of the
    smaller list, the first place of the other within reach before it, and the next one after it, are the only
    ones whose left-word classes need be compared.
    """
    small, large = (one, two) if len(one) < len(two) else (two, one)
    far = lcp // reach
    for place in small:
        at = bisect_left(large, place - far)
        if at < len(large) and large[at] < place and left[large[at]] != left[place]:
            found.append((large[at], place, lcp))
        at = bisect_right(large, place)
        if at < len(large) and large[at] <= place + far and left[large[at]] != left[place]:
            found.append((place, large[at], lcp))
    for place in small:
        insort(large, place)
    return large


def maximal_pairs(places: list[int], lcps: list[int], left: np.ndarray, reach: int) -> list[Run]:
    """(place, later place, common length) of the pairs at most length / reach apart that can be extended neither to the left nor to
    the right; of those of one stretch at least that of its smallest period. `places` are neighbours in suffix order, lcps[i] is what
    i and i + 1 share; the tree's intervals are closed from the leaves up, each child's list going into its parent's."""
    found: list[Run] = []
    open_: list[tuple[int, list[int]]] = []
    for place, lcp in zip(places, [*lcps, -1], strict=True):
        mine = [place]
        while open_ and open_[-1][0] >= lcp:
            mine = _meet(open_[-1][1], mine, open_[-1][0], left, reach, found)
            if open_.pop()[0] == lcp:
                break
        if lcp >= 0:
            open_.append((lcp, mine))
    return found


def runs_of(symbols: np.ndarray, least_length: int, least_exponent: int) -> list[Run]:
    """(start, length, period) of all runs, by start. Symbols that stand once separate texts: one is first, one is last."""
    reach = least_exponent - 1
    least = min(max(least_length - q, reach * q) for q in range(1, least_length + 1))
    order, groups = suffix_order(symbols)
    at, common = common_prefixes(order, groups, least)
    if not len(at):
        return []
    left = np.concatenate([[-1], symbols[:-1]])
    pairs: list[Run] = []
    cuts = np.flatnonzero(np.diff(at) > 1) + 1
    for block, lcps in zip(np.split(at, cuts), np.split(common, cuts), strict=True):
        places = order[block[0] - 1 : block[-1] + 1]
        # Strings that repeat only further apart than they are long are in no run.
        near = np.sort(places)
        if (np.diff(near) <= lcps.max() // reach).any():
            pairs += maximal_pairs(places.tolist(), lcps.tolist(), left, reach)
    smallest: dict[tuple[int, int], int] = {}
    for first, second, lcp in pairs:
        stretch, period = (first, second + lcp), second - first
        if second + lcp - first >= max(least_length, least_exponent * period) and period < smallest.get(stretch, 1 << 62):
            smallest[stretch] = period
    return sorted((start, end - start, period) for (start, end), period in smallest.items())


def _block_runs(texts: list[list[bytes]], least_length: int, least_exponent: int) -> list[list[Run]]:
    """The runs of each text. All texts' words go through one suffix sort; a text's words differ from any other's."""
    symbols, begins, free = [np.zeros(1, np.int64)], [], 1
    at = 1
    for words in texts:
        known: dict[bytes, int] = {}
        own = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
        symbols += [own + free, np.array([free + len(known)])]
        free += len(known) + 1
        begins.append(at)
        at += len(words) + 1
    out: list[list[Run]] = [[] for _ in texts]
    starts = np.array(begins)
    for start, length, period in runs_of(np.concatenate(symbols), least_length, least_exponent):
        text = int(np.searchsorted(starts, start, "right")) - 1
        out[text].append((start - begins[text], length, period))
    return out


def _collapsed(words: list[bytes], runs: list[Run]) -> bytes:
    """The words without those that any run contains after its first period, joined by single spaces."""
    if not runs:
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0)])


def with_planted_periods(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col and text_col, with about one text in ten made periodic: with h the CRC-32 of the decimal identifier and g = floor(h / 10),
    if h % 10 = 0 and the text has n > 0 words, each word i >= a = g % n becomes word a + (i - a) % p of the original, where
    p = 1 + floor((n - a) / (3 + g % 8)). Other texts, and those without an identifier, stay as they are."""
    words = F.array_remove(F.split(text_of(text_col), r"[\x20\x09-\x0D]+"), "")
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    planted = docs.select(F.col(id_col), text_of(text_col).alias(text_col), h.alias("_h")).withColumn("_words", F.when(F.col("_h") % 10 == 0, words))
    g, n = F.floor(F.col("_h") / 10), F.size("_words")
    a = g % n
    p = 1 + F.floor((n - a) / (3 + g % 8))
    changed = F.transform("_words", lambda w, i: F.when(i < a, w).otherwise(F.get("_words", (a + (i - a) % p).cast("int"))))
    text = F.when(F.coalesce(F.size("_words") > 0, F.lit(False)), F.array_join(changed, " ")).otherwise(F.col(text_col))
    return planted.select(id_col, text.alias(text_col))


def periodic_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = 6, least_exponent: int = 4
) -> DataFrame:
    """One row per input row: <id_col>, n_words, runs (array of start, length, period, by start, in words from 0), collapsed (the words
    that no run contains after its first period, joined by single spaces).

    Words are `[^\\x20\\x09-\\x0D]+` of the whole text; null counts as empty. A run is a stretch of words whose smallest period q it
    holds least_exponent (at least 3) times or more, at least least_length words long, that no neighbouring word extends.

    A run of period q is a maximal pair: its words from the start on, and those q later, have all but q words in common, and differ
    before and behind. The pairs come from the LCP-interval tree of each text's suffixes, built from the leaves up over the
    suffixes whose neighbours share enough words; each interval has its places in a sorted list, with their left words, and the
    smaller of two lists is looked up in the larger one, within the distance that the common length allows. A multiple of the
    smallest period gives the same stretch again and is dropped. This takes n log n steps also for a text of one repeated word.

    Defined cases: texts with less than least_length words have no run; rows that repeat an identifier give a row each; null
    identifiers are kept; other columns are ignored. A text, and its suffix order (8 bytes a word for each doubling of the longest
    repeat), is held whole in one task.
    """
    if least_length < 2 or least_exponent < 3:
        raise ValueError("least_length is at least 2, least_exponent at least 3")
    ship(docs.sparkSession)
    texts = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text"))
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column, block, words = batch.column("_text"), [], 0
            for i in range(batch.num_rows):
                block.append(column[i].as_buffer().to_pybytes().split() if len(column[i].as_buffer()) else [])
                words += len(block[-1])
                if words >= BLOCK_WORDS or i == batch.num_rows - 1:
                    runs = _block_runs(block, least_length, least_exponent)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("_id").slice(i + 1 - len(block), len(block)),
                            pa.array([len(w) for w in block], pa.int64()),
                            pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in rs] for rs in runs], kind),
                            pa.array([_collapsed(w, r).decode() for w, r in zip(block, runs, strict=True)], pa.string()),
                        ],
                        names=["_id", "n_words", "runs", "collapsed"],
                    )
                    block, words = [], 0
        give_back()

    id_type = dict(texts.dtypes)["_id"]
    made = texts.mapInArrow(
        run, f"_id {id_type}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    )
    return made.withColumnRenamed("_id", id_col)
