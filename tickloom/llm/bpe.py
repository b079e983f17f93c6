"""Byte-level BPE: encoding by recursive DuckDB queries over distinct words, decoding by ordered aggregation."""

from __future__ import annotations

import base64
import heapq
import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shipping import ship
from .workers import give_back

#: Code points of texts that are split and encoded at once.
BLOCK_CHARS = 300_000
#: Rows of an Arrow batch, set for the session: a batch of texts is held as a whole, on both sides.
BATCH_ROWS = 1000
#: Words that a task remembers between blocks; beyond that it starts anew.
MAX_REMEMBERED = 200_000
#: Bytes of a word up to which it is encoded by the query. The query makes as many rounds as its longest
#: word has merges, over all of that word's tokens; longer words take the same merges from a heap.
LONG_WORD = 256
#: Texts of code points below this are split by an equivalent pattern of the faster module re.
_NEAR = 0x250

_WORDS = """
WITH RECURSIVE step AS (
  SELECT word, tokens, true AS live FROM words
  UNION ALL
  SELECT s.word,
         CASE WHEN best IS NULL THEN tokens
              ELSE list_concat(tokens[:(best & 65535) - 1], [best >> 16], tokens[(best & 65535) + 2:]) END,
         best IS NOT NULL
  FROM step s LEFT JOIN (
    SELECT word, min((rank << 16) + place) AS best
    FROM (SELECT word, place, tokens[place] * 16777216 + tokens[place + 1] AS pair
          FROM (SELECT word, tokens, unnest(range(1, len(tokens))) AS place FROM step WHERE live))
         JOIN merges USING (pair)
    GROUP BY word) b ON s.word = b.word
  WHERE live)
SELECT word, tokens FROM step WHERE NOT live ORDER BY word"""

_BYTES = """
SELECT text, string_agg(piece, '' ORDER BY place) AS bytes
FROM tokens JOIN vocabulary USING (token) GROUP BY text ORDER BY text"""


def parse_ranks(raw: bytes) -> dict[bytes, int]:
    """Token -> rank from the text of a .tiktoken file."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines()) if a}


def _near_pattern(pattern: str) -> re.Pattern:
    """The pattern for the module re, good for texts of code points below _NEAR.

    Its classes are spelled out from the characters' Unicode categories.
    """

    def members(test: Callable[[int], bool]) -> str:
        return "".join(rf"\u{i:04x}" for i in range(_NEAR) if test(i))

    kind = [unicodedata.category(chr(i))[0] for i in range(_NEAR)]
    spaces = members(lambda i: chr(i).isspace() and not 0x1C <= i <= 0x1F)  # White_Space
    letters, numbers = members(lambda i: kind[i] == "L"), members(lambda i: kind[i] == "N")
    for a, b in ((r"[^\s\p{L}\p{N}]", f"[^{spaces}{letters}{numbers}]"), (r"\p{L}", f"[{letters}]"), (r"\p{N}", f"[{numbers}]"), (r"\S", f"[^{spaces}]"), (r"\s", f"[{spaces}]")):
        pattern = pattern.replace(a, b)
    return re.compile(pattern)


def splitter(pattern: str) -> Callable[[str], list[str]]:
    import regex
    import public_tokenizers

    full = regex.compile(pattern).findall
    if pattern != public_tokenizers.PATTERN:
        return full
    near, far = _near_pattern(pattern).findall, re.compile(rf"[^\x00-\u{_NEAR - 1:04x}]").search
    return lambda text: full(text) if far(text) else near(text)


def merge_by_heap(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Contracts the leftmost pair of least rank until none is left, in n log n steps."""
    after = [*range(1, len(word)), -1]
    before = [-1, *range(len(word) - 1)]
    token: list[bytes | None] = [word[i : i + 1] for i in range(len(word))]
    heap: list[tuple[int, int, bytes]] = []

    def offer(i: int) -> None:
        if i >= 0 and after[i] >= 0 and (rank := ranks.get(both := token[i] + token[after[i]])) is not None:
            heapq.heappush(heap, (rank, i, both))

    for i in range(len(word)):
        offer(i)
    while heap:
        _, i, both = heapq.heappop(heap)
        if token[i] is None or after[i] < 0 or token[i] + token[after[i]] != both:
            continue  # one of the two has changed since
        gone = after[i]
        token[i], token[gone], after[i] = both, None, after[gone]
        if after[i] >= 0:
            before[after[i]] = i
        offer(before[i])
        offer(i)
    return [ranks[t] for t in token if t is not None]


class _Coder:
    """The tables of one vocabulary in a task, and the words that the task has seen."""

    def __init__(self, raw: bytes):
        import duckdb

        self.ranks = ranks = parse_ranks(raw)
        # A pair of tokens, and the rank of the two together, in one number: lists of tuples would stay in the heap.
        merges = np.fromiter(
            (ranks[t[:i]] << 44 | ranks[t[i:]] << 20 | rank for t, rank in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks),
            np.int64,
        )
        self.byte_ids = np.array([ranks[bytes([i])] for i in range(256)], dtype=np.int64)
        self.known = np.zeros(max(ranks.values()) + 1, bool)
        self.known[list(ranks.values())] = True
        self.db = duckdb.connect()
        self.db.execute("SET threads = 1")
        self.db.execute("SET memory_limit = '100MB'")
        self._table("merges", pair=pa.array(merges >> 20), rank=pa.array(merges & (1 << 20) - 1))
        # Bytes as the characters of the same number, since tokens need not be whole characters.
        self._table("vocabulary", token=pa.array(ranks.values(), pa.int64()), piece=pa.array([t.decode("latin-1") for t in ranks]))
        self.words: dict[str, bytes] = {}

    def _table(self, name: str, **columns: pa.Array) -> None:
        self.db.register("given", pa.table(columns))
        self.db.execute(f"CREATE OR REPLACE TABLE {name} AS SELECT * FROM given")
        self.db.unregister("given")

    def _lists(self, name: str, key: str, lengths: list[int], flat: np.ndarray) -> None:
        lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *lengths]).astype(np.int32)), pa.array(flat))
        self._table(name, **{key: pa.array(range(len(lengths)), pa.int32()), "tokens": lists})

    def learn_words(self, words: Iterable[str]) -> None:
        hard: list[tuple[str, bytes]] = []
        for word in words:
            raw = word.encode()
            if (rank := self.ranks.get(raw)) is not None:
                self.words[word] = rank.to_bytes(4, "little")
            elif len(raw) > LONG_WORD:
                self.words[word] = np.array(merge_by_heap(raw, self.ranks), "<u4").tobytes()
            else:
                hard.append((word, raw))
        hard.sort(key=lambda x: len(x[1]))
        for at in range(0, len(hard), 25_000):
            part = hard[at : at + 25_000]
            flat = self.byte_ids[np.frombuffer(b"".join(r for _, r in part), np.uint8)]
            self._lists("words", "word", [len(r) for _, r in part], flat)
            tokens = self.db.sql(_WORDS).to_arrow_table().column("tokens").combine_chunks()
            ids, ends = tokens.flatten().to_numpy().astype("<u4").tobytes(), tokens.offsets.to_numpy() * 4
            ends = ends - ends[0]
            for i, (word, _) in enumerate(part):
                self.words[word] = ids[ends[i] : ends[i + 1]]

    def close(self) -> None:
        self.db.close()
        self.words.clear()

    def encode(self, texts: list[str], split: Callable[[str], list[str]]) -> list[bytes]:
        parts = [split(t) for t in texts]
        if len(self.words) > MAX_REMEMBERED:
            self.words.clear()
        self.learn_words(set(chain.from_iterable(parts)).difference(self.words))
        known = self.words.__getitem__
        return [b"".join(map(known, p)) for p in parts]

    def decode(self, coded: list[bytes]) -> list[bytes]:
        """The token-position rows of a block's texts join the vocabulary; the pieces are put together in order."""
        ids = np.frombuffer(b"".join(coded), "<u4").astype(np.int64)
        lengths = np.array([len(c) // 4 for c in coded])
        if len(ids) and (ids.max() >= len(self.known) or not self.known[ids].all()):
            raise ValueError("the vocabulary lacks a token of these numbers")
        self._table("tokens", text=pa.array(np.repeat(np.arange(len(coded)), lengths)), place=pa.array(np.arange(len(ids))), token=pa.array(ids))
        found = self.db.sql(_BYTES).to_arrow_table()
        out = [b""] * len(coded)
        for text, piece in zip(found.column("text").to_pylist(), found.column("bytes").to_pylist(), strict=True):
            out[text] = piece.encode("latin-1")
        return out


def _blocks(column: pa.Array, weight: int) -> Iterator[tuple[int, list]]:
    """The column's values in blocks, each with its first row's number."""
    block, start, size = [], 0, 0
    for i in range(len(column)):
        value = column[i].as_py()
        block.append(value)
        size += len(value)
        if size >= weight:
            yield start, block
            block, start, size = [], i + 1, 0
    if block:
        yield start, block


def _map_column(frame: DataFrame, source: str, targets: list[str], work: Callable) -> DataFrame:
    """Replaces the text or binary column source by binary columns, a block of rows at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, step = work()
        try:
            for batch in batches:
                at = batch.schema.get_field_index(source)
                rest = [i for i in range(batch.num_columns) if i != at]
                names = [*(batch.schema.names[i] for i in rest), *targets]
                for start, values in _blocks(batch.column(at), BLOCK_CHARS):
                    made = [pa.array(c, pa.binary()) for c in step(values)]
                    kept = [batch.column(i).slice(start, len(values)) for i in rest]
                    yield pa.RecordBatch.from_arrays([*kept, *made], names=names)
        finally:
            coder.close()
            del coder, step
            give_back()

    ship(frame.sparkSession)
    frame.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    kinds = [f"`{c}` {t}" for c, t in frame.dtypes if c != source]
    return frame.mapInArrow(run, ", ".join([*kinds, *[f"`{t}` binary" for t in targets]]))


def bpe_encode(
    docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", decode: bool = False
) -> DataFrame:
    """One row per input row: <id_col>, n_tokens, ids (32-bit little-endian numbers, as binary), and if `decode` is set
    decoded, the bytes that the ids give back, as bpe_decode() finds them, in the same task.

    Each match of the pattern is a word of its own. In each partition, a block's distinct words that the
    task has not seen before go through one recursive query: the adjacent tokens of each word join the
    merge table, the leftmost pair of least rank is contracted, until no word has a pair left.

    The vocabulary, read from ranks_path by the driver, is broadcast; its size is fixed.

    Defined cases: null and empty texts have no tokens; rows that repeat an identifier give a row each;
    other columns are ignored.
    """
    with open(ranks_path, "rb") as file:
        raw = docs.sparkSession.sparkContext.broadcast(file.read())

    def work():
        coder, split = _Coder(raw.value), splitter(pattern)

        def step(texts: list[str]) -> list[list[bytes]]:
            ids = coder.encode(texts, split)
            return [ids, coder.decode(ids)] if decode else [ids]

        return coder, step

    texts = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    more = ["decoded"] if decode else []
    coded = _map_column(texts, "_text", ["ids", *more], work)
    return coded.select(F.col("_id").alias(id_col), (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids", *more)


def bpe_decode(coded: DataFrame, ranks_path: str, ids_col: str = "ids", target: str = "decoded") -> DataFrame:
    """Replaces a column of ids (as bpe_encode gives them; null: empty) by the bytes they stand for.

    Fails on numbers that the vocabulary does not have.
    """
    with open(ranks_path, "rb") as file:
        raw = coded.sparkSession.sparkContext.broadcast(file.read())

    def work():
        coder = _Coder(raw.value)
        return coder, lambda ids: [coder.decode(ids)]

    return _map_column(coded.withColumn(ids_col, F.coalesce(ids_col, F.lit(b""))), ids_col, [target], work)
