"""Collocated phrases from a weighted de Bruijn graph of the longest grams."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..shipping import ship
from .textops import checkpointed, partitions, shared_dir, text_of
from .workers import give_back

#: Bytes of texts that are cut into words at once; a longer text is cut alone.
BLOCK_BYTES = 1 << 20
#: Words that a task gathers before it adds up their grams.
GATHERED_WORDS = 1 << 19
#: Bytes of a word up to which its number holds the word itself; longer words are numbered by 63 bits of hash.
SHORT_BYTES = 7
#: Stands where a piece has ended.
END = 0
#: Documents of the sample that finds nodes too frequent for one partition.
SAMPLE_DOCS = 1000
#: Parts into which the edges of such a node are dealt, by their last word.
HOT_PARTS = 64
#: Parts of a language's candidates that are ranked apart before the best of each are ranked together.
RANK_PARTS = 64
BREAKS, SPACES = b".,;:!?\n\x0b\x0c\r", b" \t"

_KIND = np.zeros(256, np.uint8)
_KIND[list(SPACES)], _KIND[list(BREAKS)] = 1, 2
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def word_numbers(text: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the words of lower-cased bytes that end in a break: start, length, number of the piece, and number of the word (64 bits;
    positive ones hold length and bytes, negative ones are hashes)."""
    kind = _KIND[text]
    edge = np.diff(np.concatenate([[1], (kind > 0).view(np.int8)]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    lengths = ends - starts
    piece = np.cumsum(kind == 2, dtype=np.int32)[starts]
    cells = np.ndarray(len(text), ">u8", np.concatenate([text, np.zeros(8, np.uint8)]), strides=(1,))
    head = cells[starts].astype(np.uint64) >> (8 * (8 - np.minimum(lengths, 8))).astype(np.uint64)
    number = head | lengths.astype(np.uint64) << np.uint64(56)
    long = np.flatnonzero(lengths > SHORT_BYTES)
    hashes = _mixed(lengths[long].astype(np.uint64) + np.uint64(seed * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
    left, at = np.arange(len(long)), 0
    while len(left):
        rest = lengths[long[left]] - at
        cell = cells[starts[long[left]] + at].astype(np.uint64) >> (8 * (8 - np.minimum(rest, 8))).astype(np.uint64)
        hashes[left] = _mixed(hashes[left] * np.uint64(0xD6E8FEB86659FD93) + cell)
        left, at = left[rest > 8], at + 8
    number[long] = hashes | np.uint64(1 << 63)
    return starts, lengths, piece, number.view(np.int64)


def added_up(lang: np.ndarray, number: np.ndarray, left: np.ndarray, size: int, begin: int = 0, end: int | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct grams of `size` words that begin at the words [begin, end), as columns of languages and words, END where fewer
    words are left in the piece; and how often each is there. A gram is packed into 64 bits by numbering the words."""
    end = len(number) if end is None else end
    codes, words = pd.factorize(number[begin : end + size - 1])
    bits, lang_bits = len(words).bit_length(), int(lang.max()).bit_length()
    if size * bits + lang_bits > 64:  # halves have fewer words
        middle = (begin + end) // 2
        parts = [added_up(lang, number, left, size, a, b) for a, b in ((begin, middle), (middle, end))]
        return [np.concatenate(x) for x in zip(*(p[0] for p in parts), strict=True)], np.concatenate([p[1] for p in parts])
    key = lang[begin:end].astype(np.uint64)
    codes = np.concatenate([codes + 1, np.zeros(size, codes.dtype)]).astype(np.uint64)
    for k in range(size):
        key = key << np.uint64(bits) | np.where(left[begin:end] > k, codes[k : k + end - begin], np.uint64(0))
    key.sort()
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    times, key, out = np.diff(np.append(first, len(key))), key[first], []
    words = np.concatenate([[END], words])
    for _ in range(size):
        out.append(words[(key & np.uint64((1 << bits) - 1)).astype(np.int64)])
        key = key >> np.uint64(bits)
    return [key.astype(np.int64), *out[::-1]], times


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[bytes], list[str]]]:
    for batch in batches:
        source, langs = batch.column("text"), batch.column("lang").to_pylist()
        block, start, size = [], 0, 0
        for i in range(batch.num_rows):
            block.append(source[i].as_buffer().to_pybytes().lower() + b"\n")
            size += len(block[-1])
            if size >= BLOCK_BYTES or i == batch.num_rows - 1:
                yield block, langs[start : i + 1]
                block, start, size = [], i + 1, 0


def _edges(texts: DataFrame, max_words: int, seed: int) -> DataFrame:
    """lang, w1 ... (numbers of words, END where the piece has ended), n: each word of each text begins one of these grams."""
    names = [f"w{k + 1}" for k in range(max_words)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        parts: list[tuple[np.ndarray, ...]] = []
        gathered = 0

        def summed() -> pa.RecordBatch:
            columns, times = added_up(*[np.concatenate(c) for c in zip(*parts, strict=True)], max_words)
            parts.clear()
            lang = pa.array(list(known), pa.string()).take(pa.array(columns[0]))
            return pa.RecordBatch.from_arrays([lang, *map(pa.array, columns[1:]), pa.array(times)], names=["lang", *names, "n"])

        for block, langs in _blocks(batches):
            starts, _, piece, number = word_numbers(np.frombuffer(b"".join(block), np.uint8), seed)
            if not len(number):
                continue
            code = np.array([known.setdefault(x, len(known)) for x in langs], np.int32)
            of_text = np.searchsorted(np.cumsum([len(t) for t in block]), starts, "right")
            left = np.ones(len(number), np.int8)  # words of the piece from here on, as far as they count
            for k in range(1, min(max_words, len(number))):
                left[:-k] += piece[k:] == piece[:-k]
            parts.append((code[of_text], number, left))
            gathered += len(number)
            if gathered >= GATHERED_WORDS:
                yield summed()
                gathered = 0
        if parts:
            yield summed()
        give_back()

    return texts.mapInArrow(run, ", ".join(["lang string", *[f"{c} long" for c in names], "n long"]))


def _long_words(texts: DataFrame, seed: int) -> DataFrame:
    """number, word: the long words of each block, also different ones that share a number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, _ in _blocks(batches):
            raw = b"".join(block)
            text = np.frombuffer(raw, np.uint8)
            starts, lengths, _, number = word_numbers(text, seed)
            long = np.flatnonzero(number < 0)
            starts, lengths, number, other = starts[long], lengths[long], number[long], word_numbers(text, seed + 1)[3][long]
            _, first, which = np.unique(number, return_index=True, return_inverse=True)
            first = np.concatenate([first, np.flatnonzero(other != other[first][which])])
            words = [raw[a : a + b].decode() for a, b in zip(starts[first].tolist(), lengths[first].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(number[first]), pa.array(words, pa.string())], names=["number", "word"])
        give_back()

    return texts.mapInArrow(run, "number long, word string")


def _hot_nodes(texts: DataFrame, node: list[str], max_words: int, seed: int) -> list[tuple]:
    """The nodes that a sample of about SAMPLE_DOCS documents shows to fill half a partition with edges: at most two a partition."""
    rows = texts.count()
    sample = _edges(texts.sample(fraction=min(1.0, SAMPLE_DOCS / max(rows, 1)), seed=17), max_words, seed)
    found = sample.groupBy(*node).agg(F.count(F.lit(1)).alias("rows"))
    total = found.agg(F.sum("rows")).first()[0] or 0
    least = max(64.0, total / (2 * partitions(texts.sparkSession)))
    return [tuple(r[c] for c in node) for r in found.filter(F.col("rows") >= least).collect()]


def _flows(max_words: int, least: int):
    """For edges sorted by w1, lang and the other words: adds up equal ones, and what flows out of nodes. Gives lang, words, f, edges:
    the grams and nodes that occur `least` times or more, the parts of hot nodes, and for the shorter phrases what flows out of each
    stretch of rows. A node that a batch leaves open is held back, with its edges added up."""
    names = [f"w{k + 1}" for k in range(max_words)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        held: list[np.ndarray] = []
        waiting: list[list[np.ndarray]] = []
        rows = 0

        def worked_off(last: bool) -> pa.RecordBatch:
            nonlocal held
            parts = [held, *waiting] if held else waiting
            lang, *words, times, part = (np.concatenate(c) for c in zip(*parts, strict=True))
            waiting.clear()
            new = np.concatenate([[True], (lang[1:] != lang[:-1]) | (words[0][1:] != words[0][:-1])])
            levels = [new]  # where a phrase of one word, of two words ... begins
            for w in words[1:]:
                new = new.copy()
                new[1:] |= w[1:] != w[:-1]
                levels.append(new)
            grams = np.flatnonzero(levels[-1])
            f, part = np.add.reduceat(times, grams), np.maximum.reduceat(part, grams)
            lang, words, levels = lang[grams], [w[grams] for w in words], [level[grams] for level in levels[:-1]]
            held = []
            if not last:
                cut = np.flatnonzero(levels[-1])[-1]
                held = [x[cut:] for x in (lang, *words, f, part)]
                lang, words, f, part, levels = lang[:cut], [w[:cut] for w in words], f[:cut], part[:cut], [level[:cut] for level in levels]
            out = []

            def give(at: np.ndarray, size: int, f: np.ndarray, edges: np.ndarray) -> None:
                blank = np.full(len(at), END, np.int64)
                out.append([lang[at], *[w[at] for w in words[:size]], *[blank] * (max_words - size), f, edges])

            if len(f):
                heavy = np.flatnonzero((f >= least) & (words[-1] != END))
                give(heavy, max_words, f[heavy], np.ones(len(heavy), np.int64))
                for size in range(1, max_words):
                    at = np.flatnonzero(levels[size - 1])
                    flow, edges = np.add.reduceat(f, at), np.diff(np.append(at, len(f)))
                    ok = words[size - 1][at] != END
                    if size == max_words - 1:
                        ok &= (flow >= least) | (np.maximum.reduceat(part, at) >= 0)
                    give(at[ok], size, flow[ok], edges[ok])
            columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * (max_words + 3)
            langs = pa.array(list(known), pa.string()).take(pa.array(columns[0]))
            return pa.RecordBatch.from_arrays([langs, *map(pa.array, columns[1:])], names=["lang", *names, "f", "edges"])

        for batch in batches:
            named = batch.column("lang").dictionary_encode()
            code = np.array([known.setdefault(x, len(known)) for x in named.dictionary.to_pylist()], np.int64)
            waiting.append([code[named.indices.to_numpy()], *[batch.column(c).to_numpy() for c in (*names, "n", "part")]])
            rows += batch.num_rows
            if rows >= GATHERED_WORDS >> 2:
                yield worked_off(False)
                rows = 0
        if waiting or held:
            yield worked_off(True)
        give_back()

    return run


def _gram_counts(texts: DataFrame, max_words: int, least: int, seed: int) -> DataFrame:
    """lang, words (array of numbers), f, edges (by which nodes that begin with the words are left, END included): all words, and the
    phrases of 2 to max_words words that occur `least` times or more.

    Only the longest grams are counted in the texts. They are the edges of a graph, from the node of their first words to that of
    their last ones; a phrase of fewer words occurs as often as flows out of it, where the edges into END stand for the pieces that
    end with it.
    """
    names = [f"w{k + 1}" for k in range(max_words)]
    node, last = ["lang", *names[:-1]], names[-1]
    edges = _edges(texts, max_words, seed)
    hot = _hot_nodes(texts, node, max_words, seed)
    if hot:
        kinds = ", ".join(["lang string", *[f"{c} long" for c in names[:-1]], "hot boolean"])
        known = texts.sparkSession.createDataFrame([(*h, True) for h in hot], kinds)
        edges = edges.join(F.broadcast(known), node, "left")  # at most 2 rows a partition
        edges = edges.withColumn("part", F.when(F.col("hot"), F.pmod(F.xxhash64(last), F.lit(HOT_PARTS))).otherwise(-1))
        place = [*node, "part"]
    else:
        edges, place = edges.withColumn("part", F.lit(-1).cast("long")), node
    # A node's edges are in one partition, or a hot one's in parts, so that this is the only shuffle of the edges.
    dealt = edges.select("lang", *names, "n", "part").repartition(*place).sortWithinPartitions("w1", "lang", *names[1:])
    flows = dealt.mapInArrow(_flows(max_words, least), ", ".join(["lang string", *[f"{c} long" for c in names], "f long", "edges long"]))
    found = flows.groupBy("lang", *names).agg(F.sum("f").alias("f"), F.sum("edges").alias("edges"))
    found = found.filter((F.col("f") >= least) | (F.col(names[1]) == END))
    return found.select("lang", F.filter(F.array(*names), lambda w: w != END).alias("words"), "f", "edges")


def _paths(edges: DataFrame, nodes: DataFrame, n: int) -> DataFrame:
    """lang, words (of the whole path), f: the paths of edges (n words) that only unary nodes (n - 1 words) join, each with the count
    that all its edges and inner nodes have. A node is unary if all that flows through it comes by one edge and leaves by one.

    Each edge behind a unary node points to the edge before it; pointers are doubled until they reach the path's first edge, in as
    many rounds as the number of edges of the longest path has binary digits. All paths have a first edge: pieces begin somewhere,
    and a node at which one begins is not unary.
    """
    flow = nodes.filter("edges = 1").select("lang", F.col("words").alias("node"), F.col("f").alias("through"))
    ends = edges.select("lang", "words", "f", F.slice("words", 1, n - 1).alias("source"), F.slice("words", 2, n - 1).alias("target"))
    ends = checkpointed(ends.withColumn("e", F.monotonically_increasing_id()))
    into = ends.select("lang", F.col("target").alias("node"), F.col("e").alias("before"), F.col("f").alias("f_in"))
    out = ends.select("lang", F.col("source").alias("node"), "e")
    unary = into.join(flow, ["lang", "node"]).filter("f_in = through").join(out, ["lang", "node"])
    open_ = checkpointed(unary.select("e", F.col("before").alias("head"), F.lit(1).cast("long").alias("steps")))
    first = ends.join(open_, "e", "left_anti").select("e", F.col("e").alias("head"), F.lit(0).cast("long").alias("steps"))
    first = done = checkpointed(first)
    begun = first.select(F.col("e").alias("head"))
    while not open_.isEmpty():
        ahead = open_.select(F.col("e").alias("head"), F.col("head").alias("further"), F.col("steps").alias("more"))
        arrived = open_.join(begun, "head", "left_semi").select("e", "head", "steps")
        # Those that have not arrived point to an edge that is open too, or was, and then has arrived.
        known = ahead.unionByName(done.filter("steps > 0").select(F.col("e").alias("head"), F.col("head").alias("further"), F.col("steps").alias("more")))
        going = open_.join(known, "head").select("e", F.col("further").alias("head"), (F.col("steps") + F.col("more")).alias("steps"))
        done, open_ = checkpointed(done.unionByName(arrived)), checkpointed(going)
    placed = done.join(ends, "e")
    begin = F.max(F.when(F.col("steps") == 0, F.col("source")))
    rest = F.transform(F.array_sort(F.collect_list(F.struct("steps", F.element_at("words", n).alias("w")))), lambda x: x["w"])
    return placed.groupBy("head").agg(F.first("lang").alias("lang"), F.concat(begin, rest).alias("words"), F.first("f").alias("f")).drop("head")


def _windows(size: int, skipped: int = 0) -> Column:
    """The stretches of `size` words of a path, without as many at each end."""
    starts = F.sequence(F.lit(1 + skipped), F.size("words") - size + 1 - skipped)
    some = F.size("words") - size + 1 - 2 * skipped > 0
    return F.explode(F.when(some, F.transform(starts, lambda i: F.slice("words", i, size))))


def _spelled(phrases: DataFrame, names: DataFrame) -> DataFrame:
    """lang, words, phrase: the numbers as words, joined by spaces."""
    rows = phrases.select("lang", "words", F.posexplode("words").alias("at", "number")).join(names, "number", "left")
    held = F.decode(F.unhex(F.expr("right(lpad(hex(number), 16, '0'), CAST(2 * shiftright(number, 56) AS INT))")), "UTF-8")
    rows = rows.withColumn("word", F.when(F.col("number") > 0, held).otherwise(F.col("word")))
    ordered = F.array_sort(F.collect_list(F.struct("at", "word")))
    return rows.groupBy("lang", "words").agg(F.array_join(F.transform(ordered, lambda x: x["word"]), " ").alias("phrase"))


def collocations(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_words: int = 3, least: int = 10, share: int = 50, best: int = 2000
) -> DataFrame:
    """lang, rank (from 1), phrase, a, l, r, n, score: the `best` phrases of 2 to max_words (at least 3) words of each language.

    Texts (A-Z lower-cased, null: empty) are split at `[.,;:!?\\x0A-\\x0D]` into pieces, and those into words `[^\\x20\\x09]+`. Everything
    is counted for each lang (null: `und`): n all words, f(phrase) all its places in pieces, overlaps included. Candidates are the
    phrases with a = f(phrase) >= least. Of the cuts of a candidate after its first k words, with l = f(first part) and r = f(rest),
    that of the lowest score floor(1000000 a a / (l r)) counts, of equal ones that of the smallest k. A candidate goes whose words
    lie together in a longer one with 100 f(longer) >= share a. Order: score and a descending, phrase ascending in UTF-8.

    The longest grams are edges of a weighted de Bruijn graph between nodes of one word less. Only they are counted in the texts;
    shorter counts are flows of nodes (see _gram_counts()). The edges and nodes that are frequent enough are compacted into paths (see
    _paths()): a path's stretches are the longest candidates; its inner nodes have a path's own count, so that they go, and the
    other nodes stay to be looked at.

    A word is a number of 64 bits: one of up to SHORT_BYTES bytes is held in it whole, a longer one is a hash. Should two words of
    frequent phrases share a number, which the dictionary of long words shows, all is counted anew with another hash.

    Defined cases: an empty table gives no rows; equal rows all count; identifiers and other columns are ignored. Tasks hold some MB
    of texts at a time, or one longer text, in about 60 bytes a byte.
    """
    if max_words < 3:
        raise ValueError("max_words is at least 3")
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(text_of(text_col).alias("text"), F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"))
    folder = f"{shared_dir(spark)}/phrases-{uuid.uuid4()}"

    def saved(frame: DataFrame, name: str, *parts: str) -> DataFrame:
        frame.write.partitionBy(*parts).parquet(f"{folder}/{name}")
        return spark.read.schema(frame.schema).parquet(f"{folder}/{name}")

    size = F.size("words")
    for seed in count():
        found = _gram_counts(texts, max_words, least, seed).withColumn("frequent", (F.col("f") >= least).cast("int"))
        every = saved(found, f"counts-{seed}", "frequent")
        counts = every.filter("frequent = 1").drop("frequent")
        long = counts.select(F.explode("words").alias("number")).filter("number < 0").distinct()
        names = saved(_long_words(texts, seed).join(long, "number", "left_semi").distinct(), f"names-{seed}")
        if names.groupBy("number").count().filter("count > 1").isEmpty():
            break
    totals = every.filter(size == 1).groupBy("lang").agg(F.sum("f").alias("n"))
    nodes = counts.filter(size == max_words - 1)
    paths = checkpointed(_paths(counts.filter(size == max_words), nodes, max_words))
    inner = paths.select("lang", _windows(max_words - 1, 1).alias("words"))
    candidates = (
        paths.select("lang", _windows(max_words).alias("words"), F.col("f").alias("a"))
        .unionByName(nodes.join(inner, ["lang", "words"], "left_anti").select("lang", "words", F.col("f").alias("a")))
        .unionByName(counts.filter((size > 1) & (size < max_words - 1)).select("lang", "words", F.col("f").alias("a")))
    )
    parts = F.array(F.slice("words", F.lit(1), size - 1), F.slice("words", F.lit(2), size - 1))
    longer = counts.filter(size > 2).select("lang", F.explode(parts).alias("words"), "f").groupBy("lang", "words").agg(F.max("f").alias("longer"))
    left = candidates.join(longer, ["lang", "words"], "left").filter(f"longer IS NULL OR 100 * longer < {share} * a").drop("longer")
    cuts = left.withColumn("k", F.explode(F.sequence(F.lit(1), size - 1)))
    cuts = cuts.withColumns({"head": F.slice("words", F.lit(1), F.col("k")), "tail": F.slice("words", F.col("k") + 1, size - F.col("k"))})
    cuts = cuts.join(counts.select("lang", F.col("words").alias("head"), F.col("f").alias("l")), ["lang", "head"])
    cuts = cuts.join(counts.select("lang", F.col("words").alias("tail"), F.col("f").alias("r")), ["lang", "tail"])
    wide = lambda c: f"CAST({c} AS DECIMAL(16, 0))"
    score = F.expr(f"CAST(1000000 AS DECIMAL(7, 0)) * ({wide('a')} * {wide('a')}) div ({wide('l')} * {wide('r')})")
    scored = cuts.withColumn("score", score).groupBy("lang", "words", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    scored = checkpointed(scored)
    order = [F.col("cut.score").desc(), F.col("a").desc(), F.col("phrase")]
    rows = scored.join(_spelled(scored, names), ["lang", "words"])
    apart = Window.partitionBy("lang", F.pmod(F.xxhash64("words"), F.lit(RANK_PARTS))).orderBy(*order)
    rows = rows.withColumn("rank", F.row_number().over(apart)).filter(F.col("rank") <= best)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= best)
    return rows.join(totals, "lang").select("lang", "rank", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def oracle_sql(max_words: int = 3, least: int = 10, share: int = 50, best: int = 2000) -> str:
    return f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS p
  FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(p, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM pieces),
places AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, range(1, {max_words + 1}) sizes(k)),
f AS (SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase, count(*) AS f FROM places GROUP BY ALL),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
candidates AS (SELECT lang, phrase, k AS size, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k >= 2 AND f >= {least}),
cuts AS (SELECT *, array_to_string(w[: c], ' ') AS head, array_to_string(w[c + 1 :], ' ') AS tail
         FROM (SELECT *, unnest(range(1, size)) AS c FROM candidates)),
scored AS (SELECT x.*, l.f AS l, r.f AS r, (CAST(1000000 AS HUGEINT) * a * a) // (CAST(l.f AS HUGEINT) * r.f) AS score
           FROM cuts x JOIN f l ON l.lang = x.lang AND l.phrase = head JOIN f r ON r.lang = x.lang AND r.phrase = tail),
cut AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) AS place FROM scored),
longer AS (SELECT lang, part, max(a) AS longer
           FROM (SELECT lang, a, unnest([array_to_string(w[: size - 1], ' '), array_to_string(w[2 :], ' ')]) AS part FROM candidates)
           GROUP BY ALL)
SELECT * EXCLUDE (size) FROM (
  SELECT cut.lang, row_number() OVER (PARTITION BY cut.lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank,
         phrase, a, l, r, n, CAST(score AS BIGINT) AS score, size
  FROM cut JOIN n ON n.lang = cut.lang LEFT JOIN longer ON longer.lang = cut.lang AND longer.part = phrase
  WHERE place = 1 AND (longer IS NULL OR 100 * longer < {share} * a))
WHERE rank <= {best}"""
