"""Benchmark decontamination: containment search with size-partitioned MinHash sketches."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .textops import checkpointed, text_of, words_of

SHINGLE_WORDS = 5
MIN_CONTAINMENT = 0.8
#: Rows of the benchmark's sketches or shingles, and candidate pairs, up to which they are broadcast; beyond that the join
#: shuffles.
MAX_BROADCAST_SHINGLES = 500_000


def _hash(words: str, at: Column | int, k: int) -> Column:
    return F.xxhash64(*[F.get(words, F.lit(i) + at) for i in range(k)])


def _grams(words: str, k: Column) -> Column:
    """All shingles of k words, as text."""
    return F.transform(F.sequence(F.lit(1), F.size(words) - k + 1), lambda p: F.concat_ws(" ", F.slice(words, p, k)))


def _small(frame: DataFrame) -> DataFrame:
    """The frame, to be broadcast if its rows are few enough."""
    return F.broadcast(frame) if frame.limit(MAX_BROADCAST_SHINGLES + 1).count() <= MAX_BROADCAST_SHINGLES else frame


def item_shingles(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """Distinct shingles of each item: _item, _k, _h, _gram, _q (set size), _sketch.

    An item of fewer than SHINGLE_WORDS words has its whole sequence as its one shingle; without words it
    has none. `_sketch` marks the minima of the shingles' hashes that stand for the item in the search.
    Items are partitioned by set size into classes [2^c, 2^(c+1)); in a class, as many minima are kept
    as its largest set could miss and still reach MIN_CONTAINMENT, and one more: a document that
    contains enough of an item has at least one of its minima.
    """
    words = items.select(F.col(item_col).alias("_item"), words_of(text_col).alias("_words")).filter(F.size("_words") > 0)
    k = F.least(F.size("_words"), F.lit(SHINGLE_WORDS))
    at = words.select("_item", "_words", k.alias("_k"), F.explode(F.sequence(F.lit(0), F.size("_words") - k)).alias("_p"))
    grams = at.select(
        "_item",
        "_k",
        F.concat_ws(" ", F.slice("_words", F.col("_p") + 1, F.col("_k"))).alias("_gram"),
        reduce(lambda rest, n: F.when(F.col("_k") == n, _hash("_words", F.col("_p"), n)).otherwise(rest), range(1, SHINGLE_WORDS), _hash("_words", F.col("_p"), SHINGLE_WORDS)).alias("_h"),
    ).distinct()
    item = Window.partitionBy("_item", "_k")
    size = F.count(F.lit(1)).over(item)
    largest = F.pow(F.lit(2), F.floor(F.log2("_q")) + 1) - 1
    return (
        grams.withColumn("_q", size)
        .withColumn("_minima", F.floor((1 - MIN_CONTAINMENT) * largest + 1e-9) + 1)
        .withColumn("_sketch", F.row_number().over(item.orderBy("_h", "_gram")) <= F.col("_minima"))
        .drop("_minima")
    )


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """_id, _t1, _t2 (128 bits of the text, which tell rows of one identifier apart), _words."""
    text = text_of(text_col)
    return docs.select(F.col(id_col).alias("_id"), F.xxhash64(text).alias("_t1"), F.xxhash64(F.lit(1), text).alias("_t2"), words_of(text_col).alias("_words"))


def candidates(texts: DataFrame, shingles: DataFrame) -> DataFrame:
    """Distinct _id, _t1, _t2, _item, _k: the documents that hold one of an item's minima, and are long enough to contain it.

    Only the sketches meet the documents' rolling shingles: a pair that merely has some other shingle in common is never
    made. The two may be a class of item sizes too far apart, or share a minimum by chance; contained_items() verifies.
    """
    sketch = checkpointed(shingles.filter("_sketch").select("_k", "_h", "_item", F.ceil(F.col("_q") * MIN_CONTAINMENT - 1e-9).alias("_least")))
    found = []
    for k in sorted(r["_k"] for r in sketch.select("_k").distinct().collect()):  # 5 rows at most
        wanted = _small(sketch.filter(F.col("_k") == k).drop("_k"))
        here = texts.filter(F.size("_words") >= k).select(
            "_id", "_t1", "_t2", "_words", F.explode(F.sequence(F.lit(0), F.size("_words") - k)).alias("_p")
        )
        hits = here.select("_id", "_t1", "_t2", (F.size("_words") - k + 1).alias("_places"), _hash("_words", F.col("_p"), k).alias("_h"))
        found.append(hits.join(wanted, "_h").filter("_places >= _least").select("_id", "_t1", "_t2", "_item", F.lit(k).alias("_k")))
    if not found:
        return texts.select("_id", "_t1", "_t2").join(shingles.select("_item", "_k").limit(0), F.lit(True), "inner")
    return reduce(DataFrame.union, found).distinct()


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Pairs of a document and a benchmark item it contains: <id_col>, <item_col>, n_item, n_found,
    containment - the share of the item's distinct word shingles that the whole document has.

    A MinHash search by size classes of the items gives the candidate pairs (see candidates()). The texts of the
    candidates alone are read again, and the item's shingles are looked up among all of theirs, word for word.

    Defined cases: null, empty and short texts match only items short enough; items without words match
    nothing; rows that repeat an identifier are documents of their own, and can give equal pairs; items that repeat an
    identifier count as one, with the shingles of all (but those of fewer words apart from the others); empty tables give an empty result; other columns are ignored.
    """
    shingles = item_shingles(items, item_col, item_text_col)
    texts = _texts(docs, id_col, text_col)
    pairs = checkpointed(candidates(texts, shingles).select(*[F.col(c).alias(f"{c}_") for c in ("_id", "_t1", "_t2")], "_item", "_k"))
    same = F.col("_id").eqNullSafe(F.col("_id_")) & (F.col("_t1") == F.col("_t1_")) & (F.col("_t2") == F.col("_t2_"))
    whole = checkpointed(shingles.groupBy("_item", "_k", "_q").agg(F.collect_list("_gram").alias("_wanted")))
    few = F.broadcast(whole) if (whole.agg(F.sum("_q")).first()[0] or 0) <= MAX_BROADCAST_SHINGLES else whole
    found = F.size(F.array_intersect("_wanted", _grams("_words", F.col("_k"))))
    return (
        texts.join(_small(pairs), same)
        .join(few, ["_item", "_k"])
        .select("_id", "_item", "_q", found.cast("long").alias("n_found"))
        .filter(F.col("n_found") >= MIN_CONTAINMENT * F.col("_q"))
        .select(
            F.col("_id").alias(id_col),
            F.col("_item").alias(item_col),
            F.col("_q").cast("long").alias("n_item"),
            "n_found",
            F.round(F.col("n_found") / F.col("_q"), 6).alias("containment"),
        )
    )


def oracle_sql() -> str:
    """The same pairs in DuckDB SQL, by joining all shingles."""
    words = r"""list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w"""
    grams = "array_to_string(w[p:p + k - 1], ' ') AS gram"
    return f"""
WITH iw AS (SELECT *, least(len(w), {SHINGLE_WORDS}) AS k FROM (SELECT item_id, {words} FROM benchmark) WHERE len(w) > 0),
dw AS (SELECT * FROM (SELECT doc_id, {words} FROM documents), (SELECT DISTINCT k FROM iw) WHERE len(w) >= k),
i AS (SELECT DISTINCT item_id, k, {grams} FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS p FROM iw)),
d AS (SELECT DISTINCT doc_id, k, {grams} FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS p FROM dw)),
q AS (SELECT item_id, count(*) AS n_item FROM i GROUP BY 1),
m AS (SELECT doc_id, item_id, count(*) AS n_found FROM d JOIN i USING (k, gram) GROUP BY 1, 2)
SELECT doc_id, item_id, n_item, n_found, round(n_found / n_item, 6) AS containment
FROM m JOIN q USING (item_id) WHERE n_found >= {MIN_CONTAINMENT} * n_item"""
