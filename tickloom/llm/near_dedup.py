"""Near-duplicate detection by an inverted join of MinHash signature coordinates."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..shipping import ship
from .features import map_rows
from .textops import checkpointed, shared_dir

#: Coordinates of a signature, and how many must be equal for a pair to be looked at. Two sets of
#: similarity 0.8 have 51 equal ones on average; the chance of fewer than 34 is about one in ten million.
COORDINATES = 64
MATCHES = 34
#: Pairs that share a first document are verified in tasks' groups of about so many.
PAIRS_PER_GROUP = 100
#: Identifiers up to which the documents to verify are found by a broadcast; beyond that the join shuffles.
MAX_BROADCAST_IDS = 500_000

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_MULTIPLIERS = np.random.default_rng(41).integers(1, 2**63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_OFFSETS = np.random.default_rng(43).integers(0, 2**63, COORDINATES, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (as in splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a whole text, A-Z lower-cased.

    With fewer words, the whole sequence is one shingle; without words there is none.
    """
    raw = np.frombuffer(text.encode().translate(_LOWER), np.uint8)
    space = _SPACE[raw]
    edges = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]]).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    powers = np.cumprod(np.full(int(lengths.max()), _BASE, np.uint64))
    at = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    terms = (raw[~space].astype(np.uint64) + np.uint64(1)) * powers[at]
    hashes = _mixed(np.add.reduceat(terms, np.cumsum(lengths) - lengths) + lengths.astype(np.uint64))
    k = min(words, len(hashes))
    joined = np.zeros(len(hashes) - k + 1, np.uint64)
    for i in range(k):
        joined = _mixed(joined * _BASE + hashes[i : len(hashes) - k + 1 + i])
    return np.unique(joined + np.uint64(k))


def _signature(own: np.ndarray) -> np.ndarray:
    least = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(own), 2048):
        part = own[at : at + 2048, None] * _MULTIPLIERS + _OFFSETS
        np.minimum(least, part.min(axis=0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _sketch(words: int):
    def work(columns: dict[str, list]) -> dict[str, pa.Array]:
        sets = [shingles(t, words) for t in columns["_text"]]
        signed = lambda v: [int(x) for x in np.array(v, np.uint64).view(np.int64)]
        return {
            "n": pa.array([len(s) for s in sets], pa.int64()),
            "h1": pa.array(signed([s.sum(dtype=np.uint64) for s in sets]), pa.int64()),
            "h2": pa.array(signed([_mixed(s ^ _BASE).sum(dtype=np.uint64) for s in sets]), pa.int64()),
            "sig": pa.array([_signature(s) if len(s) else None for s in sets], pa.list_(pa.int32())),
        }

    return map_rows(["_id"], work)


def _lists(texts: list[str], words: int) -> pa.Array:
    return pa.array([shingles(t, words).view(np.int64) for t in texts], pa.list_(pa.int64()))


def _confirm(words: int, percent: int):
    """For rows sorted so that each group's first document comes before those to compare with it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, first = None, []
        for batch in batches:
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            salt, text = batch.column("salt").to_pylist(), batch.column("_text")
            links = []
            for i in range(batch.num_rows):
                own = shingles(text[i].as_py(), words)
                if group != (a[i], salt[i]):
                    group, first = (a[i], salt[i]), []
                if b[i] is None:
                    first.append(own)
                    continue
                for other in first:
                    both = np.intersect1d(own, other, assume_unique=True).size
                    if 100 * both >= percent * (own.size + other.size - both):
                        links.append(i)
                        break
            yield pa.RecordBatch.from_arrays([batch.column(n).take(pa.array(links, pa.int64())) for n in "ab"], names=["a", "b"])

    return run


def components(links: DataFrame) -> DataFrame:
    """id, component (the smallest identifier reachable) of each identifier in links (a, b) but the smallest
    ones themselves; by alternating large-star and small-star steps until nothing changes.

    A step gives each node's neighbours the node's smallest neighbour; minima are pre-aggregated, so that
    a node with very many neighbours is spread by the join.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    edges = checkpointed(edges)
    before = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == before or not state[0]:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
        before = state
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = checkpointed(small.union(least.select("u", "m")).distinct())


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80
) -> DataFrame:
    """One row per input row: <id_col>, n_shingles, component_id, kept.

    Documents are linked if their sets of word shingles have a Jaccard similarity of percent or more.
    component_id is the smallest identifier that links reach; the document that has it is kept.

    Equal sets are one class, whose member of smallest identifier stands for it. Each class is posted
    under each pair of a coordinate and its value. Postings are ordered by how many share them, and only a
    class's rarest ones are merged: all but MATCHES - 1 of those that it shares with anyone (prefix
    filter). A class with fewer than MATCHES shared postings is skipped. Each list's members first meet
    its smallest member. Lists whose members are then all linked are done. The members of the others are prefix-filtered
    once more, on their full sets: ordered by how many of them have a shingle, two sets of the wanted similarity share
    one of the rarest fifth of the larger and the rarest ninth of the smaller set. So groups of texts that are somewhat
    alike, but not enough, do not meet pair by pair. Pairs with MATCHES or more equal coordinates, and sizes that allow
    the similarity, are confirmed on the full sets of their whole texts.

    Defined cases: null and empty texts, and texts without words, have no shingles and no links; rows that
    repeat an identifier have shingles of their own, share a component and are all kept or all dropped; rows without an identifier are
    linked with nothing (component_id null) and kept; other columns are ignored.
    """
    spark = docs.sparkSession
    ship(spark)
    folder = f"{shared_dir(spark)}/near-{uuid.uuid4()}"

    def saved(frame: DataFrame, name: str) -> DataFrame:
        frame.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    texts = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    id_type = dict(texts.dtypes)["_id"]
    sketches = saved(
        texts.mapInArrow(_sketch(words), f"_id {id_type}, n long, h1 long, h2 long, sig array<int>"), "sketches"
    )
    classes = saved(
        sketches.filter("n > 0 AND _id IS NOT NULL").groupBy("h1", "h2", "n").agg(F.min(F.struct("_id", "sig")).alias("s")).select("h1", "h2", "n", F.col("s._id").alias("_id"), F.col("s.sig").alias("sig")),
        "classes",
    )
    key = F.shiftleft(F.col("at").cast("long"), 32).bitwiseOR(F.col("value").cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))
    postings = classes.select("_id", "n", F.posexplode("sig").alias("at", "value")).select("_id", "n", key.alias("key"))
    shared = postings.join(postings.groupBy("key").agg(F.count(F.lit(1)).alias("members")).filter("members > 1"), "key")
    own = Window.partitionBy("_id")
    prefix = saved(
        shared.withColumns({"m": F.count(F.lit(1)).over(own), "rank": F.row_number().over(own.orderBy("members", "key"))})
        .filter((F.col("m") >= MATCHES) & (F.col("rank") <= F.col("m") - MATCHES + 1))
        .select("_id", "n", "key"),
        "prefix",
    )

    def similar_enough(a, b):
        return (F.least(a, b) * 100 >= F.greatest(a, b) * percent)

    def matching(pairs: DataFrame, name: str) -> DataFrame:
        """The pairs with enough equal coordinates."""
        side = lambda c: classes.select(F.col("_id").alias(c), F.col("sig").alias(f"sig_{c}"), F.col("n").alias(f"n_{c}"))
        equal = F.zip_with("sig_a", "sig_b", lambda x, y: (x == y).cast("int"))
        matches = F.aggregate(equal, F.lit(0), lambda s, x: s + x)
        both = pairs.join(side("a"), "a").join(side("b"), "b").filter(similar_enough(F.col("n_a"), F.col("n_b")))
        return saved(both.filter(matches >= MATCHES).select("a", "b"), name)

    def with_text(ids: DataFrame, name: str) -> DataFrame:
        ids = ids.distinct()
        small = ids.limit(MAX_BROADCAST_IDS + 1).count() <= MAX_BROADCAST_IDS
        return saved(texts.join(F.broadcast(ids) if small else ids, "_id", "left_semi"), name)

    def confirmed(pairs: DataFrame, name: str) -> DataFrame:
        """The pairs whose full sets are similar."""
        wanted = with_text(pairs.select(F.col("a").alias("_id")).union(pairs.select("b")), f"{name}-texts")
        groups = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PAIRS_PER_GROUP).cast("int").alias("salts"))
        firsts = groups.select("a", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(None).cast(id_type).alias("b"))
        others = pairs.join(groups, "a").select("a", F.pmod(F.hash("b"), F.col("salts")).cast("int").alias("salt"), "b")
        told = lambda rows, c: rows.join(wanted.withColumnRenamed("_id", "_c"), F.col(c) == F.col("_c")).select("a", "salt", "b", "_text")
        rows = told(firsts, "a").union(told(others, "b"))
        rows = rows.repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())
        return saved(rows.mapInArrow(_confirm(words, percent), f"a {id_type}, b {id_type}"), f"{name}-links")

    stars = prefix.groupBy("key").agg(F.min("_id").alias("a"), F.count(F.lit(1)).alias("members")).filter("members > 1")
    first_pairs = saved(prefix.join(stars, "key").filter("_id <> a").select("a", F.col("_id").alias("b")).distinct(), "pairs")
    links = confirmed(matching(first_pairs, "matching"), "first")
    found = components(links)
    labelled = prefix.join(found, F.col("id") == F.col("_id"), "left").select("_id", "n", "key", F.coalesce("component", "_id").alias("class"))
    mixed = labelled.groupBy("key").agg(F.min("class").alias("lo"), F.max("class").alias("hi")).filter("lo <> hi").select("key")
    open_ = saved(labelled.join(mixed, "key"), "open")
    wanted = with_text(open_.select("_id"), "open-texts")
    sets = saved(wanted.mapInArrow(map_rows(["_id"], lambda columns: {"own": _lists(columns["_text"], words)}), f"_id {id_type}, own array<long>"), "open-sets")
    about = open_.select("_id", "n", "class").distinct()
    held = sets.select("_id", F.explode("own").alias("h"))
    common = held.join(held.groupBy("h").agg(F.count(F.lit(1)).alias("members")).filter("members > 1"), "h").join(about, "_id")
    ranked = common.withColumns({"m": F.count(F.lit(1)).over(own), "rank": F.row_number().over(own.orderBy("members", "h"))})
    ranked = ranked.withColumn("rest", F.col("m") - F.col("rank"))  # shingles that come later in the order
    # Of a pair, the larger set shares at least percent of its shingles, the smaller one at least the share for two equal sizes.
    least_large, least_small = F.ceil(F.col("n") * percent / 100), F.ceil(F.col("n") * (2 * percent) / (100 + percent))
    ranked = saved(
        ranked.filter(F.col("rank") <= F.col("m") - least_large + 1).select("h", "_id", "n", "class", "rest", (F.col("rank") <= F.col("m") - least_small + 1).alias("small")), "open-prefix"
    )
    # Only members of different classes need to meet. Shingles of one class alone are left out, which most shingles of a group of near
    # copies are; and of the others, the members of the class that has most of them meet the rest only, not each other.
    sizes = ranked.groupBy("h", "class").agg(F.count(F.lit(1)).alias("members"))
    shared_ = sizes.groupBy("h").agg(F.max_by("class", F.struct("members", "class")).alias("most"), F.count(F.lit(1)).alias("classes")).filter("classes > 1")
    ranked = ranked.join(shared_.drop("classes"), "h").withColumn("large", F.col("class") == F.col("most")).drop("most")
    ranked = saved(ranked, "open-shared")
    meets = {"s": F.array("large"), "l": F.when(F.col("large"), F.array(F.lit(False))).otherwise(F.array(F.lit(False), F.lit(True)))}
    side = lambda c: ranked.select("h", F.explode(meets[c]).alias("meets"), F.col("_id").alias(c), F.col("n").alias(f"n_{c}"), F.col("class").alias(f"class_{c}"), F.col("rest").alias(f"rest_{c}"), F.col("small").alias(f"small_{c}"))
    # At the first shingle that two sets share, enough must be left of both.
    enough = F.least("rest_s", "rest_l") + 1 >= F.ceil((F.col("n_s") + F.col("n_l")) * percent / (100 + percent))
    rest = (
        side("s").filter("small_s").join(side("l"), ["h", "meets"])
        .filter(enough & (F.struct("n_s", "s") < F.struct("n_l", "l")) & (F.col("class_s") != F.col("class_l")) & similar_enough(F.col("n_s"), F.col("n_l")))
        .select(F.least("s", "l").alias("a"), F.greatest("s", "l").alias("b")).distinct().join(first_pairs, ["a", "b"], "left_anti")
    )
    more = confirmed(matching(rest, "matching-rest"), "rest")
    if not more.isEmpty():
        found = components(links.union(more))
    members = classes.join(found, F.col("id") == F.col("_id"), "left").select("h1", "h2", "n", F.coalesce("component", "_id").alias("component_id"))
    known = sketches.filter("_id IS NOT NULL")
    of_id = known.join(members, ["h1", "h2", "n"], "left").groupBy("_id").agg(F.min(F.coalesce("component_id", "_id")).alias("component_id"))
    rows = known.select("_id", "n").join(of_id, "_id").withColumn("kept", F.col("_id") == F.col("component_id"))
    rest = sketches.filter("_id IS NULL").select("_id", "n", F.lit(None).cast(id_type).alias("component_id"), F.lit(True).alias("kept"))
    return rows.union(rest).select(F.col("_id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", "kept")
