"""Quality classification by co-training of two views."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from operator import eq
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shipping import ship
from .features import apply, logistic, map_rows, ngram_counts, sigmoid, unit
from .textops import checkpointed
from .workers import give_back

#: Buckets of hashed byte trigrams in the text view.
DIMS = 512
#: The views are fit on at most about so many labelled documents.
MAX_LABELLED = 4000
ROUNDS = 4
#: Of all other documents a view hands so many to the other view in each round: those it is surest of, if it is at least so sure.
HANDED = 400
SURE = 0.9
#: Documents below this score are rejected.
THRESHOLD = 0.5
#: Hashed sources and languages, and powers of two of the length, in the metadata view.
_SOURCES, _LANGS, _SIZES = 64, 32, 24
_TEXT, _META = DIMS + 16, _SOURCES + _LANGS + _SIZES + 1


class Model(NamedTuple):
    text: np.ndarray
    meta: np.ndarray
    text_scale: tuple[float, float]  # Platt's slope and constant
    meta_scale: tuple[float, float]
    prior: float
    handed: tuple[tuple[str, int, int], ...] = ()  # of each round and view that gave: the view, good and bad ones


def text_view(text: str) -> np.ndarray:
    """What the text holds: its byte trigrams, how much of it repeats, and how it is laid out."""
    words = text.split()
    n = max(len(words), 1)
    repeats = sum(map(eq, words, words[1:])) / n
    own = len(set(words)) / n
    raw = text.encode()
    size = max(len(raw), 1)
    kinds = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) / size
    lines = raw.count(b"\n") + 1
    marks = kinds[33:48].sum() + kinds[58:65].sum() + kinds[91:97].sum() + kinds[123:127].sum()
    common = kinds[44] + kinds[46]
    layout = [
        repeats, own, own * np.log1p(n) / 5, np.sqrt(repeats), np.log1p(lines) / 5, np.log1p(len(raw) / lines) / 5,
        10 * kinds[65:91].sum(), 10 * kinds[48:58].sum(), 10 * kinds[32], 10 * kinds[10],
        20 * (marks - common), np.sqrt(max(marks - common, 0)) * 4, 20 * common,
        20 * kinds[124], 20 * kinds[33], 2 * (kinds[97:123].sum() + kinds[128:].sum()),
    ]
    return np.concatenate([4 * unit(ngram_counts(raw, DIMS)), layout])


def meta_view(source: str | None, lang: str | None, n_chars: int | None) -> np.ndarray:
    """What is known of the page without a look at its text: source, language and stated length."""
    v = np.zeros(_SOURCES + _LANGS + _SIZES + 1)
    if source is not None:
        v[zlib.crc32(source.encode()) % _SOURCES] = 1
    if lang is not None:
        v[_SOURCES + zlib.crc32(lang.encode()) % _LANGS] = 1
    if n_chars is not None:
        size = float(np.log2(max(n_chars, 0) + 1))
        v[_SOURCES + _LANGS + min(int(size), _SIZES - 1)] = 1
        v[-1] = size / 10
    return v


def _with_views(rows: DataFrame, kept: list[str]) -> DataFrame:
    def work(columns: dict[str, list]) -> dict[str, pa.Array]:
        given = list(zip(columns["_text"], columns["_source"], columns["_lang"], columns["_n"], strict=True))
        views = ((text_view(t), meta_view(*m)) for t, *m in given)
        packed = [(a.astype(np.float16).tobytes(), b.astype(np.float16).tobytes()) for a, b in views]
        return {"a": pa.array([a for a, _ in packed], pa.binary()), "b": pa.array([b for _, b in packed], pa.binary())}

    ship(rows.sparkSession)
    schema = ", ".join([f"`{c}` {t}" for c, t in rows.dtypes if c in kept] + ["a binary", "b binary"])
    return rows.mapInArrow(map_rows(kept, work), schema)


def _given(docs: DataFrame, *more) -> DataFrame:
    """The columns the views read. Missing ones count as null."""
    column = lambda c, t: (docs[c] if c in docs.columns else F.lit(None)).cast(t)
    return docs.select(
        *more,
        F.coalesce(F.col("text"), F.lit("")).alias("_text"),
        column("source", "string").alias("_source"),
        column("lang", "string").alias("_lang"),
        column("n_chars", "long").alias("_n"),
    )


def _part(id_col: str, salt: int):
    """A number in [0, 1) that depends on the identifier alone."""
    return F.pmod(F.xxhash64(F.col(id_col), F.lit(salt)), F.lit(1_000_000)) / 1_000_000


def _surest(given: DataFrame, model: dict[str, np.ndarray], taken: set[int], counts: dict[int, int]) -> dict[str, list[tuple[int, int, bytes]]]:
    """Giving view -> (label, key, other view's features) of the documents that it is surest of, counts[label] of each label at most.

    All documents are looked at. A task keeps the surest of its own, and of those Spark takes the surest of all; so the driver gets
    what is handed over and nothing else. Documents that hold the same are one, known by a 64-bit key.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[tuple[str, int], dict[int, tuple[float, bytes]]] = {(g, y): {} for g in "ab" for y in counts}

        def trimmed(found: dict[int, tuple[float, bytes]], most: int) -> dict[int, tuple[float, bytes]]:
            return dict(sorted(found.items(), key=lambda x: (-x[1][0], x[0]))[:most])

        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                text, source, lang, n, keys = (part.column(c).to_pylist() for c in ("_text", "_source", "_lang", "_n", "_key"))
                a = np.stack([text_view(t) for t in text]).astype(np.float16)
                b = np.stack([meta_view(*m) for m in zip(source, lang, n, strict=True)]).astype(np.float16)
                for giver, own, other in (("a", a, b), ("b", b, a)):
                    p = sigmoid(apply(own.astype(np.float64), model[giver]))
                    for label, most in counts.items():
                        sure = p if label else 1 - p
                        found = best[giver, label]
                        for i in np.flatnonzero(sure >= SURE):
                            if keys[i] not in taken:
                                found[keys[i]] = (float(sure[i]), other[i].tobytes())
                        if len(found) > 4 * most:
                            best[giver, label] = trimmed(found, most)
        rows = [(g, y, s, k, v) for (g, y), found in best.items() for k, (s, v) in trimmed(found, counts[y]).items()]
        columns = list(zip(*rows, strict=True)) or [()] * 5
        kinds = [pa.string(), pa.int32(), pa.float64(), pa.int64(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["giver", "label", "sure", "key", "view"])
        give_back()

    ship(given.sparkSession)
    keyed = given.select("_text", "_source", "_lang", "_n", F.xxhash64("_text", "_source", "_lang", "_n").alias("_key"))
    found = checkpointed(keyed.mapInArrow(run, "giver string, label int, sure double, key long, view binary"))
    picks: dict[str, list[tuple[int, int, bytes]]] = {}
    for giver in "ab":
        picks[giver] = []
        for label, most in counts.items():
            mine = found.filter((F.col("giver") == giver) & (F.col("label") == label)).groupBy("key").agg(F.max("sure").alias("sure"), F.first("view").alias("view"))
            picks[giver] += [(label, r["key"], r["view"]) for r in mine.orderBy(F.desc("sure"), "key").limit(most).collect()]
    return picks


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> Model:
    """Fits both views on a sample of the labelled documents, and on what they learn from each other of all others.

    In each round each view is fit on its own labelled set, looks at all documents outside the sample, and hands those that it is
    surest of to the other view's set, good and bad ones in the proportion of the labels. A fifth of the
    labelled sample is held back to calibrate the views (Platt scaling).

    Defined cases: null labels and labels of unknown documents count for nothing; a document labelled
    more than once takes the mean; without labels of both kinds (or without documents) every document gets the same
    score; null identifiers have no label; missing metadata are unknown; other columns are ignored, whatever their names.
    """
    known = labels.groupBy(F.col(id_col).alias("_id")).agg(F.avg(label_col).alias("_y")).filter("_id IS NOT NULL AND _y IS NOT NULL")
    n_labels = labels.count()
    sample = known.filter(_part("_id", 1) < min(1.0, MAX_LABELLED / max(n_labels, 1)))
    given = _given(docs, F.col(id_col).alias("_id"))  # no other column's name can clash from here on
    marked = given.join(F.broadcast(sample), "_id", "left")  # a bounded sample
    chosen = marked.filter("_y IS NOT NULL").withColumn("_fold", _part("_id", 3)).drop("_id")
    seen = _with_views(chosen, ["_y", "_fold"]).collect()
    good = sum(r["_y"] >= 0.5 for r in seen)
    prior = good / len(seen) if seen else 1.0
    if not 0 < good < len(seen):
        return Model(np.zeros(_TEXT + 1), np.zeros(_META + 1), (0.0, 0.0), (0.0, 0.0), prior)
    matrix = lambda part, c: np.stack([np.frombuffer(r[c], np.float16) for r in part]).astype(np.float64)
    fit = [r for r in seen if r["_fold"] >= 0.2] or seen
    held = [r for r in seen if r["_fold"] < 0.2]
    if len({r["_y"] >= 0.5 for r in fit}) < 2:
        fit = seen
    if len({r["_y"] >= 0.5 for r in held}) < 2:
        held = seen
    y = np.array([float(r["_y"] >= 0.5) for r in fit])
    own = {c: (matrix(fit, c), y, np.ones(len(y))) for c in "ab"}
    others = marked.filter("_y IS NULL").drop("_id", "_y")
    counts = {1: max(1, int(HANDED * prior)), 0: max(1, int(HANDED * (1 - prior)))}
    taken: set[int] = set()
    told = []
    model: dict[str, np.ndarray] = {}
    for turn in range(ROUNDS + 1):
        for c in "ab":
            model[c] = logistic(*own[c], penalty=0.5)
        if turn == ROUNDS:
            break
        picks = _surest(others, model, taken, counts)
        for giver, taker in ("ab", "ba"):
            told.append((giver, sum(label for label, *_ in picks[giver]), sum(1 - label for label, *_ in picks[giver])))
            if picks[giver]:
                x, t, w = own[taker]
                more = np.stack([np.frombuffer(v, np.float16) for *_, v in picks[giver]]).astype(np.float64)
                own[taker] = (np.vstack([x, more]), np.append(t, [float(label) for label, *_ in picks[giver]]), np.append(w, np.full(len(more), 0.5)))
        handed = {key for giver in "ab" for _, key, _ in picks[giver]}
        if not handed:
            break
        taken |= handed
    truth = np.array([float(r["_y"] >= 0.5) for r in held])
    scales = []
    for c in "ab":
        w = logistic(apply(matrix(held, c), model[c])[:, None], truth, np.ones(len(truth)), penalty=0.01)
        scales.append((float(w[0]), float(w[1])))
    return Model(model["a"], model["b"], scales[0], scales[1], prior, tuple(told))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", carry: bool = False) -> DataFrame:
    """One row per input row: <id_col>, text_score, meta_score, score, kept (and _row, if carry).

    The views' calibrated log odds are added, less the prior's, which both contain: the views are taken as independent
    given the label, as co-training has it. Documents of THRESHOLD or more are kept.

    Defined cases: a null text counts as empty; null or missing metadata as unknown; rows that repeat an
    identifier give a row each; other columns are ignored, and come back in the struct `_row` if carry is set.
    """
    ship(docs.sparkSession)
    kept = ["_id", *(["_row"] if carry else [])]
    rows = _given(docs, F.col(id_col).alias("_id"), *([F.struct("*").alias("_row")] if carry else []))
    even = float(np.log(max(model.prior, 1e-6) / max(1 - model.prior, 1e-6)))
    flat = not any(model.text_scale) and not any(model.meta_scale)

    def work(columns: dict[str, list]) -> dict[str, pa.Array]:
        given = list(zip(columns["_text"], columns["_source"], columns["_lang"], columns["_n"], strict=True))
        a = apply(np.stack([text_view(t) for t, *_ in given]), model.text) * model.text_scale[0] + model.text_scale[1]
        b = apply(np.stack([meta_view(*m) for _, *m in given]), model.meta) * model.meta_scale[0] + model.meta_scale[1]
        if flat:
            a, b = np.full(len(given), even), np.full(len(given), even)
        both = sigmoid(a + b - even)  # each view's log odds hold the prior's
        made = {"text_score": sigmoid(a), "meta_score": sigmoid(b), "score": both}
        return {n: pa.array(v, pa.float64()) for n, v in made.items()} | {"kept": pa.array(both >= THRESHOLD)}

    schema = ", ".join([f"`{c}` {t}" for c, t in rows.dtypes if c in kept] + ["text_score double", "meta_score double", "score double", "kept boolean"])
    found = rows.mapInArrow(map_rows(kept, work), schema)
    return found.select(F.col("_id").alias(id_col), "text_score", "meta_score", "score", "kept", *(["_row"] if carry else []))
