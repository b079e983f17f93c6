"""Language identification with error-correcting output codes."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..shipping import ship
from .features import apply, map_rows, ngram_counts, ridge, unit

#: Buckets of hashed byte trigrams.
DIMS = 4096
#: The classifiers are fit on at most about so many labelled documents, dealt evenly to the languages.
MAX_TRAINING_ROWS = 3000
PENALTY = 0.05
#: A prediction is ambiguous if the second codeword's loss is within so much of the nearest one's.
AMBIGUITY = 0.1
UNDETERMINED = "und"


class Model(NamedTuple):
    langs: list[str]
    code: np.ndarray  # languages x bits, +1 or -1
    weights: np.ndarray  # (DIMS + 1) x bits
    trust: np.ndarray  # weight of each bit in decoding


def codewords(n: int, seed: int = 5) -> np.ndarray:
    """n codewords of +1 and -1: of some random matrices without constant bits, that whose rows are farthest apart."""
    bits = 15 if n <= 16 else 4 * int(np.ceil(np.log2(n)))
    rng, best, apart = np.random.default_rng(seed), None, -1
    for _ in range(200):
        code = rng.choice([-1, 1], size=(n, bits))
        if n > 1:
            constant = np.abs(code.sum(axis=0)) == n
            code[rng.integers(n), constant] *= -1
        least = min(((code[i] != code[j]).sum() for i in range(n) for j in range(i)), default=bits) if n <= 64 else bits
        if least > apart:
            best, apart = code, least
        if n > 64:
            break
    return best


def _features(texts: list[str]) -> np.ndarray:
    return np.stack([unit(ngram_counts(t.lower().encode(), DIMS)) for t in texts])


def _has_letter(text: Column) -> Column:
    return F.coalesce(F.rlike(text, F.lit(r"\p{L}")), F.lit(False))


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id") -> Model:
    """Fits a model on a sample of at most about MAX_TRAINING_ROWS of docs, those with a language and a letter.

    Each bit of the codewords gets a binary classifier over the texts' byte trigrams. Its trust is how far
    its accuracy in training exceeds chance.
    """
    known = docs.filter(F.col(lang_col).isNotNull())
    counts = {r[0]: r[1] for r in known.groupBy(F.col(lang_col).cast("string")).count().collect()}  # a row a language
    langs = sorted(counts)
    if not langs:
        return Model([], np.zeros((0, 1)), np.zeros((DIMS + 1, 1)), np.ones(1))
    share = MAX_TRAINING_ROWS / len(langs)
    fraction = F.lit(0.0)
    for lang in langs:
        fraction = F.when(F.col("_lang") == lang, min(1.0, share / counts[lang])).otherwise(fraction)
    sample = known.select(
        F.col(lang_col).cast("string").alias("_lang"),
        F.col(text_col).alias("_text"),
        (F.pmod(F.xxhash64(F.col(id_col), F.lit(11)), F.lit(1_000_000)) / 1_000_000).alias("_at"),
    ).filter((F.col("_at") < fraction) & _has_letter(F.col("_text")))

    def work(columns: dict[str, list]) -> dict[str, pa.Array]:
        x = _features(columns["_text"]).astype(np.float16)
        return {"x": pa.array([row.tobytes() for row in x], pa.binary())}

    ship(docs.sparkSession)
    rows = sample.drop("_at").mapInArrow(map_rows(["_lang"], work), "_lang string, x binary").collect()
    code = codewords(len(langs))
    if not rows:
        return Model(langs, code, np.zeros((DIMS + 1, code.shape[1])), np.ones(code.shape[1]))
    x = np.stack([np.frombuffer(r["x"], np.float16) for r in rows]).astype(np.float32)
    y = code[[langs.index(r["_lang"]) for r in rows]]
    weights = ridge(x, y, PENALTY)
    right = (np.sign(apply(x, weights)) == y).mean(axis=0)
    return Model(langs, code, weights, np.maximum(2 * right - 1, 0.05))


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", carry: dict[str, Column] | None = None) -> DataFrame:
    """One row per input row: <id_col>, the columns of carry, lang_pred, score (0 to 1), ambiguous.

    Each bit's margin is read against each codeword by the logistic loss, weighted by the bit's trust; the
    codeword of least loss wins. The score is its share of exp(-loss) over all codewords.

    Defined cases: a text that is null or has no letter, and any text if no language was learned, gives
    `und` with score 0; rows that repeat an identifier give a row each; other columns are ignored.
    """
    carry = carry or {}
    rows = docs.select(
        F.col(id_col).alias("_id"),
        *[c.alias(f"_c_{n}") for n, c in carry.items()],
        F.when(_has_letter(F.col(text_col)), F.col(text_col)).alias("_text"),
    )
    ship(docs.sparkSession)
    langs, code, weights, trust = model
    small = weights.astype(np.float32)

    def work(columns: dict[str, list]) -> dict[str, pa.Array]:
        texts = columns["_text"]
        pred, score, unsure = [UNDETERMINED] * len(texts), [0.0] * len(texts), [True] * len(texts)
        at = [i for i, t in enumerate(texts) if t is not None and langs]
        if at:
            margins = apply(_features([texts[i] for i in at]), small)
            loss = np.stack([(np.log1p(np.exp(-4 * margins * c)) * trust).sum(axis=1) for c in code], axis=1)
            likely = np.exp(loss.min(axis=1, keepdims=True) - loss)
            order = np.sort(loss, axis=1)
            for k, i in enumerate(at):
                pred[i] = langs[int(loss[k].argmin())]
                score[i] = float(1 / likely[k].sum())
                unsure[i] = bool(len(langs) > 1 and order[k, 1] - order[k, 0] < AMBIGUITY * trust.sum())
        return {"lang_pred": pa.array(pred), "score": pa.array(score, pa.float64()), "ambiguous": pa.array(unsure)}

    kept = [c for c in rows.columns if c != "_text"]
    schema = ", ".join([f"`{c}` {t}" for c, t in rows.dtypes if c != "_text"] + ["lang_pred string", "score double", "ambiguous boolean"])
    found = rows.mapInArrow(map_rows(kept, work), schema)
    return found.select(F.col("_id").alias(id_col), *[F.col(f"_c_{n}").alias(n) for n in carry], "lang_pred", "score", "ambiguous")


def held_out(id_col: str = "doc_id") -> Column:
    """Documents that no model learns from: crc32 of the identifier's text leaves 2 when divided by 4.

    False for null identifiers.
    """
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))
