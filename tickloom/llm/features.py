"""Text features that are computed in tasks with numpy, and small linear models over them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

from .workers import give_back

#: Bytes whose n-grams are hashed at once; bounds memory for very long texts.
BLOCK = 1 << 22


def ngram_counts(raw: bytes, dims: int) -> np.ndarray:
    """Counts of the byte trigrams, hashed into dims (a power of two) buckets; the whole text counts."""
    counts = np.zeros(dims, dtype=np.int64)
    shift = np.uint32(32 - (dims.bit_length() - 1))
    for at in range(0, max(len(raw) - 2, 0), BLOCK):
        b = np.frombuffer(raw, np.uint8, min(BLOCK + 2, len(raw) - at), at).astype(np.uint32)
        h = (b[:-2] | b[1:-1] << np.uint32(8) | b[2:] << np.uint32(16)) * np.uint32(2654435761)
        counts += np.bincount(h >> shift, minlength=dims)
    return counts


def unit(counts: np.ndarray) -> np.ndarray:
    """Square roots of the counts, scaled to length 1."""
    root = np.sqrt(counts.astype(np.float32))
    return root / max(float(np.linalg.norm(root)), 1e-9)


def ridge(x: np.ndarray, y: np.ndarray, penalty: float) -> np.ndarray:
    """Weights (with a last row for the constant) of ridge regressions of the columns of y, in dual form."""
    x = np.hstack([x, np.ones((len(x), 1))]).astype(np.float64)
    return x.T @ np.linalg.solve(x @ x.T + penalty * np.eye(len(x)), y)


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float, steps: int = 25) -> np.ndarray:
    """Weights (constant last) of a weighted logistic regression, by Newton's method."""
    x = np.hstack([x, np.ones((len(x), 1))]).astype(np.float64)
    w = np.zeros(x.shape[1])
    scale = np.full(len(w), penalty)
    scale[-1] = 1e-6
    for _ in range(steps):
        p = sigmoid(x @ w)
        s = np.maximum(weight * p * (1 - p), 1e-9)
        step = np.linalg.solve((x.T * s) @ x + np.diag(scale), x.T @ (weight * (y - p)) - scale * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def apply(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return x @ w[:-1] + w[-1]


def map_rows(
    kept: list[str], work: Callable[[dict[str, list]], dict[str, pa.Array]], rows: int = 512
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For mapInArrow: passes the columns kept on, and adds those that work makes of some rows at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                made = work({n: part.column(n).to_pylist() for n in part.schema.names if n not in kept})
                columns = {n: part.column(n) for n in kept} | made
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))
        give_back()

    return run
