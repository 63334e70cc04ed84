"""Least squares from sums of products: one pass over the rows or blocks serves every fold, penalty and target."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.ml.blocks import DIRECT, Packed, add_up, flat_matrix, row_arrays


def fold_grams(packed: Packed, folds: int) -> np.ndarray:
    """Per fold the sums of products of (1, features, targets), a matrix each; rows outside 0..folds-1 count in the last one.
    Scale features first if their means are large against their spread, or sums of large values cancel."""
    found = add_up(packed.rdd, lambda b: _grams(b.x, b.y, b.fold, folds), lambda a, b: a + b)
    return np.zeros((folds + 1, 1, 1)) if found is None else found


def row_grams(df: DataFrame, features: list[str], labels: list[str], fold: str, folds: int) -> np.ndarray:
    """The same sums straight from the rows of a table, where they are: nothing is sorted, moved or written but the sums."""
    size = 1 + len(features) + len(labels)
    rows = row_arrays(df, features, labels, fold)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((folds + 1, size, size))
        for b in batches:
            total += _grams(flat_matrix(b["_x"], len(features)), flat_matrix(b["_y"], len(labels)), b["_fold"].to_numpy(zero_copy_only=False), folds)
        yield pa.RecordBatch.from_pydict({"sums": pa.array([total.tobytes()], pa.binary())})

    def add(table: pa.Table) -> pa.Table:
        parts = sorted(zip(table["part"].to_pylist(), table["sums"].to_pylist()))
        return pa.table({"number": pa.array([parts[0][0]], pa.int32()), "sums": pa.array([sum(np.frombuffer(p) for _, p in parts).tobytes()], pa.binary())})

    parts = rows.mapInArrow(partial, "sums binary").withColumn("part", F.spark_partition_id())
    found = parts.groupBy(F.pmod("part", F.lit(DIRECT)).alias("_group")).applyInArrow(add, "number int, sums binary").collect()  # at most DIRECT rows
    total = np.zeros((folds + 1, size, size))
    for r in sorted(found, key=lambda r: r["number"]):
        total += np.frombuffer(r["sums"]).reshape(total.shape)
    return total


def _grams(x: np.ndarray, y: np.ndarray, fold: np.ndarray, folds: int) -> np.ndarray:
    z = np.column_stack([np.ones(len(x)), x, y])
    out = np.zeros((folds + 1, z.shape[1], z.shape[1]))
    for f in range(folds + 1):
        own = z[fold == f] if f < folds else z[(fold < 0) | (fold >= folds)]
        out[f] = own.T @ own
    return out


def solve(gram: np.ndarray, width: int, target: int, penalty: float = 0.0, l1: float = 0.0) -> np.ndarray:
    """Intercept and weights for one target. The objective is the mean squared error / 2 + penalty x (l1 x sum |w| + (1 - l1) x
    sum w^2 / 2); without an absolute part it is solved directly, else by coordinate descent. Features that are constant or follow
    from others get the weights of least size."""
    n = gram[0, 0]
    if not n:
        return np.zeros(width + 1)
    y = 1 + width + target
    mean = gram[0] / n
    cov = gram[1 : width + 1, 1 : width + 1] / n - np.outer(mean[1 : width + 1], mean[1 : width + 1])
    with_y = gram[1 : width + 1, y] / n - mean[1 : width + 1] * mean[y]
    if penalty * l1:
        w = np.zeros(width)
        scale = np.diag(cov) + penalty * (1 - l1)
        for _ in range(10_000):
            before = w.copy()
            for j in range(width):
                rest = with_y[j] - cov[j] @ w + cov[j, j] * w[j]
                w[j] = np.sign(rest) * max(abs(rest) - penalty * l1, 0) / scale[j] if scale[j] > 0 else 0.0
            if np.abs(w - before).max(initial=0) <= 1e-12 * max(1.0, np.abs(w).max(initial=0)):
                break
    else:
        w = np.linalg.lstsq(cov + penalty * np.eye(width), with_y, rcond=1e-12)[0]
    return np.r_[mean[y] - w @ mean[1 : width + 1], w]


def r2(gram: np.ndarray, width: int, target: int, weights: np.ndarray) -> float:
    """R2 of the weights on the rows of a matrix of sums."""
    n, y = gram[0, 0], 1 + width + target
    if not n:
        return float("nan")
    x = gram[: width + 1, : width + 1]
    lost = gram[y, y] - 2 * weights @ gram[: width + 1, y] + weights @ x @ weights
    spread = gram[y, y] - gram[0, y] ** 2 / n
    return float(1 - lost / spread) if spread > 0 else float("nan")


def fold_scores(packed: Packed, folds: int, target: int = 0, penalty: float = 0.0, l1: float = 0.0) -> list[float]:
    """R2 on each fold of the model fitted on the others."""
    return gram_scores(fold_grams(packed, folds), packed.width, target, penalty, l1)


def gram_scores(grams: np.ndarray, width: int, target: int = 0, penalty: float = 0.0, l1: float = 0.0) -> list[float]:
    """The same from the sums of each fold: those a model learns from are the total minus the fold's."""
    total = grams.sum(axis=0)
    return [r2(own, width, target, solve(total - own, width, target, penalty, l1)) for own in grams[:-1]]
