"""Embedding whitening by one-sided Jacobi SVD.

Vectors are put on a grid of whole numbers, so that counts and sums are exact. Every task compresses its centred rows to a
triangle R by QR, block after block; triangles meet in a tree of groups of FAN until one is left, which has the column
geometry of all rows without a covariance matrix ever being formed. Plane rotations then make R's columns orthogonal: their
norms are the standard deviations times sqrt(n), accurate down to the small ones, and the accumulated rotations are the
components. Only sums and one triangle, bounded by the dimensions, reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import arrow_pass, stored

#: Steps of the grid in one unit.
GRID = 256
#: Triangles that one task merges, and rows of a block.
FAN, BLOCK = 16, 2048
#: Sweeps of rotations at most; convergence is quadratic, and some ten are the rule.
SWEEPS = 40
#: Whole numbers below this may be multiplied and added in 64 bits.
_SAFE = 1 << 62


@dataclass
class Whitening:
    """n distinct vectors on the grid, their sums by dimension, and of each component (a column) its axis and eigenvalue.

    identity_error: the largest entry of the whitened fit list's covariance less the identity; None without a component.
    """

    n: int
    sums: list[int]
    axes: np.ndarray
    values: np.ndarray
    identity_error: float | None = None

    @property
    def usable(self) -> np.ndarray:
        """Which components have a deviation above rounding."""
        top = math.sqrt(max(self.values, default=0.0))
        return np.sqrt(self.values) > top * len(self.sums) * np.finfo(float).eps

    @property
    def explained(self) -> list[float | None]:
        """Each component's share of the trace; None where all vectors are equal."""
        total = float(self.values.sum())
        return [float(e) / total if total > 0 else None for e in self.values]


def moved(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - sums, exact: in 64 bits, or as Python's numbers where these would not do."""
    if len(x) and max(int(x.max()), -int(x.min())) * n + max(map(abs, sums)) >= _SAFE:
        return x.astype(object) * n - np.array(sums, object)
    return x * n - np.array(sums, np.int64)


def squares(v: np.ndarray) -> list[int]:
    """Sum of squares of each row of whole numbers, exact."""
    if v.dtype == object or (len(v) and int(np.abs(v).max()) ** 2 * v.shape[1] >= _SAFE):
        return [sum(int(c) * int(c) for c in row) for row in v]
    return (v * v).sum(1).tolist()


def triangle(blocks: Iterator[np.ndarray]) -> np.ndarray | None:
    """R of the QR factorisation of all rows of the blocks, one block after another; None without rows."""
    r = None
    for block in blocks:
        if len(block):
            r = np.linalg.qr(block if r is None else np.vstack([r, block]), mode="r")
    return r


def jacobi(r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Singular values, falling, and right singular vectors (as columns) by one-sided rotations of r's columns.

    Columns meet in rounds of disjoint pairs, as in a tournament: each round turns all its pairs at once.
    """
    a, d = np.array(r, np.float64), r.shape[1]
    v = np.eye(d)
    ring = list(range(d + d % 2))  # a bye where d is odd
    close = 4 * math.sqrt(len(a)) * np.finfo(float).eps  # what rounding leaves of a product of orthogonal columns
    for _ in range(SWEEPS):
        turned = False
        for _ in range(len(ring) - 1):
            pairs = [(p, q) for p, q in zip(ring[: len(ring) // 2], ring[::-1], strict=False) if max(p, q) < d]
            ring = [ring[0], ring[-1], *ring[1:-1]]
            if not pairs:
                continue
            p, q = (np.array(side) for side in zip(*pairs, strict=True))
            left, right = a[:, p], a[:, q]
            alpha, beta, gamma = (left * left).sum(0), (right * right).sum(0), (left * right).sum(0)
            skew = np.abs(gamma) > close * np.sqrt(alpha * beta)
            if not skew.any():
                continue
            turned = True
            with np.errstate(over="ignore", divide="ignore"):  # columns of nothing but rounding
                zeta = (beta - alpha)[skew] / (2 * gamma[skew])
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, np.minimum(np.abs(zeta), 1e150)))
            cos = 1 / np.hypot(1.0, t)
            sin, p, q = cos * t, p[skew], q[skew]
            for m in (a, v):
                left, right = m[:, p], m[:, q]
                m[:, p], m[:, q] = cos * left - sin * right, sin * left + cos * right
        if not turned:
            break
    sigma = np.sqrt((a * a).sum(0))
    order = np.argsort(-sigma, kind="stable")
    return sigma[order], v[:, order]


def _rows(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def on_grid(vectors: DataFrame, vec_id: str, embedding: str) -> tuple[DataFrame, int]:
    """(id, x) of the vectors that take part, x in whole steps of the grid, and their dimensions; 0 where none is left."""
    fine = F.forall(embedding, lambda c: F.coalesce((F.abs(c.cast("double")) < float("inf")) & ~F.isnan(c), F.lit(False)))
    good = vectors.where(F.coalesce(fine, F.lit(False)) & (F.size(embedding) > 0))
    x = F.transform(embedding, lambda c: F.floor(F.lit(float(GRID)) * c.cast("double")))
    grid = good.select(F.col(vec_id).alias("id"), x.alias("x"))
    length = grid.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").first()
    return (grid, 0) if length is None else (grid.where(F.size("x") == length["d"]), length["d"])


def _merged(dims: int):
    """One triangle of a group's triangles."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        r = triangle(np.frombuffer(b, np.float64).reshape(-1, dims) for b in group.sort_values("part")["r"])
        return pd.DataFrame({"part": [int(group["part"].iloc[0]) // FAN], "r": [r.tobytes()]})

    return run


def fit_whitening(grid: DataFrame, dims: int, k: int = 4) -> Whitening:
    """The whitening of the distinct vectors x of on_grid(), all components; its identity_error is that of the first k.

    Copies are one vector, met before the shuffle; sums are exact. Sums that a long can't hold are an error.
    """
    fit = stored(grid.select("x").distinct(), "white-fit")
    sums = [r["s"] for r in fit.select(F.posexplode("x")).groupBy("pos").agg(F.sum("col").alias("s")).orderBy("pos").collect()]  # one row a dimension
    n = fit.count()

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        r = triangle((moved(_rows(b.column(0), dims), n, sums) / n).astype(np.float64) for b in batches)
        if r is not None:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([r.tobytes()], pa.binary())], names=["part", "r"])

    left = stored(arrow_pass(fit, compress, "part long, r binary", BLOCK), "white-triangles")
    parts = left.agg(F.max("part")).first()[0] + 1
    while parts > 1:
        left = left.groupBy(F.floor(F.col("part") / FAN).alias("of")).applyInPandas(_merged(dims), "part long, r binary")
        parts = -(-parts // FAN)
    sigma, axes = jacobi(np.frombuffer(left.first()["r"], np.float64).reshape(-1, dims))
    model = Whitening(n, sums, axes, sigma * sigma / n)
    model.identity_error = error_of(fit, model, min(k, dims))
    return model


def projected(model: Whitening, x: np.ndarray, k: int) -> np.ndarray:
    """The first k whitened coordinates of rows x, not a number for components without deviation."""
    with np.errstate(divide="ignore", invalid="ignore"):
        scale = np.where(model.usable[:k], 1 / np.sqrt(model.values[:k]), np.nan)
    return (moved(x, model.n, model.sums) / model.n).astype(np.float64) @ model.axes[:, :k] * scale


def error_of(grid_rows: DataFrame, model: Whitening, k: int) -> float | None:
    """Largest entry of the whitened covariance of distinct vectors (x), first k components, less the identity."""
    dims, kept = len(model.sums), np.nonzero(model.usable[:k])[0].tolist()
    if not kept:
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w = projected(model, _rows(batch.column(0), dims), k)
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(w[:, j])) for j in kept], names=[f"w{j}" for j in kept])

    white = arrow_pass(grid_rows.select("x"), run, ", ".join(f"w{j} double" for j in kept), BLOCK)
    pairs = [(i, j) for i in kept for j in kept if i <= j]
    # covar_pop centres before it multiplies, also where partial results meet
    found = white.agg(*(F.abs(F.covar_pop(f"w{i}", f"w{j}") - float(i == j)).alias(f"c{i}_{j}") for i, j in pairs)).first()
    return max(found)


def whiten(grid: DataFrame, model: Whitening, k: int = 4) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: for each row of on_grid() and each of the first k components.

    deviation is exact, of type decimal(38, 0); whitened is null for a component without deviation.
    """
    dims, explained = len(model.sums), model.explained
    k = min(k, dims)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _rows(batch.column(1), dims)
            w, rows = projected(model, x, k), np.repeat(np.arange(len(x)), k)
            apart = pa.array(squares(moved(x, model.n, model.sums)), pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), apart.take(pa.array(rows)), pa.array(w.reshape(-1), from_pandas=True)],
                names=["vec_id", "component", "deviation", "whitened"],
            )

    kind = grid.schema["id"].dataType.simpleString()
    out = arrow_pass(grid.select("id", "x"), run, f"vec_id {kind}, component int, deviation decimal(38,0), whitened double", BLOCK)
    shares = F.element_at(F.array(*(F.lit(e).cast("double") for e in explained[:k])), F.col("component"))
    return out.select("vec_id", "component", F.lit(model.n).cast("long").alias("n"), "deviation", "whitened", shares.alias("explained"), F.lit(model.identity_error).cast("double").alias("identity_error"))


def whitened(vectors: DataFrame, *, vec_id: str = "vec_id", embedding: str = "embedding", k: int = 4) -> DataFrame:
    """The first k whitened coordinates of every vector, one row for each.

    Vectors that are null, empty or hold null or non-finite entries take no part, nor do those of another length than most
    have (of equally frequent lengths the smaller counts). Each distinct vector counts once in the fit; rows that repeat, or
    have a null id, each get their coordinates. Where all vectors are equal, coordinates, shares and error are null. Without
    vectors the result is empty. Vectors of any length are held whole, a block of them by a task. Other columns aren't read.
    """
    grid, dims = on_grid(vectors, vec_id, embedding)
    if not dims:
        kind = dict(vectors.dtypes)[vec_id]
        return vectors.sparkSession.createDataFrame([], f"vec_id {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double")
    return whiten(grid, fit_whitening(grid, dims, k), k)
