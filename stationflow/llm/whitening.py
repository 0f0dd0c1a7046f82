"""Embedding whitening by shifted CholeskyQR.

The vectors are put on an integer grid, the distinct ones are the fit list, and their
exact integer sums give the centre, so rows are centred before anything is multiplied.
Each pass over the fit list adds up the Gram matrix of the centred rows, taken through the
triangular solves of the passes before, one partial matrix per partition; its Cholesky
factor (of the matrix with a small shift where it is near singular, as in the first pass)
is the next triangular factor. After a few passes the rows are orthonormal, the product R
of the factors has the singular values and right vectors of the whole centred table, and an
SVD of the small R gives the components. A last pass over the fit list measures the
whitened covariance. Only numbers by dimension (sums, Gram cells) reach the driver.

Defined results: a row whose vector is null or holds a null or non-finite entry plays no
part; of several vector lengths the most frequent one (ties: the longest) is whitened and
rows of another length, or empty ones, play no part; entries that a long can't hold on the
grid are put at its ends; components without variance are left out, so there may be fewer
than asked for (one distinct vector: none, no rows); ``deviation`` is null where a long
can't hold it; null and repeated ``vec_id`` are carried as they are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, stored

GRID, OFFSET = 64.0, 1_000_000
COMPONENTS = 16
MAX_PASSES = 10
RANK = 1e-12            # eigenvalues below this share of the largest count as none
_LONG = np.iinfo(np.int64)


def usable(df: DataFrame, vec_col: str) -> DataFrame:
    """The rows whose vector is all finite, with the vector as doubles; one length."""
    v = F.col(vec_col).cast("array<double>")
    good = df.withColumn(vec_col, v).filter(
        F.col(vec_col).isNotNull() & (F.size(vec_col) > 0)
        & F.forall(vec_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    top = good.groupBy(F.size(vec_col).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return good.filter(F.size(vec_col) == (top[0] if top else 0))


def on_grid(vec_col: str):
    """The vector's grid point: ``floor(64 c) + 1000000`` for each entry, as longs."""
    lo, hi = F.lit(float(_LONG.min)), F.lit(float(_LONG.max - 2**11))       # doubles below 2^63 end there
    return F.transform(vec_col, lambda c: F.least(F.greatest(F.floor(F.least(F.greatest(c * GRID, lo), hi)).cast("long"), F.lit(_LONG.min)),
                                                  F.lit(_LONG.max - OFFSET)) + OFFSET)


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _fits(bound: int) -> bool:
    return bound < _LONG.max


class Centre:
    """The fit list's size and exact sums; centres grid points without losing a digit."""

    def __init__(self, n: int, sums: list[int], largest: int):
        self.n, self.sums, self.largest = n, sums, largest
        self.small = _fits(2 * n * largest)                          # n*x - S fits into a long
        self.array = np.array(sums, np.int64 if self.small else object)

    def scaled(self, x: np.ndarray) -> np.ndarray:
        """``n*x - S``, exact."""
        return (x if self.small else x.astype(object)) * self.n - self.array

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``x - S/n``, rounded once."""
        scaled = self.scaled(x)
        return (scaled / self.n).astype(float) if self.small else np.array([[float(v) / self.n for v in r] for r in scaled])

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of ``(n*x - S)^2``, exact; None beyond a long."""
        scaled = self.scaled(x)
        reach = max((abs(int(v)) for v in (scaled.max(), scaled.min())), default=0) if scaled.size else 0
        if self.small and _fits(reach * reach * x.shape[1]):
            return (scaled * scaled).sum(axis=1).tolist()
        total = [sum(int(v) ** 2 for v in r) for r in scaled]
        return [t if t <= _LONG.max else None for t in total]


def exact_centre(points: DataFrame) -> Centre:
    """Size and exact sums by dimension of ``points(x)`` (decimals, so no sum overflows)."""
    each = points.select(F.posexplode("x").alias("j", "v"))
    rows = each.groupBy("j").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("v").cast("decimal(20,0)")).alias("s"),
                                 F.max("v").alias("hi"), F.min("v").alias("lo")).orderBy("j").collect()       # a row per dimension
    if not rows:
        return Centre(0, [], 0)
    return Centre(rows[0]["n"], [int(r["s"]) for r in rows], max(max(abs(r["hi"]), abs(r["lo"])) for r in rows))


def gram(points: DataFrame, centre: Centre, through: np.ndarray) -> np.ndarray:
    """Gram matrix of the centred rows times ``through`` (d x k), with the rows' sums as
    the last line: a partial matrix per partition, added up cell by cell."""
    d, k = through.shape

    def partial(batches):
        own = np.zeros((k + 1, k))
        for batch in batches:
            z = centre.centred(_matrix(batch.column(0), d)) @ through
            own[:k] += z.T @ z
            own[k] += z.sum(axis=0)
        yield pa.RecordBatch.from_pydict({"cells": pa.array([own.ravel().tolist()], pa.list_(pa.float64()))})

    cells = points.select("x").mapInArrow(partial, "cells array<double>").select(F.posexplode("cells").alias("cell", "v"))
    out = np.zeros((k + 1) * k)
    for r in cells.groupBy("cell").agg(F.sum("v").alias("v")).collect():      # (k + 1) k numbers
        out[r["cell"]] = r["v"]
    return out.reshape(k + 1, k)


def triangular_inverse(r: np.ndarray) -> np.ndarray:
    """Inverse of an upper triangular matrix by back substitution."""
    d = len(r)
    out = np.zeros((d, d))
    for i in range(d - 1, -1, -1):
        out[i] = (np.eye(d)[i] - r[i, i + 1:] @ out[i + 1:]) / r[i, i]
    return out


def cholesky_factor(g: np.ndarray, n: int, shift: bool) -> np.ndarray:
    """Upper factor of ``g``, or of ``g + s I`` where asked or needed: ``s = 11 (n d +
    d (d + 1)) u |g|``, the bound that keeps the factorisation of a rounded Gram matrix of
    n rows from breaking down."""
    d = len(g)
    s = 11 * (n * d + d * (d + 1)) * np.finfo(float).eps / 2 * np.linalg.norm(g, 2)
    if not shift:
        try:
            return np.linalg.cholesky(g).T
        except np.linalg.LinAlgError:
            pass
    return np.linalg.cholesky(g + s * np.eye(d)).T


def shifted_cholesky_qr(points: DataFrame, centre: Centre) -> np.ndarray:
    """R of the centred table: passes until its rows, taken through the solves so far, have
    singular values of one (or none, in directions without variance)."""
    d = len(centre.sums)
    r, back = np.eye(d), np.eye(d)
    for step in range(MAX_PASSES):
        g = gram(points, centre, back)[:d]
        if step == 0 and not g.any():
            return np.zeros((d, d))
        if step:
            seen = np.linalg.eigvalsh(g)
            if step > 2 and ((np.abs(seen - 1) < 1e-9) | (seen < 1e-9)).all():
                break
        low = np.linalg.eigvalsh(g)[0] <= 1e-9 * np.linalg.norm(g, 2)
        factor = cholesky_factor(g, centre.n, shift=step == 0 or bool(low))
        r = factor @ r
        back = back @ triangular_inverse(factor)
    return r


def components(r: np.ndarray, n: int, count: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Unit eigenvectors (columns) and eigenvalues of the covariance, falling, and its trace.
    The entry of the largest size is positive, so a sign is the same for all rows."""
    _, s, vt = np.linalg.svd(r)
    e = s * s / max(n, 1)
    kept = min(count, int((e > RANK * e[0]).sum()) if len(e) and e[0] > 0 else 0)
    w = vt[:kept].T
    return w * np.sign(w[np.abs(w).argmax(axis=0), np.arange(kept)]), e[:kept], float(e.sum())


def whiten(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", count: int = COMPONENTS) -> DataFrame:
    """A row per usable vector and component: ``vec_id, component`` (from 1), ``n`` (fit
    list), ``deviation``, ``whitened``, ``explained``, ``identity_error``."""
    prepare(df.sparkSession)
    good = usable(df.select(F.col(id_col).alias("vec_id"), F.col(vec_col).alias("v")), "v").select("vec_id", on_grid("v").alias("x"))
    # the copies of a hot vector meet map side first; each distinct point is written once
    points = stored(good.select("x").distinct(), "grid-points")
    centre = exact_centre(points)
    out = f"vec_id {good.schema['vec_id'].dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if not centre.n:
        return df.sparkSession.createDataFrame([], out)
    vectors, e, trace = components(shifted_cholesky_qr(points, centre), centre.n, count)
    k, n, d = len(e), centre.n, len(centre.sums)
    if not k:
        return df.sparkSession.createDataFrame([], out)
    project = vectors / np.sqrt(e)
    seen = gram(points, centre, project) / n
    error = float(np.abs(seen[:k] - np.outer(seen[k], seen[k]) - np.eye(k)).max())
    explained = e / trace

    def project_rows(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1), d)
            rows = len(x)
            yield pa.RecordBatch.from_pydict({
                "vec_id": batch.column(0).take(pa.array(np.repeat(np.arange(rows), k))),
                "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                "n": pa.array(np.full(rows * k, n)),
                "deviation": pa.array([v for v in centre.deviation(x) for _ in range(k)], pa.int64()),
                "whitened": pa.array((centre.centred(x) @ project).ravel()),
                "explained": pa.array(np.tile(explained, rows)),
                "identity_error": pa.array(np.full(rows * k, error))})

    return good.mapInArrow(project_rows, out)
