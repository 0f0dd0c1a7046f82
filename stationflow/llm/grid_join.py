"""Embedding near-dedup by an epsilon grid order join.

Vectors of length 1 with a cosine of ``c`` are ``sqrt(2 - 2 c)`` apart; call this epsilon for
the least cosine of a link. Vectors are sorted by the cells (of side epsilon) of their
``LEADING`` principal coordinates, within their label, and the sorted sequence is cut into
blocks. Projections shorten distances, so two blocks whose boxes of principal coordinates are
more than epsilon apart hold no link: only block pairs in the same or adjacent cells of the
first ``PREFIX`` coordinates are formed, and of these only the ones with near boxes. In a
task the two sequences are split recursively with the same test, and what is left is
compared in double precision. The result is exact.

Copies form one class first and go through as one vector. A block pair returns a link count
per vector and as many links as connect its vectors, never a list of pairs, so that a dense
group costs comparisons but no rows. Blocks are bounded by rows and cut hot cells.

The basis is fitted on a bounded sample (``SAMPLE_ROWS`` vectors by a hash); any orthonormal
basis gives the same result, a good one prunes more.

Defined results: rows whose vector is null, empty, zero or holds a null or a non-finite
component, or whose label is null, link with nothing (component: their own id); vectors of
unequal length do not link; repeated rows count as vectors of their own; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, stored
from .components import connected_components

MIN_COSINE = 0.98
LEADING = 16
PREFIX = 2
BLOCK = 512
LEAF = 64
SAMPLE_ROWS = 4096
BATCH_ROWS = 64          # block pairs per Arrow batch: 64 * 2 * 512 rows of vectors
_SLACK = 1e-6            # of distances, above any rounding


def usable(vector: str = "embedding"):
    """Vectors that take part: all components finite, one not zero."""
    v = F.col(vector)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & fine & F.exists(v, lambda x: x != 0), F.lit(False))


def _matrix(column) -> np.ndarray:
    """A list column of equal lengths as a matrix of doubles."""
    return np.asarray(column.flatten()).astype(np.float64).reshape(len(column), -1)


def _unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(axis=1, keepdims=True)             # before squaring: no overflow
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def fit_basis(classes: DataFrame) -> dict:
    """Leading principal directions by vector length, from the sample."""
    rows = classes.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS).select("vector").collect()
    by: dict = {}
    for r in rows:
        by.setdefault(len(r["vector"]), []).append(r["vector"])
    out = {}
    for n, vectors in by.items():
        u = _unit(np.array(vectors, np.float64))
        out[n] = np.linalg.eigh(u.T @ u)[1][:, ::-1][:, :LEADING]
    return out


def blocks_of(classes: DataFrame, basis: dict, eps: float) -> DataFrame:
    """The vectors in epsilon grid order, cut into blocks of one label and length."""

    def place(batches):
        import pyarrow as pa

        for batch in batches:
            cells = [None] * batch.num_rows
            vectors = batch.column("vector")
            size = np.array([len(v) for v in vectors])
            for n in np.unique(size):
                at = np.flatnonzero(size == n)
                y = _unit(_matrix(vectors.take(pa.array(at)))) @ basis.get(int(n), np.eye(n)[:, :LEADING])
                for i, c in zip(at, np.floor(y / eps).astype(np.int32)):
                    cells[i] = c
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(size, pa.int32()), pa.array(cells, pa.list_(pa.int32()))],
                                             names=[*batch.schema.names, "dim", "cells"])

    placed = classes.mapInArrow(place, "vec_id long, label int, vector array<double>, copies long, dim int, cells array<int>")
    order = ["label", "dim", "cells", "vec_id"]
    parts = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = placed.repartitionByRange(parts, *order).sortWithinPartitions(*order)

    def cut(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        number, carry = TaskContext.get().partitionId() << 32, None

        def block(t):
            nonlocal number
            v = _matrix(t.column("vector").combine_chunks())
            y = _unit(v) @ basis.get(v.shape[1], np.eye(v.shape[1])[:, :LEADING])
            cells = np.array([c[:PREFIX] + [0] * (PREFIX - len(c[:PREFIX])) for c in t.column("cells").to_pylist()], np.int32)
            number += 1
            return (number, t.column("label")[0].as_py(), v.shape[1], (y.min(axis=0) - _SLACK).tolist(), (y.max(axis=0) + _SLACK).tolist(),
                    np.unique(cells, axis=0).tolist(), t.column("vec_id").to_numpy().astype("<i8").tobytes(),
                    t.column("copies").to_numpy().astype("<i8").tobytes(), v.astype("<f8").tobytes())

        def emit(t, last):
            """Whole blocks of the rows so far, and what may go on in the next batch."""
            key = np.column_stack([t.column("label").to_numpy(), t.column("dim").to_numpy()])
            edge = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1).tolist(), t.num_rows]
            out = []
            for a, b in zip(edge[:-1], edge[1:]):
                while b - a >= BLOCK or (a < b and (last or b < t.num_rows)):
                    out.append(block(t.slice(a, min(BLOCK, b - a))))
                    a += min(BLOCK, b - a)
            return out, t.slice(a)

        names = ["block", "label", "dim", "lo", "hi", "cells", "ids", "copies", "vectors"]
        kinds = [pa.int64(), pa.int32(), pa.int32(), *[pa.list_(pa.float64())] * 2, pa.list_(pa.list_(pa.int32())), *[pa.binary()] * 3]
        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = pa.concat_tables([carry, t]) if carry is not None and carry.num_rows else t
            rows, carry = emit(t, False)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
        if carry is not None and carry.num_rows:
            rows, _ = emit(carry, True)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return ordered.mapInArrow(cut, "block long, label int, dim int, lo array<double>, hi array<double>, cells array<array<int>>, "
                                   "ids binary, copies binary, vectors binary")


def near_blocks(blocks: DataFrame, eps: float) -> DataFrame:
    """Pairs ``a <= b`` of blocks that may hold a link."""
    own = blocks.select("block", "label", "dim", "lo", "hi", F.explode("cells").alias("cell"))
    near = [F.array(*[F.col("cell")[i] + d for i, d in enumerate(step)]) for step in np.ndindex(*[3] * PREFIX)]
    other = own.select(F.col("block").alias("b"), "label", "dim", F.col("lo").alias("lo_b"), F.col("hi").alias("hi_b"),
                       F.explode(F.array(*near)).alias("cell"))
    own = own.select(F.col("block").alias("a"), "label", "dim", "lo", "hi",
                     F.array(*[F.col("cell")[i] + 1 for i in range(PREFIX)]).alias("cell"))
    pairs = own.join(other, ["label", "dim", "cell"]).filter("a <= b")
    gaps = F.zip_with(F.zip_with("lo_b", "hi", lambda x, y: x - y), F.zip_with("lo", "hi_b", lambda x, y: x - y),
                      lambda x, y: F.greatest(x, y, F.lit(0.0)))
    far = F.aggregate(gaps, F.lit(0.0), lambda s, g: s + g * g)
    return pairs.filter(far <= (eps + _SLACK) ** 2).select("a", "b").distinct()


class Sequences:
    """Two blocks of vectors in grid order, joined recursively."""

    def __init__(self, left, right, same: bool, basis: np.ndarray, cosine: float):
        self.raw, self.same, self.cosine = (left, right), same, cosine
        self.unit = (_unit(left), left if same else None)
        self.unit = (self.unit[0], self.unit[0] if same else _unit(right))
        self.y = tuple(u @ basis for u in self.unit)
        self.eps2 = (math.sqrt(max(0.0, 2 - 2 * cosine)) + _SLACK) ** 2
        self.found: list = []
        self.compared = 0

    def join(self, a: int, b: int, c: int, d: int) -> None:
        """Links of left rows a..b with right rows c..d; those provably distant are skipped."""
        if a >= b or c >= d or self.same and d <= a:
            return
        p, q = self.y[0][a:b], self.y[1][c:d]
        gap = np.maximum(0, np.maximum(q.min(axis=0) - p.max(axis=0), p.min(axis=0) - q.max(axis=0)))
        if gap @ gap > self.eps2:
            return
        if b - a <= LEAF and d - c <= LEAF:
            return self.compare(a, b, c, d)
        m, n = ((a + b) // 2 if b - a > LEAF else b), ((c + d) // 2 if d - c > LEAF else d)
        for i, j in ((a, m), (m, b)):
            for k, last in ((c, n), (n, d)):
                self.join(i, j, k, last)

    def compare(self, a: int, b: int, c: int, d: int) -> None:
        self.compared += (b - a) * (d - c)
        cos = self.unit[0][a:b] @ self.unit[1][c:d].T
        for i, j in np.argwhere(np.abs(cos - self.cosine) < 1e-9):   # too close to call for a product of rounded factors
            x, y = self.raw[0][a + i], self.raw[1][c + j]
            cos[i, j] = (x @ y) / (math.sqrt(x @ x) * math.sqrt(y @ y))
        i, j = np.nonzero(cos >= self.cosine)
        i, j = i + a, j + c
        if self.same:
            i, j = i[i < j], j[i < j]
        self.found.append((i, j))


def join_blocks(pairs: DataFrame, blocks: DataFrame, basis: dict, cosine: float) -> DataFrame:
    """``a, b, n``: link counts (``n`` other vectors of ``a``; ``b`` null) and connecting links
    (``n`` null)."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            out: list = []
            for r in batch.to_pylist():
                ids, copies = (tuple(np.frombuffer(r[c + s], "<i8") for s in "ab") for c in ("ids_", "copies_"))
                left, right = (np.frombuffer(r["vectors_" + s], "<f8").reshape(-1, r["dim"]) for s in "ab")
                same = r["a"] == r["b"]
                s = Sequences(left, right, same, basis.get(r["dim"], np.eye(r["dim"])[:, :LEADING]), cosine)
                s.join(0, len(left), 0, len(right))
                if not s.found:
                    continue
                i, j = (np.concatenate(x) for x in zip(*s.found))
                n = np.bincount(i, copies[1][j], len(left)), np.bincount(j, copies[0][i], len(right))
                if same:
                    n = (n[0] + n[1], n[1] * 0)
                for own, count in zip(ids, n):
                    at = np.flatnonzero(count)
                    out += [(a, None, c) for a, c in zip(own[at].tolist(), count[at].astype(int).tolist())]
                out += [(a, b, None) for a, b in _forest(ids[0][i].tolist(), ids[1][j].tolist())]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in range(3)], names=["a", "b", "n"])

    sides = [blocks.select(F.col("block").alias(s), *([] if s == "b" else ["dim"]),
                           *(F.col(c).alias(f"{c}_{s}") for c in ("ids", "copies", "vectors"))) for s in "ab"]
    return pairs.join(sides[0], "a").join(sides[1], "b").mapInArrow(run, "a long, b long, n long")


def _forest(xs: list, ys: list) -> list:
    root: dict = {}

    def find(v):
        while (p := root.get(v, v)) != v:
            root[v] = root.get(p, p)
            v = p
        return v

    out = []
    for x, y in zip(xs, ys):
        p, q = find(x), find(y)
        if p != q:
            root[max(p, q)] = min(p, q)
            out.append((x, y))
    return out


def near_duplicates(rows: DataFrame, cosine: float = MIN_COSINE, vector: str = "embedding") -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``. Links join vectors of one
    label with a cosine of ``cosine`` or more."""
    spark = prepare(rows.sparkSession)
    eps = max(math.sqrt(max(0.0, 2 - 2 * cosine)), 1e-3)
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("int").alias("label"),
                       F.col(vector).cast("array<double>").alias("vector"))
    part = F.col("label").isNotNull() & F.col("vec_id").isNotNull() & usable("vector")
    classes = stored(rows.filter(part).groupBy("label", "vector").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies"))
                     .select("vec_id", "label", "vector", "copies"), "grid-classes")
    basis = fit_basis(classes)
    blocks = stored(blocks_of(classes, basis, eps), "grid-blocks")
    batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    found = stored(join_blocks(near_blocks(blocks, eps), blocks, basis, cosine), "grid-links")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    component = connected_components(found.filter("b IS NOT NULL").select("a", "b"))
    links = found.filter("b IS NULL").groupBy("a").agg(F.sum("n").alias("n"))
    of = classes.select("label", "vector", F.col("vec_id").alias("first"), "copies") \
        .join(links.withColumnRenamed("a", "first"), "first", "left") \
        .join(component.withColumnRenamed("node", "first"), "first", "left") \
        .select("label", "vector", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                F.coalesce("component", "first").alias("component_id"))
    own = rows.withColumn("label", F.when(part, F.col("label")))
    return own.join(of, ["label", "vector"], "left") \
        .select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id")) \
        .withColumn("kept", F.col("component_id").eqNullSafe(F.col("vec_id")))
