"""Approximate nearest neighbours by a hierarchical k-means tree.

The tree is fitted on a bounded sample (``SAMPLE_ROWS`` vectors by a hash) and every vector is
put into the leaf it descends to. A search walks the tree best-bin-first: a priority queue
holds the branches passed by, nearest centre first, and leaves are visited until enough of
them have been seen. How many are enough is calibrated: for ``CALIBRATION`` sample vectors the
exact neighbours are found by brute force, and the number of visits is widened until the
leaves visited hold ``RECALL`` of them. Within a leaf all distances are exact.

Copies form one entry, with the ids that can matter (the ``k + 1`` smallest; they are cut per
map task before the shuffle), and queries with the same vector are one search, so that a
vector with a third of all rows costs no more than any other. Leaves above ``LEAF_ROWS``
entries are searched in parts, and the searches that visit a leaf are dealt into blocks of about
``QUERY_BLOCK``; each part meets each block in a group of its own. A part answers with one row
per search; the parts of a search are merged in one group.

Defined results: vectors that are null, empty, zero, hold a null or a non-finite component,
or have another length than most, take no part, neither as queries nor as candidates; ties go
to the smaller ``vec_id``; repeated rows are candidates of their own, but a query never finds
its own id; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import groups_for, prepare, stored
from .grid_join import _matrix, usable

BRANCHES = 8
LEAF_ROWS = 256          # entries of a leaf aimed at, and of the parts of a larger one
QUERY_BLOCK = 4096       # searches that a part of a leaf answers at once
SAMPLE_ROWS = 8192
SAMPLE_LEAF = 8          # sample vectors a leaf has at least: bounds the tree by the sample
CALIBRATION = 64
RECALL = 0.97


class Tree:
    """Centres by node; ``first[n]`` is the first of the consecutive children of node ``n``
    (or -1) and ``leaf[n]`` its leaf number (or -1)."""

    def __init__(self, sample: np.ndarray, leaf_rows: int):
        self.centre, self.first, self.count, self.leaf = [sample.mean(axis=0)], [-1], [0], [-1]
        self.leaves = 0
        todo = [(0, sample)]
        while todo:
            node, own = todo.pop(0)
            parts = self._split(own) if len(own) > leaf_rows else [own]
            if len(parts) < 2:
                self.leaf[node], self.leaves = self.leaves, self.leaves + 1
                continue
            self.first[node], self.count[node] = len(self.centre), len(parts)
            for p in parts:
                todo.append((len(self.centre), p))
                self.centre.append(p.mean(axis=0))
                self.first.append(-1)
                self.count.append(0)
                self.leaf.append(-1)
        self.centre = np.array(self.centre)

    @staticmethod
    def _split(x: np.ndarray) -> list[np.ndarray]:
        """k-means with spread-out first centres."""
        centre = x[:1]
        for _ in range(BRANCHES - 1):
            far = _squares(x, centre).min(axis=1)
            if far.max() <= 0:
                break
            centre = np.vstack([centre, x[far.argmax()]])
        for _ in range(8):
            of = _squares(x, centre).argmin(axis=1)
            centre = np.array([x[of == c].mean(axis=0) for c in np.unique(of)])
        of = _squares(x, centre).argmin(axis=1)
        return [x[of == c] for c in np.unique(of)]

    def place(self, x: np.ndarray) -> np.ndarray:
        """The leaf each vector descends to."""
        node = np.zeros(len(x), np.int64)
        first, count, leaf = np.array(self.first), np.array(self.count), np.array(self.leaf)
        while (inner := leaf[node] < 0).any():
            for n in np.unique(node[inner]):
                at = np.flatnonzero(node == n)
                node[at] = first[n] + _squares(x[at], self.centre[first[n]: first[n] + count[n]]).argmin(axis=1)
        return leaf[node]

    def visits(self, q: np.ndarray):
        """Leaves in best-bin-first order."""
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            while self.leaf[node] < 0:
                a, b = self.first[node], self.first[node] + self.count[node]
                far = _squares(q[None], self.centre[a:b])[0]
                best = int(far.argmin())
                for c in range(b - a):
                    if c != best:
                        heapq.heappush(queue, (float(far[c]), a + c))
                node = a + best
            yield self.leaf[node]


def _squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.maximum(0, (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None] - 2 * (x @ y.T))


def nearest_in(queries: np.ndarray, x: np.ndarray, k: int):
    """Per query, positions and exact distances of at least its ``k`` nearest rows of ``x``
    (all that tie within rounding of the product form)."""
    xx, qq = (x * x).sum(axis=1), (queries * queries).sum(axis=1)
    out = []
    for at in range(0, len(queries), 256):
        rough = qq[at: at + 256, None] + xx[None] - 2 * (queries[at: at + 256] @ x.T)
        bound = np.partition(rough, k - 1, axis=1)[:, k - 1] if len(x) > k else np.full(len(rough), np.inf)
        slack = 1e-10 * (qq[at: at + 256] + xx.max())
        for q, r, b in zip(queries[at: at + 256], rough, bound + slack):
            near = np.flatnonzero(r <= b)
            out.append((near, np.sqrt(((x[near] - q) ** 2).sum(axis=1))))
    return out


def entries(rows: DataFrame, k: int) -> DataFrame:
    """``entry`` (smallest id), ``vector`` and the ``k + 1`` smallest ``ids`` of each distinct
    vector."""
    turn = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    few = rows.withColumn("_turn", turn).filter(F.col("_turn") <= k + 1)
    return few.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")) \
        .select(F.col("ids")[0].alias("entry"), "vector", "ids")


def _packed(ids, distances, k: int) -> tuple[bytes, bytes]:
    """The ``k + 1`` best candidates, nearest first, ties to the smaller id."""
    ids, distances = np.asarray(ids, "<i8"), np.asarray(distances, "<f8")
    order = np.lexsort((ids, distances))[: k + 1]
    return ids[order].tobytes(), distances[order].tobytes()


def calibrate(tree: Tree, placed: DataFrame, k: int, recall: float, size: np.ndarray) -> int:
    """Leaves to visit so that they hold ``recall`` of the exact neighbours of a bounded
    sample of vectors, found by brute force over all entries in blocks."""
    picked = placed.orderBy(F.xxhash64("entry", F.lit(2)), "entry").limit(CALIBRATION).select("vector").toPandas()
    queries = np.array(picked["vector"].tolist(), np.float64)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            leaf = batch.column("leaf").to_numpy()
            out = []
            for i, (near, far) in enumerate(nearest_in(queries, _matrix(batch.column("vector")), k + 1)):
                best = np.argsort(far, kind="stable")[: k + 1]
                out.append((i, leaf[near[best]].tolist(), far[best].tolist()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.list_(pa.int64()), pa.list_(pa.float64())))],
                                             names=["query", "leaves", "far"])

    near = placed.select("vector", "leaf").mapInArrow(run, "query int, leaves array<long>, far array<double>") \
        .select("query", F.explode(F.arrays_zip("leaves", "far")).alias("x")).select("query", F.col("x.leaves").alias("leaf"), F.col("x.far").alias("far"))
    turn = F.row_number().over(Window.partitionBy("query").orderBy("far", "leaf"))
    found = near.withColumn("turn", turn).filter((F.col("turn") > 1) & (F.col("turn") <= k + 1)).select("query", "leaf").collect()
    order = [{leaf: i for i, leaf in enumerate(x for x in tree.visits(q) if size[x])} for q in queries]
    ranks = np.sort([order[r["query"]][r["leaf"]] for r in found])
    return int(ranks[max(0, int(np.ceil(recall * len(ranks))) - 1)]) + 1 if len(ranks) else 1


def search(rows: DataFrame, queries: DataFrame, k: int = 10, recall: float = RECALL, vector: str = "embedding") -> DataFrame:
    """The ``k`` nearest of ``rows(vec_id, embedding)`` for each row of ``queries`` (which are
    rows of it): ``query_id, rank, vec_id, score`` (Euclidean distance)."""
    prepare(rows.sparkSession)
    kind = "query_id long, rank int, vec_id long, score double"

    def clean(df):
        df = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
        return df.filter(F.col("vec_id").isNotNull() & usable("vector"))

    rows = clean(rows)
    most = rows.groupBy(F.size("vector").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    if most is None:
        return rows.sparkSession.createDataFrame([], kind)
    rows, queries = (df.filter(F.size("vector") == most["dim"]) for df in (rows, clean(queries)))
    every = stored(entries(rows, k), "ann-entries")
    n = every.count()
    sample = every.orderBy(F.xxhash64("entry"), "entry").limit(SAMPLE_ROWS).select("vector").toPandas()
    sample = np.array(sample["vector"].tolist(), np.float64)
    tree = Tree(sample, max(SAMPLE_LEAF, int(len(sample) * LEAF_ROWS / n)))

    def place(batches):
        import pyarrow as pa

        for batch in batches:
            leaf = tree.place(_matrix(batch.column("vector")))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf, pa.int64())], names=[*batch.schema.names, "leaf"])

    placed = stored(every.mapInArrow(place, "entry long, vector array<double>, ids array<long>, leaf long"), "ann-leaves")
    size = np.zeros(tree.leaves, np.int64)                                # at most one number per leaf of the tree
    for r in placed.groupBy("leaf").count().collect():
        size[r["leaf"]] = r["count"]
    wanted = calibrate(tree, placed, k, recall, size)
    parts = np.maximum(1, -(-size // (4 * LEAF_ROWS)))

    def walk(batches):
        import pyarrow as pa

        for batch in batches:
            out = []
            for q in _matrix(batch.column("vector")):
                leaves, held = [], 0
                for leaf in tree.visits(q):
                    if not size[leaf]:
                        continue
                    leaves.append(leaf)
                    held += size[leaf]
                    if len(leaves) >= wanted and held > k:                # wide enough, and never fewer than asked for
                        break
                out.append(leaves)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(pa.int64()))], names=[*batch.schema.names, "leaves"])

    asked = queries.join(every.select("vector", "entry"), "vector").select(F.col("vec_id").alias("query_id"), "entry")
    asked = stored(asked.distinct(), "ann-queries")
    walked = stored(asked.select("entry").distinct().join(every.select("entry", "vector"), "entry")
                    .mapInArrow(walk, "entry long, vector array<double>, leaves array<long>"), "ann-visits")
    visits = walked.select("entry", "vector", F.explode("leaves").alias("leaf"))
    blocks = np.ones(tree.leaves, np.int64)
    for r in visits.groupBy("leaf").count().collect():
        blocks[r["leaf"]] = groups_for(r["count"], QUERY_BLOCK)

    def of(numbers):                                                      # one number per leaf of the tree
        return F.element_at(F.array(*[F.lit(int(n)) for n in numbers]), (F.col("leaf") + 1).cast("int")) if numbers.max() > 1 else F.lit(1)

    bins = visits.withColumn("block", F.pmod(F.xxhash64("entry", F.lit(3)), of(blocks)).cast("long")) \
        .withColumn("part", F.explode(F.sequence(F.lit(0), of(parts) - 1))).withColumn("part", F.col("part").cast("long"))
    held = placed.withColumn("part", F.pmod(F.xxhash64("entry"), of(parts)).cast("long")) \
        .withColumn("block", F.explode(F.sequence(F.lit(0), of(blocks) - 1))).withColumn("block", F.col("block").cast("long"))

    def compare(key, found, asked):
        import pyarrow as pa

        out = []
        if found.num_rows and asked.num_rows:
            x, ids = _matrix(found.column("vector").combine_chunks()), found.column("ids").to_pylist()
            near = nearest_in(_matrix(asked.column("vector").combine_chunks()), x, k + 1)
            for entry, (at, far) in zip(asked.column("entry").to_pylist(), near):
                each = [len(ids[i]) for i in at]
                out.append((entry, *_packed([v for i in at for v in ids[i]], np.repeat(far, each), k)))
        columns = zip(*out) if out else [[]] * 3
        return pa.table({c: pa.array(v, t) for (c, t), v in zip((("entry", pa.int64()), ("ids", pa.binary()), ("far", pa.binary())), columns)})

    def merge(key, table):
        import pyarrow as pa

        ids = np.concatenate([np.frombuffer(b, "<i8") for b in table.column("ids").to_pylist()])
        far = np.concatenate([np.frombuffer(b, "<f8") for b in table.column("far").to_pylist()])
        order = np.lexsort((ids, far))[: k + 1]
        return pa.table({"entry": pa.array([key[0].as_py()], pa.int64()), "ids": pa.array([ids[order]], pa.list_(pa.int64())),
                         "far": pa.array([far[order]], pa.list_(pa.float64()))})

    found = held.groupBy("leaf", "part", "block").cogroup(bins.groupBy("leaf", "part", "block")).applyInArrow(compare, "entry long, ids binary, far binary") \
        .groupBy("entry").applyInArrow(merge, "entry long, ids array<long>, far array<double>")
    other = F.filter(F.arrays_zip("ids", "far"), lambda x: x["ids"] != F.col("query_id"))
    return asked.join(found, "entry").select("query_id", F.posexplode(F.slice(other, 1, k)).alias("pos", "x")) \
        .select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("x.ids").alias("vec_id"), F.col("x.far").alias("score"))


def search_embeddings(rows: DataFrame) -> DataFrame:
    return search(rows, rows.filter(F.col("vec_id") % 100 == 0))
