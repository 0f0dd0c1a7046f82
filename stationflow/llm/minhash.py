"""MinHash near-dedup with tensored banding.

A document is the set of its distinct word shingles. ``T`` half keys of ``R`` minhashes are
taken from each of two collections, and the table keys are all ``T * T`` pairs of one half
of each: as many tables as ``T * T`` bands of ``2 R`` rows have, from ``2 T R`` minhashes
instead of ``2 T T R``. A pair is found if some half of either collection agrees. With
``R = 3, T = 9`` a pair at similarity 0.85 is missed with probability 0.0004, at 0.8 0.003.

Whole sets first: documents with the same set form one class (two independent 64-bit sums
over the set), of which one member goes on. Half keys that no other class has are dropped
before pairs are formed, so that most documents send ``2 T`` narrow rows and no more.

Every class is first held against the smallest one of each of its buckets; links are
confirmed on the full sets. Buckets whose members then lie in one component are done. Of the
rest, those of up to ``SMALL`` members list their pairs between different components. Larger
ones (groups of near copies of which not all are linked) are joined into groups by shared
buckets, cut into blocks of about ``BLOCK`` classes, and each two blocks meet in one task,
which confirms all of their candidate pairs on the full sets and returns only as many links
as connect them. No bucket is capped, and no list of all pairs of a group is made.

Defined results: null texts and texts without words have an empty set, link with nothing and
are kept; a text with fewer words than a shingle is one shingle; repeated rows share a
component; a null ``doc_id`` is never the smallest of a component; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_table, mix64, odd_constants, prepare, slices, stored
from .components import connected_components

T, R = 9, 3
SMALL = 16
BLOCK = 256
SLICE_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15


@lru_cache(maxsize=2)
def _powers(n: int):
    """Powers of the hash base and of its inverse modulo 2**64."""
    inverse = pow(_BASE, -1, 1 << 64)
    return tuple(np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n, x, np.uint64), dtype=np.uint64)])
                 for x in (_BASE, inverse))


def shingle_sets(texts: list, words: int) -> list[np.ndarray]:
    """The sorted distinct 64-bit hashes of each text's word shingles. A-Z is lower-cased;
    words are runs of bytes other than white space (9-13, 32)."""
    data = [(t or "").encode("utf-8", "replace").lower() for t in texts]
    out = []
    for lo, hi in slices([len(d) + 1 for d in data], SLICE_BYTES):
        out += _shingles(data[lo:hi], words)
    return out


def _shingles(data: list[bytes], k: int) -> list[np.ndarray]:
    buf = np.frombuffer(b" ".join(data) + b" ", np.uint8)
    n = len(buf)
    power, inverse = _powers(1 << max(20, n.bit_length()))
    space = (buf == 32) | ((buf >= 9) & (buf <= 13))
    edge = np.flatnonzero(np.diff(space, prepend=True, append=True))
    start, end = edge[0::2], edge[1::2]
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(byte_table()[buf] * power[:n], dtype=np.uint64, out=total[1:])
    word = mix64((total[end] - total[start]) * inverse[start])
    first = np.cumsum([0] + [len(d) + 1 for d in data])
    of = np.searchsorted(start, first)                       # the first word of each text
    c = odd_constants(k, 5)
    whole = mix64(sum(word[i: len(word) - k + 1 + i] * c[i] for i in range(k))) if len(word) >= k else word[:0]
    sets = []
    for a, b in zip(of[:-1], of[1:]):
        if b - a >= k:
            sets.append(np.unique(whole[a: b - k + 1]))
        elif b > a:
            sets.append(mix64((word[a:b] * c[: b - a]).sum(dtype=np.uint64, keepdims=True) + np.uint64(b - a)))
        else:
            sets.append(word[:0])
    return sets


def signatures(sets: list[np.ndarray], t: int = T, r: int = R):
    """Two class sums and the two collections of half keys for non-empty sets."""
    flat = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    sums = [np.add.reduceat(mix64(flat ^ x), starts) for x in odd_constants(2, 21)]
    mul, xor = odd_constants(2 * t * r, 31), odd_constants(2 * t * r, 32)
    halves = np.empty((2 * t, len(sets)), np.uint64)
    for i in range(2 * t):
        key = np.full(len(sets), i + 1, np.uint64)
        for j in range(i * r, i * r + r):
            key = mix64(key * np.uint64(_BASE) ^ np.minimum.reduceat((flat ^ xor[j]) * mul[j], starts))
        halves[i] = key
    return sums, halves


def _signed(x):
    return x.astype("<u8").view("<i8")


def sketch(docs: DataFrame, words: int, t: int = T, r: int = R) -> DataFrame:
    """``doc_id, n`` (set size), ``node, check`` (class sums) and half keys ``ha, hb``."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            sets = shingle_sets(batch.column("text").to_pylist(), words)
            n = np.array([len(s) for s in sets], np.int64)
            at = np.flatnonzero(n)
            node, check = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
            halves = [[None] * len(n), [None] * len(n)]
            for lo, hi in slices(n[at].tolist(), SLICE_BYTES // 4):
                own = at[lo:hi]
                (s1, s2), keys = signatures([sets[i] for i in own], t, r)
                node[own], check[own] = _signed(s1), _signed(s2)
                for h, part in enumerate((keys[:t], keys[t:])):
                    for i, row in zip(own, _signed(np.ascontiguousarray(part.T))):
                        halves[h][i] = row
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n), pa.array(node, mask=n == 0), pa.array(check, mask=n == 0),
                 *(pa.array(h, pa.list_(pa.int64())) for h in halves)],
                names=["doc_id", "n", "node", "check", "ha", "hb"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text") \
        .mapInArrow(run, "doc_id long, n long, node long, check long, ha array<long>, hb array<long>")


def _shared_halves(classes: DataFrame, side: str) -> DataFrame:
    """Per class, the half keys of one collection that another class has too."""
    halves = classes.select("node", F.explode(side).alias("half"))
    common = halves.groupBy("half").agg(F.count("*").alias("c")).filter("c > 1").select("half")
    return halves.join(common, "half").groupBy("node").agg(F.collect_list("half").alias(side))


def buckets(classes: DataFrame) -> DataFrame:
    """``key, node, n, lead, n_lead`` of all buckets with two classes or more."""
    pairs = _shared_halves(classes, "ha").join(_shared_halves(classes, "hb"), "node").join(classes.select("node", "n"), "node") \
        .select("node", "n", F.explode("ha").alias("x"), "hb").select("node", "n", "x", F.explode("hb").alias("y")) \
        .select(F.xxhash64("x", "y").alias("key"), "node", "n")
    lead = pairs.groupBy("key").agg(F.min(F.struct("node", "n")).alias("l"), F.count("*").alias("c")).filter("c > 1")
    return pairs.join(lead.select("key", F.col("l.node").alias("lead"), F.col("l.n").alias("n_lead")), "key")


def _ordered(pairs: DataFrame, percent: int) -> DataFrame:
    """Pairs ``(a, na, b, nb)`` whose sizes allow the similarity, once each, ``x < y``."""
    near = F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent
    return pairs.filter((F.col("a") != F.col("b")) & near) \
        .select(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y")).distinct()


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``x, y, linked`` for ``pairs(x, y)``: ``100 * intersection >= percent * union`` on
    the full sets."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            linked = []
            for a, b in zip(batch.column("sx"), batch.column("sy")):
                a, b = (np.frombuffer(v.as_buffer(), "<u8") for v in (a, b))
                both = len(np.intersect1d(a, b, assume_unique=True))
                linked.append(100 * both >= percent * (len(a) + len(b) - both))
            yield pa.RecordBatch.from_arrays([batch.column("x"), batch.column("y"), pa.array(linked, pa.bool_())],
                                             names=["x", "y", "linked"])

    left, right = (sets.select(F.col("node").alias(v), F.col("shingles").alias(f"s{v}")) for v in "xy")
    return pairs.join(left, "x").join(right, "y").select("x", "y", "sx", "sy").mapInArrow(run, "x long, y long, linked boolean")


def full_sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """``node, shingles`` (packed hashes) of the classes ``wanted(doc_id, node)``. A row
    whose set is not that class (another text under the same ``doc_id``) is left out."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            sets = shingle_sets(batch.column("text").to_pylist(), words)
            nodes = batch.column("node").to_pylist()
            sums = [_signed(np.add.reduce(mix64(s ^ odd_constants(2, 21)[0]), keepdims=True))[0] if len(s) else None for s in sets]
            keep = [i for i, (a, b) in enumerate(zip(nodes, sums)) if a == b]
            yield pa.RecordBatch.from_arrays([pa.array([nodes[i] for i in keep], pa.int64()),
                                              pa.array([sets[i].astype("<u8").tobytes() for i in keep], pa.binary())],
                                             names=["node", "shingles"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(wanted, "doc_id") \
        .select("node", "text").mapInArrow(run, "node long, shingles binary")


def _candidates(rows: dict, left: np.ndarray, right: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs share a half key of either collection, lie in different components and
    have sizes that allow a link."""
    ok = rows["component"][left][:, None] != rows["component"][right][None]
    a, b = rows["n"][left][:, None], rows["n"][right][None]
    ok &= np.minimum(a, b) * 100 >= np.maximum(a, b) * percent
    for side in ("ha", "hb"):
        shared = np.zeros(ok.shape, bool)
        for i in range(rows[side].shape[1]):
            shared |= rows[side][left, i][:, None] == rows[side][right, i][None]
        ok &= shared
    return ok


def _intersections(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, columns: int = 8192) -> np.ndarray:
    """Sizes of the intersections of each left with each right set, some elements at a time."""
    flat = np.concatenate(sets)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, of, times = np.unique(flat, return_inverse=True, return_counts=True)
    rank = np.cumsum(times > 1) - 1                              # elements of two sets or more
    keep = times[of] > 1
    row, of = row[keep], rank[of[keep]]
    order = np.argsort(of, kind="stable")
    row, of = row[order], of[order]
    both = np.zeros((len(left), len(right)), np.float64)
    total = int(of[-1]) + 1 if len(of) else 0
    for at in range(0, total, columns):
        a, b = np.searchsorted(of, (at, at + columns))
        has = np.zeros((len(sets), min(columns, total - at)), np.float32)
        has[row[a:b], of[a:b] - at] = 1
        both += has[left] @ has[right].T
    return both


def _connecting(nodes, component, x, y) -> list:
    """A subset of the links that connects the same components as all of them."""
    root: dict = {}

    def find(c):
        while root.get(c, c) != c:
            root[c] = root.get(root[c], root[c])
            c = root[c]
        return c

    out = []
    for a, b in zip(x, y):
        p, q = find(component[a]), find(component[b])
        if p != q:
            root[max(p, q)] = min(p, q)
            out.append((nodes[a], nodes[b]))
    return out


def dense_links(members: DataFrame, percent: int) -> DataFrame:
    """Links ``a, b`` that connect the components among ``members(group, node, component, n,
    ha, hb, shingles)``, found by comparing the blocks of each group two by two."""
    size = members.groupBy("group").agg(F.ceil(F.count("*") / BLOCK).cast("long").alias("blocks"))
    rows = members.join(size, "group").withColumn("block", F.pmod(F.xxhash64("node"), "blocks")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))) \
        .withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")}).drop("blocks", "other")

    def compare(key, table):
        import pyarrow as pa

        i, j = key[1].as_py(), key[2].as_py()
        block = table.column("block").to_numpy()
        left = np.flatnonzero(block == i)
        right = left if i == j else np.flatnonzero(block == j)
        rows = {c: table.column(c).to_numpy() for c in ("node", "component", "n")}
        rows |= {c: np.array(table.column(c).to_pylist(), np.int64) for c in ("ha", "hb")}
        out = []
        if len(left) and len(right):
            ok = _candidates(rows, left, right, percent)
            if ok.any():
                sets = [np.frombuffer(v.as_buffer(), "<u8") for v in table.column("shingles")]
                both = _intersections(sets, left, right)
                union = rows["n"][left][:, None] + rows["n"][right][None] - both
                x, y = np.nonzero(ok & (100 * both >= percent * union))
                out = _connecting(rows["node"].tolist(), rows["component"].tolist(), left[x].tolist(), right[y].tolist())
        return pa.table({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})

    return rows.groupBy("group", "i", "j").applyInArrow(compare, "a long, b long")


def link_components(docs: DataFrame, classes: DataFrame, words: int, percent: int) -> DataFrame:
    """``node, component`` of the classes that have a link to another one."""
    members = stored(buckets(classes), "minhash-buckets")
    wanted = members.select("node").distinct().join(classes.select("node", "doc_id"), "node")
    sets = stored(full_sets(docs, wanted, words).dropDuplicates(["node"]), "minhash-sets")
    star = _ordered(members.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("lead").alias("b"),
                                   F.col("n_lead").alias("nb")), percent)
    tried = stored(confirm(star, sets, percent), "minhash-tried")
    links = tried.filter("linked").select(F.col("x").alias("a"), F.col("y").alias("b"))
    found = connected_components(links)

    rest = members.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    open_ = rest.groupBy("key").agg(F.count("*").alias("c"), F.min("component").alias("lo"), F.max("component").alias("hi")) \
        .filter("lo <> hi").select("key", "c")
    rest = stored(rest.join(open_, "key"), "minhash-open")
    few = rest.filter(F.col("c") <= SMALL).select("key", "component", F.col("node").alias("a"), F.col("n").alias("na"))
    other = few.select("key", F.col("component").alias("other"), F.col("a").alias("b"), F.col("na").alias("nb"))
    pairs = _ordered(few.join(other, "key").filter("a < b AND component <> other"), percent)
    small = confirm(pairs.join(tried.select("x", "y"), ["x", "y"], "left_anti"), sets, percent) \
        .filter("linked").select(F.col("x").alias("a"), F.col("y").alias("b"))
    many = rest.filter(F.col("c") > SMALL)
    groups = connected_components(many.select(F.col("node").alias("a"), F.col("lead").alias("b")))
    dense = many.select("node", "component").distinct() \
        .join(groups.withColumnRenamed("component", "group"), "node") \
        .join(classes.select("node", "n", "ha", "hb"), "node").join(sets, "node")
    return connected_components(links.union(small).union(dense_links(dense, percent)))


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, t: int = T, r: int = R) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``. Links join
    documents whose word shingle sets have a similarity of ``percent`` / 100 or more."""
    prepare(docs.sparkSession)
    rows = stored(sketch(docs, words, t, r), "minhash-sketch")
    classes = rows.filter("n > 0").groupBy("node", "check") \
        .agg(F.min("doc_id").alias("doc_id"), *(F.first(c).alias(c) for c in ("n", "ha", "hb")))
    classes = stored(classes, "minhash-classes")
    found = link_components(docs, classes, words, percent)
    of = classes.select("node", "doc_id").join(found, "node", "left") \
        .select("node", "doc_id", F.coalesce("component", "node").alias("component"))
    least = of.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    of = of.join(least, "component").select("node", "component_id")
    out = rows.select("doc_id", "n", "node").join(of, "node", "left")
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      component.eqNullSafe(F.col("doc_id")).alias("kept"))
