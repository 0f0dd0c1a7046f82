"""Level-wise trees against a plain recursive one."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stationflow.operators import extra_trees as et


def plain(x, y, tree, seed, depth, max_features, min_leaf, node=0, level=0):
    """The same tree, grown node by node on the rows."""
    d = x.shape[1]
    best = None
    if level < depth and len(y) >= 2 * min_leaf:
        lo, hi = x.min(axis=0), x.max(axis=0)
        tried = sorted((float(et.draw(seed, tree, node, f, 1)), f) for f in range(d) if hi[f] > lo[f])[:max_features]
        for f in sorted(f for _, f in tried):
            cut = lo[f] + float(et.draw(seed, tree, node, f, 2)) * (hi[f] - lo[f])
            left = x[:, f] <= cut
            if min(left.sum(), (~left).sum()) >= min_leaf:
                gain = y[left].sum() ** 2 / left.sum() + y[~left].sum() ** 2 / (~left).sum() - y.sum() ** 2 / len(y)
                if gain > 1e-12 * max(1.0, y.sum() ** 2 / len(y)) and (best is None or gain > best[0] + 1e-9):
                    best = (gain, f, cut, left)
    if best is None:
        return float(y.mean())
    _, f, cut, left = best
    grow = lambda m, child: plain(x[m], y[m], tree, seed, depth, max_features, min_leaf, child, level + 1)
    return f, cut, grow(left, 2 * node + 1), grow(~left, 2 * node + 2)


def walk(node, row):
    while isinstance(node, tuple):
        f, cut, a, b = node
        node = a if row[f] <= cut else b
    return node


@pytest.mark.parametrize("max_features", [4, 2])
def test_equals_the_recursive_trees(spark, max_features):
    rng = np.random.default_rng(3)
    x = rng.normal(0, 1, (300, 4))
    x[:, 2] = np.round(x[:, 2])
    x[:, 3] = 5.0                                                   # constant
    y = np.where(x[:, 0] > 0, 3.0, -1.0) + x[:, 1] + rng.normal(0, 0.1, 300)
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)], "a double, b double, c double, d double, y double")
    extra = spark.createDataFrame([(None, 1.0, 1.0, 5.0, 2.0), (float("nan"), 1.0, 1.0, 5.0, 2.0)], df.schema)
    forest = et.fit_extra_trees(df.unionByName(extra).repartition(6), ["a", "b", "c", "d"], "y", trees=3, depth=4, max_features=max_features, min_leaf=5, seed=11)
    want = [plain(x, y, t, 11, 4, max_features, 5) for t in range(3)]
    assert np.allclose(forest.forecast(x), [np.mean([walk(w, r) for w in want]) for r in x])
    got = forest.predict(df.unionByName(extra)).collect()
    assert np.allclose([r.pred for r in got[:300]], forest.forecast(x)) and [r.pred for r in got[300:]] == [None, None]
    assert 1 - ((forest.forecast(x) - y) ** 2).sum() / ((y - y.mean()) ** 2).sum() > 0.7


def test_few_equal_and_no_rows(spark):
    df = spark.createDataFrame([(1.0, 2.0)] * 9, "a double, y double")
    assert et.fit_extra_trees(df, ["a"], "y", trees=2, depth=3).forecast(np.array([[7.0]])).tolist() == [2.0]
    assert et.fit_extra_trees(df.limit(0), ["a"], "y", trees=2, depth=3).forecast(np.array([[7.0]])).tolist() == [0.0]
    assert et.fit_extra_trees(df, ["a"], "y", trees=1, depth=2).predict(df.withColumn("z", F.lit("k"))).columns == ["a", "y", "z", "pred"]
