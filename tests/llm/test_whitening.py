import numpy as np
import pytest

from stationflow.llm import whitening as W
from stationflow.llm.queries import op12_whitening


def reference(vectors, count=16):
    """Fit list, exact deviation and whitened values by plain loops and a dense solver."""
    x = [tuple(int(np.floor(64 * float(c))) + 1_000_000 for c in v) for v in vectors]
    fit = np.array(sorted(set(x)), dtype=object)
    n, s = len(fit), fit.sum(axis=0)
    centred = np.array([[float(v) / n for v in r] for r in fit * n - s])
    e, w = np.linalg.eigh(centred.T @ centred / n)
    e, w = e[::-1], w[:, ::-1]
    k = min(count, int((e > 1e-12 * e[0]).sum()))
    rows = np.array(x, dtype=object) * n - s
    white = np.array([[float(v) / n for v in r] for r in rows]) @ w[:, :k] / np.sqrt(e[:k])
    return n, [int(sum(v * v for v in r)) for r in rows], white, e[:k] / e.sum()


def check(got, ids, vectors, count=16, atol=1e-8):
    n, deviation, white, explained = reference(vectors, count)
    assert len(got) == len(ids) * len(explained)
    wide = got.pivot(index="vec_id", columns="component", values="whitened").loc[ids].to_numpy()
    signs = np.sign((wide * white).sum(axis=0))                     # either sign, the same for all rows
    assert np.allclose(wide * signs, white, atol=atol)
    first = got[got.component == 1].set_index("vec_id").loc[ids]
    assert first.deviation.tolist() == deviation and set(got.n) == {n}
    assert np.allclose(got.groupby("component").explained.first(), explained, rtol=1e-10)
    assert got.identity_error.nunique() == 1 and got.identity_error.iloc[0] < 1e-8


def test_query_equals_dense_solver(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").toPandas()
    check(op12_whitening(spark, sf_dir).toPandas(), table.vec_id.tolist(), table.embedding.tolist())


def test_hot_copies_constant_and_dependent_dimensions(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(0, 3, (90, 5))
    v = np.hstack([base, np.round(base[:, :1]) * 2, np.full((90, 1), 0.25)])         # one constant, one on the grid's own lattice
    v[:, 0] = np.round(v[:, 0])
    v = np.vstack([v, np.repeat(v[:1], 60, axis=0)])
    df = spark.createDataFrame([(i, r.tolist(), "c") for i, r in enumerate(v)], "vec_id int, embedding array<double>, x string").repartition(7)
    got = W.whiten(df).toPandas()
    assert got.component.max() == 5
    check(got, list(range(150)), v.tolist(), atol=1e-7)


def test_unusable_rows_and_clashing_columns(spark):
    nan, inf = float("nan"), float("inf")
    good = [[0.5, 1.0, -3.0], [2.0, 0.25, 1.0], [0.5, 1.0, -3.0], [1.0, -1.0, 7.5], [-2.0, 4.0, 0.5]]
    bad = [None, [], [1.0, None, 2.0], [nan, 1.0, 1.0], [1.0, inf, 1.0], [1.0, 2.0]]
    data = [(i, v, i) for i, v in enumerate(good + bad)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>, n int").selectExpr("*", "n AS component", "n AS x", "n AS v", "n AS whitened")
    check(W.whiten(df).toPandas(), list(range(5)), good)
    assert len(W.whiten(df, count=2).toPandas()) == 10


def test_null_and_repeated_ids(spark):
    df = spark.createDataFrame([(None, [1.0, 2.0]), (1, [3.0, 0.0]), (1, [0.0, 1.0]), (None, [5.0, 5.0])], "vec_id long, embedding array<double>")
    got = [r.vec_id for r in W.whiten(df).collect()]
    assert sorted(got, key=str) == [1] * 4 + [None] * 4


@pytest.mark.parametrize("data", [[], [(1, None)], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_nothing_to_whiten(spark, data):
    got = W.whiten(spark.createDataFrame(data, "vec_id long, embedding array<double>"))
    assert got.collect() == [] and got.columns[0] == "vec_id"


def test_exact_sums_beyond_a_long(spark):
    df = spark.createDataFrame([(1, [1e16, 0.0]), (2, [-1e16, 1.0]), (3, [3e15, 5.0]), (4, [1e300, 2.0])], "vec_id long, embedding array<double>")
    got = W.whiten(df).toPandas()
    assert set(got.vec_id) == {1, 2, 3, 4} and got.deviation.isna().all() and np.isfinite(got.whitened).all()


def test_shift_keeps_a_singular_matrix_from_breaking():
    a = np.outer(np.arange(1, 5.0), [1, 2, 3])
    r = W.cholesky_factor(a.T @ a, 4, shift=True)
    assert np.allclose(r.T @ r, a.T @ a, atol=1e-9) and np.allclose(W.triangular_inverse(r) @ r, np.eye(3), atol=1e-6)
