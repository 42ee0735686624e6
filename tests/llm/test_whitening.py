import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm.queries import op13_whitening
from tessera.llm.whitening import lobpcg, whiten


def exact(vectors):
    """n, deviations, eigenvalues falling and eigenvectors of the integers' covariance."""
    x = np.array([[math.floor(1024 * float(c)) + 100_000 for c in v] for v in vectors], dtype=object)
    n, sums = len(x), x.sum(axis=0)
    far = [int(v) for v in ((n * x - sums) ** 2).sum(axis=1)]
    y = (x - np.array([int(s) / n for s in sums], dtype=object)).astype(float)
    e, v = np.linalg.eigh(y.T @ y / n)
    return n, far, y, e[::-1], v[:, ::-1]


def assert_whitened(got, ids, vectors, k):
    n, far, y, e, v = exact(vectors)
    rows = {(r.vec_id, r.component): r for r in got}
    assert len(got) == len(ids) * k and {r.n for r in got} == {n}
    for j in range(k):
        w = np.array([rows[i, j + 1].whitened for i in ids])
        want = y @ v[:, j] / math.sqrt(e[j])
        want *= np.sign(want @ w)
        assert np.abs(w - want).max() < 1e-6
        assert abs(rows[ids[0], j + 1].explained / (e[j] / e.sum()) - 1) < 1e-9
    assert [rows[i, 1].deviation for i in ids] == far
    assert max(r.identity_error for r in got) < 1e-9
    assert max(r.residual for r in got) <= 1e-12


@pytest.mark.parametrize("d,k", [(3, 8), (64, 8), (300, 5)])
def test_lobpcg(d, k):
    rng = np.random.default_rng(d)
    a = rng.standard_normal((d + 50, d)) * np.linspace(1, 2, d)
    c = a.T @ a
    e, v, residual = lobpcg(lambda b: c @ b, d, k)
    own = np.linalg.eigvalsh(c)[::-1][: min(k, d)]
    assert np.allclose(e, own, rtol=1e-12) and residual <= 1e-12 * e[0]
    assert np.allclose(v.T @ v, np.eye(len(e)), atol=1e-12)
    assert np.linalg.norm(c @ v - v * e, axis=0).max() <= 1e-11 * e[0]


def test_lobpcg_equal_eigenvalues_and_none():
    c = np.diag([5.0, 5.0, 5.0] + [1.0] * 60)
    e, v, _ = lobpcg(lambda b: c @ b, 63, 3)
    assert np.allclose(e, 5) and np.abs(v[3:]).max() < 1e-9
    assert lobpcg(lambda b: 0 * b, 20, 4)[0].max() == 0
    with pytest.raises(ArithmeticError):
        lobpcg(lambda b: c @ b, 63, 3, tolerance=-1.0, rounds=20)


def test_odd_rows(spark):
    rng = np.random.default_rng(3)
    good = [[float(x) for x in rng.standard_normal(5)] for _ in range(40)]
    rows = [(i, v, "a", 1) for i, v in enumerate(good)]
    rows += [(100, None, "a", 1), (101, [], "a", 1), (102, [1.0, None, 0.0, 0.0, 0.0], "a", 1), (103, [float("nan")] * 5, "a", 1), (104, [float("inf")] * 5, "a", 1), (105, [1e300] * 5, "a", 1), (106, [1.0] * 4, "a", 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, x string, n int").repartition(4)
    assert_whitened(whiten(df, components=3).collect(), list(range(40)), good, 3)
    # Repeated and null ids count and come out each; one row, equal rows and no rows have no component.
    twice = whiten(df.union(df).withColumn("vec_id", df.vec_id * 0), components=2)
    assert twice.count() == 160 and twice.first().n == 80
    assert whiten(df.withColumn("vec_id", F.lit(None).cast("long")), components=2).count() == 80
    assert whiten(df.filter("vec_id = 3")).count() == 0
    assert whiten(df.filter("vec_id = 3").union(df.filter("vec_id = 3"))).count() == 0
    assert whiten(df.filter("vec_id > 1000")).count() == 0
    assert whiten(df.filter("vec_id < 3")).select("component").distinct().count() == 2


def test_deviation_beyond_long(spark):
    rows = [(i, [float((-1) ** i * 2**41), float(i)]) for i in range(6)]
    got = whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert got and all(r.deviation is None for r in got)
    fits = whiten(spark.createDataFrame([(i, [float((-1) ** i * 2**17), float(i)]) for i in range(6)], "vec_id long, embedding array<double>")).collect()
    assert sorted({r.deviation for r in fits}) == sorted(set(exact([[(-1) ** i * 2**17, i] for i in range(6)])[1]))


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    assert_whitened(op13_whitening(spark, sf).collect(), [r.vec_id for r in vectors], [r.embedding for r in vectors], 8)
