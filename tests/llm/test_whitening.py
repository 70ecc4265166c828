import math

import numpy as np
import pytest
from pyspark.sql import types as T

from varloom.llm import queries as q
from varloom.llm import whitening as w

SMALL = "/root/testdata/sf0.001"
SCHEMA = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("x", T.StringType()),
        T.StructField("component", T.StringType()),
        T.StructField("whitened", T.StringType()),
    ]
)


def table(spark, rows):
    return spark.createDataFrame([(i, v, "a", None, "b") for i, v in rows], SCHEMA)


@pytest.mark.parametrize("n", [1, 2, 5, 33, 64])
def test_eigen_on_hard_spectra(n):
    rng = np.random.default_rng(n)
    turn = np.linalg.qr(rng.standard_normal((n, n)))[0]
    spectra = [rng.standard_normal(n), np.full(n, 3.0), np.zeros(n), np.repeat([5.0, 1.0], [n // 2, n - n // 2]), np.logspace(0, -18, n)]
    for values in spectra:
        a = (turn * values) @ turn.T
        a = (a + a.T) / 2
        found, vectors = w.eigen(a)
        size = max(np.linalg.norm(a), 1e-300)
        assert np.abs(found - np.linalg.eigvalsh(a)[::-1]).max() <= 1e-14 * size
        assert np.linalg.norm(a @ vectors - vectors * found) <= 1e-14 * size
        assert np.linalg.norm(vectors.T @ vectors - np.eye(n)) <= 1e-13


def test_polar_factor_is_the_matrix_sign():
    rng = np.random.default_rng(1)
    turn = np.linalg.qr(rng.standard_normal((20, 20)))[0]
    values = np.concatenate((np.logspace(-12, 3, 10), -np.logspace(-9, 2, 10)))
    found = w.polar_factor((turn * values) @ turn.T)
    assert np.linalg.norm(found @ found - np.eye(20)) < 1e-12
    assert np.linalg.norm(found - (turn * np.sign(values)) @ turn.T) < 1e-3  # the least eigenvalue is 1e-15 of the largest


def test_query_equals_dense_arithmetic(spark):
    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding").collect()
    x = np.array([[math.floor(64 * float(c)) + 1_000_000 for c in r.embedding] for r in rows], dtype=object)
    n, sums = len(x), x.sum(axis=0)
    deviation = {r.vec_id: int(((n * v - sums) ** 2).sum()) for r, v in zip(rows, x)}
    centred = (x.astype(float) - (sums / n).astype(float))
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    expected = (centred @ vectors[:, :32]) / np.sqrt(values[:32])
    got = q.QUERIES["op12_embedding_whitening"](spark, SMALL)
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint", "int", "bigint", "bigint", "double", "double", "double"]
    got = got.toPandas()
    assert len(got) == n * 32 and set(got["n"]) == {n}
    assert (got["deviation"] == got["vec_id"].map(deviation)).all()
    assert got["identity_error"].nunique() == 1 and 0 <= got["identity_error"].iloc[0] < 1e-9
    wide = got.pivot(index="vec_id", columns="component", values="whitened").loc[[r.vec_id for r in rows]].to_numpy()
    sign = np.sign((wide * expected).sum(axis=0))
    assert np.abs(wide * sign - expected).max() < 1e-8
    explained = got.groupby("component")["explained"].first().to_numpy()
    assert np.allclose(explained, values[:32] / np.trace(covariance), rtol=1e-10)
    assert np.abs(wide.T @ wide / n - np.eye(32)).max() == pytest.approx(got["identity_error"].iloc[0], abs=1e-10)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.0, 1.0]), (2, [1.0, -1.0]), (3, [0.5, 0.25]), (3, [0.5, 0.25]), (None, [-2.0, 0.0]), (4, None), (5, [])]
    rows += [(6, [1.0, None]), (7, [nan, 1.0]), (8, [inf, 1.0]), (9, [1.0, 2.0, 3.0]), (10, [3e38, 0.0]), (11, [-inf, 0.0])]
    got = w.components(table(spark, rows)).toPandas()
    assert len(got) == 10 and got["vec_id"].isna().sum() == 2 and set(got["vec_id"].dropna()) == {1, 2, 3}
    assert set(got["n"]) == {5} and got["identity_error"].iloc[0] < 1e-12
    assert got.groupby("component")["explained"].first().sum() == pytest.approx(1)
    x = np.array([[0, 64], [64, -64], [32, 16], [32, 16], [-128, 0]])
    exact = ((5 * x - x.sum(axis=0)) ** 2).sum(axis=1)
    assert sorted(got[got["component"] == 1]["deviation"].map(int)) == sorted(exact.tolist())


def test_tables_without_components(spark):
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(i, [1.0, 2.0]) for i in range(5)]):
        got = w.components(table(spark, rows))
        assert got.count() == 0
        assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_rank_deficient_table_keeps_its_components(spark):
    rows = [(i, [float(i % 7), float(i % 7) * 2, 1.0]) for i in range(40)]
    got = w.components(table(spark, rows)).toPandas()
    assert set(got["component"]) == {1} and got["explained"].iloc[0] == pytest.approx(1)


def test_large_entries_stay_exact(spark):
    rows = [(1, [1e12, -1e12]), (2, [-1e12, 3.0]), (3, [5.0, 1e13])]
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v in rows], dtype=object)
    exact = ((3 * x - x.sum(axis=0)) ** 2).sum(axis=1)
    got = w.components(table(spark, rows)).filter("component = 1").orderBy("vec_id").collect()
    assert [int(r.deviation) for r in got] == exact.tolist()
