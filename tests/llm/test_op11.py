"""Whitening against numpy's eigenvectors."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from trajspark.llm import op11_whitening as op

SF = "/root/testdata/sf0.001"


def expected(rows, k=4):
    """rows: (id, whole vector). Per id the deviation and the first k whitened values up to sign, and the shares."""
    x = np.array([v for _, v in rows], dtype=np.int64)
    u = np.unique(x, axis=0)
    n, sums = len(u), u.sum(axis=0)
    values, vectors = np.linalg.eigh(np.cov(u.T.astype(float), bias=True))
    values, vectors = values[::-1], vectors[:, ::-1]
    white = (x - sums / n) @ vectors[:, :k] / np.sqrt(values[:k])
    return n, ((n * x - sums) ** 2).sum(axis=1), white, values[:k] / values.sum()


def test_query(spark):
    got = op.whitening(spark, SF).toPandas()
    source = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    rows = [(r["vec_id"], np.floor(256 * np.array(r["embedding"], dtype=np.float64)).astype(int)) for r in source if r["embedding"] is not None and all(x is not None and math.isfinite(x) for x in r["embedding"])]
    n, deviation, white, share = expected(rows)
    ids = [i for i, _ in rows]
    table = got.pivot(index="vec_id", columns="component", values="whitened").loc[ids].to_numpy()
    assert len(got) == 4 * len(rows) and set(got["n"]) == {n}
    signs = np.sign(np.sum(np.sign(table * white), axis=0))
    assert np.allclose(table * signs, white, atol=1e-9)
    first = got[got["component"] == 1].set_index("vec_id").loc[ids]
    assert first["deviation"].tolist() == deviation.tolist()
    assert np.allclose(got.groupby("component")["explained"].first(), share, rtol=1e-9)
    assert got["identity_error"].nunique() == 1 and got["identity_error"][0] < 1e-10


def test_factor_and_rotation():
    rng = np.random.default_rng(1)
    for d, rank in ((1, 1), (5, 3), (7, 7), (32, 20)):
        b = rng.normal(size=(d, rank)) * 10.0 ** rng.integers(-3, 4, size=rank)
        a = (b @ b.T).astype(np.longdouble)
        factor = op.pivoted_cholesky(a)
        assert np.abs(factor @ factor.T - a).max() < 1e-12 * np.abs(a).max()
        turned = op.jacobi_columns(factor)
        values = np.sort((turned * turned).sum(axis=0).astype(float))[::-1][:rank]
        assert np.allclose(values, np.linalg.svd(b)[1] ** 2, rtol=1e-6)
        gram = (turned.T @ turned).astype(float)
        norms = np.sqrt(np.diag(gram))
        assert np.abs(gram / np.outer(norms, norms) - np.eye(len(gram))).max() < 1e-15


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(2)
    good = [(i, rng.normal(size=3).tolist()) for i in range(20)]
    odd = [(100, None), (101, [1.0, None, 2.0]), (102, [nan, 1.0, 1.0]), (103, [1.0, -inf, 1.0]), (104, []), (105, [1.0]), (None, [0.5, 0.25, -0.0]), (3, good[3][1]), (3, [0.1, 0.2, 0.3])]
    df = spark.createDataFrame(good + odd, "vec_id long, embedding array<double>").withColumns({c: F.lit("x") for c in ("x", "n", "component")})
    rows = op.whole_vectors(df)
    model = op.fit(op.fit_list(rows))
    got = op.project(rows, model).collect()
    kept = [(i, np.floor(256 * np.array(v)).astype(int)) for i, v in good + odd[6:]]
    n, deviation, white, _ = expected(kept, 3)
    assert len(got) == 3 * len(kept) and model.n == n == 22
    want = sorted((i is not None, i or 0, int(d), *np.round(np.abs(w), 8)) for (i, _), d, w in zip(kept, deviation, white, strict=True))
    have = {}
    for r in got:
        have.setdefault((r["vec_id"] is not None, r["vec_id"] or 0, int(r["deviation"])), {}).setdefault(r["component"], []).append(round(abs(r["whitened"]), 8))
    for known, d, number, *values in want:
        assert all(v in [pytest.approx(x, abs=1e-7) for x in have[known, d, number][c + 1]] for c, v in enumerate(values))


def test_no_variance_and_large_numbers(spark):
    same = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<float>")
    rows = op.whole_vectors(same)
    model = op.fit(op.fit_list(rows))
    assert op.project(rows, model).count() == 0 and op.identity_error(op.fit_list(rows), model) is None
    empty = op.whole_vectors(same.filter("1 = 0"))
    model = op.fit(op.fit_list(empty))
    assert model.n == 0 and op.project(empty, model).count() == 0
    large = spark.createDataFrame([(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [3e13, 2.0])], "vec_id long, embedding array<double>")
    rows = op.whole_vectors(large)
    distinct = op.fit_list(rows)
    model = op.fit(distinct)
    # The second direction has less variance than extended precision leaves of the first.
    assert op.project(rows, model).count() == 3 and op.identity_error(distinct, model) < 1e-6


def test_sums_do_not_depend_on_the_partitions(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    models = [op.fit(op.fit_list(op.whole_vectors(df.repartition(k)))) for k in (1, 7)]
    assert models[0].sums == models[1].sums and (models[0].vectors == models[1].vectors).all() and (models[0].values == models[1].values).all()
