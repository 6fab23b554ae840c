"""Whitening against a plain decomposition of the covariance."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelloom.llm import queries
from labelloom.llm.whitening import SCALE, SHIFT, leading_components, whiten
from tests.llm.conftest import SMALL

SCHEMA = "vec_id long, embedding array<float>"


def _plain(vectors: list[list[float]], k: int = 8):
    """``(deviations, whitened vectors up to sign, explained)``."""
    x = np.floor(np.array(vectors, dtype=float) * SCALE).astype(np.int64) + SHIFT
    n, sums = len(x), x.sum(axis=0)
    exact = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums, strict=True)) for row in x]
    c = x - sums / n
    e, v = np.linalg.eigh(c.T @ c / n)
    e, v = e[::-1][:k], v[:, ::-1][:, :k]
    return exact, c @ v / np.sqrt(e), e / np.trace(c.T @ c / n)


def _checked(df, vectors: dict[int, list[float]], k: int):
    exact, w, explained = _plain(list(vectors.values()), k)
    place = {v: i for i, v in enumerate(vectors)}
    rows = df.collect()
    assert len(rows) == len(vectors) * k
    got = np.zeros_like(w)
    for r in rows:
        at, c = place[r["vec_id"]], r["component"] - 1
        assert r["n"] == len(vectors) and r["deviation"] == exact[at]
        assert math.isclose(r["explained"], explained[c], rel_tol=1e-9)
        assert r["identity_error"] < 1e-9
        got[at, c] = r["whitened"]
    signs = np.sign((got * w).sum(axis=0))
    assert np.abs(got - w * signs).max() < 1e-7


def test_query_equals_the_plain_version(spark):
    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()
    _checked(queries.op11_whitening(spark, SMALL), {r["vec_id"]: r["embedding"] for r in rows}, 8)


def test_fewer_dimensions_than_components(spark):
    random = np.random.default_rng(3)
    vectors = {i: (random.normal(size=3) * [3, 2, 1]).tolist() for i in range(50)}
    df = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>")
    _checked(whiten(df.repartition(4)), vectors, 3)


def test_rows_that_cannot_be_used(spark):
    random = np.random.default_rng(5)
    good = {i: random.normal(size=4).astype(np.float32).tolist() for i in range(20)}
    odd = [(100, None), (101, []), (102, [1.0, None, 2.0, 3.0]), (103, [1.0, float("nan"), 0.0, 0.0])]
    odd += [(104, [float("inf"), 0.0, 0.0, 0.0]), (105, [1.0, 2.0]), (106, [1.0, -float("inf"), 1.0, 1.0])]
    df = spark.createDataFrame([*good.items(), *odd], SCHEMA)
    for name in ("x", "ids", "v", "d", "c", "component", "n"):
        df = df.withColumn(name, F.lit("clash"))
    _checked(whiten(df), good, 4)


def test_null_and_repeated_ids_stay_rows(spark):
    rows = [(None, [1.0, 2.0]), (None, [2.0, 1.0]), (7, [3.0, 5.0]), (7, [3.0, 5.0])]
    out = whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r["vec_id"] is None, r["component"]) for r in out) == [
        (a, c) for a in (False, True) for c in (1, 1, 2, 2)
    ]
    same = [r["whitened"] for r in out if r["vec_id"] == 7 and r["component"] == 1]
    assert same[0] == same[1]


@pytest.mark.parametrize(
    "rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(i, [0.5, 0.25, 0.125]) for i in range(5)]]
)
def test_nothing_that_differs_gives_no_rows(spark, rows):
    df = whiten(spark.createDataFrame(rows, SCHEMA))
    assert df.count() == 0
    assert df.columns[:4] == ["vec_id", "component", "n", "deviation"]


def test_a_deviation_beyond_a_long_is_null(spark):
    rows = [(i, [1e5 * (i % 2), float(i)]) for i in range(40)]
    plain, _, _ = _plain([r[1] for r in rows], 2)
    out = {r["vec_id"]: r["deviation"] for r in whiten(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert out == {i: v if v < 1 << 63 else None for i, v in enumerate(plain)}
    rows = [(i, [1e7 * (i % 2), float(i)]) for i in range(40)]
    assert {r["deviation"] for r in whiten(spark.createDataFrame(rows, SCHEMA)).collect()} == {None}


@pytest.mark.parametrize(
    "kind", ["full", "equal", "lower rank", "few stand out", "ties at the end", "one direction"]
)
def test_components_of_matrices(kind):
    random = np.random.default_rng(1)
    x = {
        "full": random.normal(size=(300, 40)) * np.linspace(1, 9, 40),
        "equal": np.vstack([np.eye(20), -np.eye(20)]) * 100,
        "lower rank": random.normal(size=(300, 3)) @ random.normal(size=(3, 30)),
        "few stand out": random.normal(size=(300, 150)) * np.r_[np.linspace(90, 30, 12), [0.5] * 138],
        "ties at the end": np.vstack([np.eye(60), -np.eye(60)]) * np.r_[9, 8, 7, [5] * 7, [1] * 50],
        "one direction": np.outer(random.normal(size=50), np.ones(12)),
    }[kind]
    x = x - x.mean(axis=0)
    passes = []

    def product(p):
        passes.append(1)
        u = x @ p
        return x.T @ u, float(u @ u)

    s, v = leading_components(product, x.shape[1], 8)
    true = np.linalg.svd(x, compute_uv=False)[:8]
    true = true[true > 1e-11 * true[0]]
    assert len(s) == len(true)
    assert np.abs(s - true).max() < 1e-12 * true[0]
    assert np.abs(v.T @ v - np.eye(len(s))).max() < 1e-12
    assert np.abs(x.T @ (x @ v) - v * s**2).max() < 1e-12 * true[0] ** 2
    assert len(passes) < 3 * x.shape[1]
