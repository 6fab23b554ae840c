"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

The centred rows ``X`` stay where they are, as blocks of whole numbers. Each step is one pass over
them that makes both products, ``u = X p`` and ``X' u``, block by block; only vectors as long as an
embedding leave the tasks, and they are added up by dimension before they reach the driver. What
grows with the rows is never kept: a left vector is a combination of the rows' columns,
``u_j = X p_j``, so its ``p_j`` and ``z_j = X' u_j`` stand for it, and ``u_i . u_j = p_i . z_j``. That is
all that full reorthogonalisation needs, on the left and on the right. The small bidiagonal matrix is
decomposed on the driver; the right singular vectors are the components, and the squares of the
singular values over ``n`` their variances.

A lost executor costs the blocks of one pass, as nothing is held between passes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.llm.work import stored

COMPONENTS = 8
#: An entry ``c`` is taken as the whole number ``floor(SCALE * c) + SHIFT``.
SCALE, SHIFT = 1024, 100_000
#: A component counts if its deviation is above this share of the largest one.
LEAST_DEVIATION = 1e-11
#: A triplet is found if it is this exact, as a share of the largest deviation.
TOLERANCE = 1e-14
#: How exactly what was left out is looked at.
ROUGH = 1e-3

_Product = Callable[[np.ndarray], tuple[np.ndarray, float]]


def _unit(v: np.ndarray, *bases: np.ndarray) -> np.ndarray:
    for _ in range(2):
        for basis in bases:
            v = v - basis @ (basis.T @ v)
        v = v / np.linalg.norm(v)
    return v


def bidiagonalized(
    product: _Product, d: int, wanted: int, found: np.ndarray, tolerance: float, seed: int
) -> tuple[np.ndarray, np.ndarray, bool]:
    """``(singular values, right singular vectors, whether the whole space was searched)`` of rows
    ``X`` with ``d`` columns, orthogonal to the columns of ``found``; ``product(p)`` is
    ``(X' X p, |X p|^2)``.

    Ends as soon as the ``wanted`` largest are exact, or with the space.
    """
    random = np.random.default_rng(seed)
    size = d - found.shape[1]
    right, left, mapped = (np.zeros((d, 0)) for _ in range(3))  # v, p and z of each step
    bidiagonal = np.zeros((size, size))
    v, beta, scale = _unit(random.normal(size=d), found), 0.0, 0.0
    for k in range(size):
        p = v - beta * left[:, -1] if k else v
        z, square = product(p)
        for _ in range(3):
            shared = left.T @ z  # the products of this left vector with those before
            p, z = p - left @ shared, z - mapped @ shared
            lost = float(shared @ shared)
            if lost <= 0.1 * square or square <= (1e-14 * scale) ** 2:
                square -= lost
                break
            z, square = product(p)
        alpha = float(np.sqrt(max(square, 0.0)))
        scale = max(scale, alpha)
        if alpha <= 1e-14 * scale:  # no row has anything in this direction
            alpha, p, z = 0.0, np.zeros(d), np.zeros(d)
        else:
            p, z = p / alpha, z / alpha
        right, left, mapped = (
            np.column_stack(pair) for pair in ((right, v), (left, p), (mapped, z))
        )
        bidiagonal[k, k] = alpha
        if k:
            bidiagonal[k - 1, k] = beta
        u, s, w = np.linalg.svd(bidiagonal[: k + 1, : k + 1])
        if k + 1 == size:
            return s[:wanted], right @ w.T[:, :wanted], True
        rest = z - alpha * v
        for _ in range(2):
            rest = rest - right @ (right.T @ rest)
            rest = rest - found @ (found.T @ rest)
        beta = float(np.linalg.norm(rest))
        if beta <= 1e-14 * scale:  # an invariant space: what is left of the whole is searched from anew
            beta, v = 0.0, _unit(random.normal(size=d), found, right)
        else:
            v = rest / beta
            if k + 1 > wanted and (beta * np.abs(u[-1, :wanted]) <= tolerance * s[0]).all():
                return s[:wanted], right @ w.T[:, :wanted], False
    return np.zeros(0), np.zeros((d, 0)), True


def leading_components(product: _Product, d: int, wanted: int, seed: int = 0):
    """``(deviations times the root of n, components)``, the largest ``wanted`` of them.

    Bidiagonalisation from one vector sees equal deviations once. So if it ended early, the space
    orthogonal to what was found is searched for anything larger than the least found.
    """
    wanted = min(wanted, d)
    s, found, whole = bidiagonalized(product, d, wanted, np.zeros((d, 0)), TOLERANCE, seed)
    while not whole and found.shape[1] < d:
        seed += 1
        more, _, _ = bidiagonalized(product, d, 1, found, ROUGH, seed)
        if more[0] * (1 + ROUGH) <= s[wanted - 1]:
            break
        more, other, _ = bidiagonalized(product, d, 1, found, TOLERANCE, seed)
        if more[0] <= s[wanted - 1]:
            break
        s, found = np.append(s, more), np.column_stack([found, other])
        order = np.argsort(-s, kind="stable")
        s, found = s[order], found[:, order]
    s, found = s[:wanted], found[:, :wanted]
    enough = (s > LEAST_DEVIATION * s[0]) & (s > 0) if len(s) else s > 0
    return s[enough], found[:, enough]


@dataclass
class Whitening:
    """A fitted whitening: ``n`` vectors with exact ``sums`` by dimension, ``components`` by column
    with their ``variances``, the ``trace`` of the covariance, and how far the covariance of the
    whitened vectors is from the identity."""

    n: int
    sums: list[int]
    components: np.ndarray
    variances: np.ndarray
    trace: float
    identity_error: float


def _split_mean(n: int, sums: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """The mean as whole numbers and what they lack, so that centring loses no digits."""
    whole = np.array([s // n for s in sums], dtype=np.int64)
    return whole, np.array([(s % n) / n for s in sums])


def _matrix(data: pa.Scalar, d: int) -> np.ndarray:
    return np.frombuffer(data.as_buffer(), dtype=np.int64).reshape(-1, d)


def _blocks(d: int):
    """``(ids, x)``: the ids of a batch and its whole numbers row by row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = batch.column("x").flatten().to_numpy().astype(np.int64)
                if np.abs(x).max() > 1 << 40:
                    raise ValueError("An entry is too large to be summed exactly.")
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([batch.column("vec_id").to_pylist()], pa.list_(pa.int64())),
                        pa.array([x.tobytes()], pa.binary()),
                    ],
                    ["ids", "x"],
                )

    return run


def _sums(d: int):
    """A task's number of rows and sums by dimension; the number comes last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(d + 1, dtype=np.int64)
        for batch in batches:
            for data in batch.column("x"):
                x = _matrix(data, d)
                total[:d] += x.sum(axis=0)
                total[d] += len(x)
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.int64()))], ["v"])

    return run


def _products(d: int, mean: tuple[np.ndarray, np.ndarray], p: np.ndarray):
    """A task's part of ``X' X p`` and, last, of ``|X p|^2``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(d + 1)
        for batch in batches:
            for data in batch.column("x"):
                rows = (_matrix(data, d) - mean[0]) - mean[1]
                u = rows @ p
                total[:d] += u @ rows
                total[d] += u @ u
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["v"])

    return run


def _moments(d: int, mean: tuple[np.ndarray, np.ndarray], to: np.ndarray):
    """A task's sums of whitened vectors, of their products, and of all squares."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = to.shape[1]
        sums, products, squares = np.zeros(k), np.zeros((k, k)), 0.0
        for batch in batches:
            for data in batch.column("x"):
                rows = (_matrix(data, d) - mean[0]) - mean[1]
                w = rows @ to
                sums += w.sum(axis=0)
                products += w.T @ w
                squares += float(np.einsum("ij,ij->", rows, rows))
        out = [*sums.tolist(), *products.ravel().tolist(), squares]
        yield pa.RecordBatch.from_arrays([pa.array([out], pa.list_(pa.float64()))], ["v"])

    return run


def _added(blocks: DataFrame, run, kind: str) -> list:
    """The arrays of all tasks, added up place by place."""
    parts = blocks.mapInArrow(run, f"v array<{kind}>").select(F.posexplode("v").alias("k", "x"))
    return [r["x"] for r in parts.groupBy("k").agg(F.sum("x").alias("x")).orderBy("k").collect()]


def integer_blocks(df: DataFrame, column: str = "embedding") -> tuple[DataFrame, int]:
    """``(blocks, d)``: the vectors with ``d`` entries, none of them null or not finite, as whole
    numbers; ``d`` is the most frequent length (the smallest of ties)."""
    c = F.col(column).cast("array<double>")
    usable = lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))
    rows = df.select(F.col("vec_id").cast("long").alias("vec_id"), c.alias("c"))
    rows = rows.where(F.coalesce(F.forall("c", usable), F.lit(False)) & (F.size("c") > 0))
    most = rows.groupBy(F.size("c").alias("d")).count().orderBy(F.desc("count"), "d").first()
    d = most["d"] if most else 0
    whole = F.transform("c", lambda e: F.floor(e * SCALE) + SHIFT)
    x = rows.where(F.size("c") == d).select("vec_id", whole.alias("x"))
    return stored(x.mapInArrow(_blocks(d), "ids array<long>, x binary"), "vectors"), d


def fit_whitening(blocks: DataFrame, d: int, components: int = COMPONENTS) -> Whitening:
    """The whitening of all vectors in ``blocks`` (of ``integer_blocks``)."""
    *sums, n = _added(blocks, _sums(d), "long") if d else [0]
    if not n:
        return Whitening(0, sums, np.zeros((d, 0)), np.zeros(0), 0.0, float("nan"))
    mean = _split_mean(n, sums)

    def product(p: np.ndarray) -> tuple[np.ndarray, float]:
        *z, square = _added(blocks, _products(d, mean, p), "double")
        return np.array(z), square

    s, found = leading_components(product, d, components)
    variances = s**2 / n
    k = len(s)
    out = _added(blocks, _moments(d, mean, found / np.sqrt(variances)), "double")
    shift = np.array(out[:k]) / n
    covariance = np.array(out[k:-1]).reshape(k, k) / n - np.outer(shift, shift)
    error = float(np.abs(covariance - np.eye(k)).max()) if k else float("nan")
    return Whitening(n, sums, found, variances, out[-1] / n, error)


_RESULT = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, "
    "identity_error double"
)


def _deviations(x: np.ndarray, n: int, mean: tuple[np.ndarray, np.ndarray], sums: list[int]):
    """The sums of ``(n x - S)^2``, exact; none where one is no long."""
    apart = x - mean[0]
    left = np.array([s % n for s in sums], dtype=np.int64)
    most = n * (int(np.abs(apart).max()) + 1) if len(x) else 0
    if len(sums) * most * most < 1 << 63:
        return ((n * apart - left) ** 2).sum(axis=1).tolist()
    exact = ((apart.astype(object) * n - left.astype(object)) ** 2).sum(axis=1)
    return [int(v) if v < 1 << 63 else None for v in exact]


def whitened(blocks: DataFrame, model: Whitening) -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)``: a row for each
    vector of ``blocks`` and each component of the model, numbered from 1 by falling variance.

    ``deviation`` is the exact sum of ``(n x - S)^2`` over the dimensions, null if it is no long.
    """
    d, k = len(model.sums), len(model.variances)
    if not (model.n and k):
        return blocks.sparkSession.createDataFrame([], _RESULT)
    mean = _split_mean(model.n, model.sums)
    to = model.components / np.sqrt(model.variances)
    explained = model.variances / model.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, data in zip(batch.column("ids"), batch.column("x"), strict=True):
                x = _matrix(data, d)
                m = len(x)
                w = ((x - mean[0]) - mean[1]) @ to
                deviations = pa.array(_deviations(x, model.n, mean, model.sums), pa.int64())
                each = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.values.take(each),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                        pa.array(np.full(m * k, model.n, dtype=np.int64)),
                        deviations.take(each),
                        pa.array(w.ravel()),
                        pa.array(np.tile(explained, m)),
                        pa.array(np.full(m * k, model.identity_error)),
                    ],
                    [c.split()[0] for c in _RESULT.split(", ")],
                )

    return blocks.mapInArrow(run, _RESULT)


def whiten(df: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``whitened`` for the vectors in ``column``, by the whitening fitted to all of them.

    Rows with a null vector, or one with null or non-finite entries, are left out; so are vectors
    whose length is not the most frequent one (the smallest of ties), empty ones included. A null or
    repeated ``vec_id`` is kept as it is: rows do not meet by it. Directions in which the vectors do
    not differ are no components, so equal vectors, a single one, or an empty table give no rows.
    Equal variances have components in no set order. Other columns do not matter.
    """
    blocks, d = integer_blocks(df, column)
    return whitened(blocks, fit_whitening(blocks, d, components))
