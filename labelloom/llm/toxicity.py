"""Toxicity by maximum-scoring segments.

Every token has a score: the log odds of being in toxic against other labelled texts, with a Dirichlet
prior in proportion to its use in both, where its z value says it differs; less a drift, so that
ordinary text sinks. A token that has no such value takes that of its first ``HEAD`` bytes, so that
inflected forms are known by their stem. One linear scan of a text finds all its maximal scoring segments (those that
no longer or shorter one beats). How often chance makes one of a score ``S`` in ``n`` ordinary tokens
is ``K n exp(-lambda S)``, the extreme-value law of such segments: ``lambda`` solves
``sum p(s) exp(lambda s) = 1`` over the scores of ordinary tokens, ``K`` is fitted on ordinary texts.
Segments below ``SIGNIFICANT`` are the toxic passages. A logistic curve over the sum of their
calibrated scores and the best one's turns them into the score of the text.

The tokens and the curve are learned from at most ``LABELLED_ROWS`` labelled rows, those with the
smallest hash of ``doc_id``; only tokens that differ (a lexicon) leave a task. All documents are then
scanned whole, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.llm.quality import logistic
from labelloom.llm.words import ALPHANUMERIC, Hasher, chunks
from labelloom.llm.work import documents, stored

LABELLED_ROWS = 50_000
#: Least z value of a token in the lexicon; the prior: a share of the uses in both, and some for all.
LEAST_Z = 3.0
PRIOR_SHARE = 0.01
PRIOR_EACH = 0.5
DRIFT = 0.5
HEAD = 5
SIGNIFICANT = 0.05


@dataclass
class Model:
    """The lexicon (sorted hashes of tokens and heads, and their log odds), the law, and the curve."""

    tokens: np.ndarray
    odds: np.ndarray
    rate: float  # lambda
    scale: float  # K
    curve: np.ndarray | None = None

    def odds_of(self, hashes: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The log odds of each token, and whether it is known at all."""
        odds, known = np.zeros(len(hashes)), np.zeros(len(hashes), dtype=bool)
        if len(self.tokens):
            for x in (heads, hashes):
                at = np.minimum(np.searchsorted(self.tokens, x), len(self.tokens) - 1)
                own = self.tokens[at] == x
                odds[own], known[own] = self.odds[at[own]], True
        return odds, known

    def score(self, features: np.ndarray) -> np.ndarray:
        z = features @ self.curve[:-1] + self.curve[-1]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def maximal_segments(places: np.ndarray, scores: np.ndarray, drift: float) -> list[tuple]:
    """``(first, last, score)`` of all maximal scoring segments of tokens that score ``scores`` at the
    sorted ``places`` and ``-drift`` elsewhere. Each step moves back along links, so the scan is
    linear."""
    sums = np.cumsum(scores)
    before = sums - scores - drift * (places - np.arange(len(places)))
    segments: list[list] = []  # first place, last place, sum before, sum after, link
    for place, low, s in zip(places.tolist(), before.tolist(), scores.tolist(), strict=True):
        if s <= 0:
            continue
        new = [place, place, low, low + s, None]
        at = len(segments) - 1
        while True:
            while at is not None and at >= 0 and segments[at][2] >= new[2]:
                at = segments[at][4]  # nothing between has a smaller sum before it
            if at is None or at < 0 or segments[at][3] >= new[3]:
                new[4] = at if at is not None and at >= 0 else None
                segments.append(new)
                break
            new[0], new[2] = segments[at][0], segments[at][2]
            link = segments[at][4]
            del segments[at:]
            at = link
    return [(a, b, high - low) for a, b, low, high, _ in segments]


def _features(model: Model, hasher: Hasher, batch: pa.RecordBatch):
    """Of each document its tokens' number, its segments and the curve's inputs."""
    for _, _, data, offsets in chunks(batch):
        starts, ends, hashes, first = hasher.words(data, offsets)
        odds, known = model.odds_of(hashes, hasher.heads(starts, ends, HEAD))
        chars_to = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])  # characters before a byte
        for d in range(len(offsets) - 1):
            a, b = int(first[d]), int(first[d + 1])
            places = np.flatnonzero(known[a:b])
            n = b - a
            found = []
            if len(places):
                base = offsets[d]
                for x, y, s in maximal_segments(places, odds[a:b][places] - DRIFT, DRIFT):
                    surprise = model.rate * s - np.log(model.scale * n)  # -log of the expected number
                    place = (int(chars_to[at] - chars_to[base]) for at in (starts[a + x], ends[a + y]))
                    found.append((*place, float(s), float(np.exp(-np.clip(surprise, -50, 700)))))
            toxic = [x for x in found if x[3] <= SIGNIFICANT]
            gains = [-np.log(max(x[3], 1e-300)) for x in found]
            best = max(gains, default=-np.log(model.scale * max(n, 1)))
            total = sum(-np.log(max(x[3], 1e-300)) for x in toxic)
            most = max((x[2] for x in found), default=0.0)
            yield n, found, toxic, (np.clip(best, -20, 60), np.log1p(total), np.log1p(most))


def _scores(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, hasher = shared.value, Hasher(ALPHANUMERIC)
        for batch in batches:
            rows = list(_features(model, hasher, batch))
            score = model.score(np.array([x[3] for x in rows]).reshape(len(rows), 3))
            passages = [
                [dict(zip(("start", "end", "score", "expected"), p, strict=True)) for p in x[2]]
                for x in rows
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(score),
                    pa.array([x[0] for x in rows], pa.int64()),
                    pa.array(passages, _PASSAGES),
                ],
                ["doc_id", "score", "n_tokens", "passages"],
            )

    return run


#: Inputs of the curve: the best surprise, the logarithms of all significant ones and of the best score.
_INPUTS = ["best", "total", "most"]
_TRAINED = "toxic int, n long, best double, total double, most double"

_PASSAGES = pa.list_(
    pa.struct(
        [
            ("start", pa.int64()),
            ("end", pa.int64()),
            ("score", pa.float64()),
            ("expected", pa.float64()),
        ]
    )
)


def _training_features(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, hasher = shared.value, Hasher(ALPHANUMERIC)
        for batch in batches:
            rows = list(_features(model, hasher, batch))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("toxic"),
                    pa.array([x[0] for x in rows], pa.int64()),
                    *(pa.array([float(x[3][k]) for x in rows], pa.float64()) for k in range(3)),
                ],
                ["toxic", "n", *_INPUTS],
            )

    return run


def _token_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(token, toxic, n)``: of how many texts of a task the token, or head, is part."""
    hasher, parts = Hasher(ALPHANUMERIC), ([], [])
    for batch in batches:
        labels = batch.column("toxic").to_pylist()
        for row, _, data, offsets in chunks(batch):
            starts, ends, hashes, first = hasher.words(data, offsets)
            heads = hasher.heads(starts, ends, HEAD)
            for d, (a, b) in enumerate(zip(first[:-1], first[1:], strict=True)):
                parts[labels[row + d]].append(np.unique(np.concatenate([hashes[a:b], heads[a:b]])))
        for part in parts:
            if sum(map(len, part)) > _HELD:
                yield _counted(parts)
                parts = ([], [])
                break
    yield _counted(parts)


#: Tokens of texts held before they are counted.
_HELD = 4 << 20


def _counted(parts: tuple[list, list]) -> pa.RecordBatch:
    columns = []
    for k, part in enumerate(parts):
        tokens, n = np.unique(np.concatenate(part or [np.zeros(0, np.uint64)]), return_counts=True)
        columns.append((tokens.view(np.int64), np.full(len(n), k, dtype=np.int32), n.astype(np.int64)))
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(c)) for c in zip(*columns, strict=True)], ["token", "toxic", "n"]
    )


def _rate(odds: np.ndarray, share: np.ndarray) -> float:
    """The positive root of ``sum p(s) exp(x s) = 1``, the rest of the tokens scoring ``-DRIFT``."""
    s, p = odds - DRIFT, share
    rest = max(0.0, 1 - p.sum())
    at = lambda x: float(p @ np.exp(np.clip(x * s, -700, 700)) + rest * np.exp(-x * DRIFT)) - 1
    low, high = 1e-6, 1.0
    while at(high) < 0 and high < 64:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (low, mid) if at(mid) > 0 else (mid, high)
    return high


def train(docs: DataFrame, labels: DataFrame, labelled_rows: int = LABELLED_ROWS) -> Model:
    """A model from the rows of ``docs`` labelled in ``labels`` (``doc_id``, ``toxic`` 0 or 1). A
    document labelled twice counts as toxic if one label says so. With one kind alone every text
    scores the share of that kind."""
    context = docs.sparkSession.sparkContext
    marked = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int"))
        .where("doc_id IS NOT NULL AND toxic IN (0, 1)")
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"))
        .limit(labelled_rows)
    )
    rows = documents(docs).join(F.broadcast(stored(marked, "labelled")), "doc_id")
    rows = stored(rows, "training")
    counts = stored(
        rows.mapInArrow(_token_counts, "token long, toxic int, n long")
        .groupBy("token")
        .agg(
            F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).cast("double").alias("y"),
            F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).cast("double").alias("x"),
        ),
        "token-counts",
    )
    n_y, n_x, n = (v or 0.0 for v in counts.agg(F.sum("y"), F.sum("x"), F.count("*")).first())
    prior = PRIOR_EACH + PRIOR_SHARE * (F.col("y") + F.col("x"))
    all_prior = PRIOR_EACH * n + PRIOR_SHARE * (n_y + n_x)
    y, x = F.col("y") + prior, F.col("x") + prior
    odds = F.log(y / (F.lit(n_y + all_prior) - y)) - F.log(x / (F.lit(n_x + all_prior) - x))
    lexicon = (
        counts.where(F.lit(n_y > 0 and n_x > 0))
        .select("token", "x", odds.alias("odds"), (odds / F.sqrt(1 / y + 1 / x)).alias("z"))
        .where(F.abs("z") >= LEAST_Z)
        .toPandas()
    )
    lexicon["token"] = lexicon["token"].to_numpy(dtype=np.int64).view(np.uint64)
    lexicon = lexicon.sort_values("token")
    tokens = lexicon["token"].to_numpy(dtype=np.uint64)
    values = lexicon["odds"].to_numpy(dtype=float)
    rate = _rate(values, lexicon["x"].to_numpy(dtype=float) / max(n_x, 1.0))
    model = Model(tokens, values, rate, 1.0)
    found = (
        rows.mapInArrow(
            _training_features(context.broadcast(model)),
            _TRAINED,
        )
        .toPandas()
        .astype({"toxic": float})
    )
    plain = found[(found["toxic"] == 0) & (found["n"] > 0)]
    if len(plain):
        chance = (plain["n"] * np.exp(-rate * np.expm1(plain["most"]))).sum()
        model.scale = float(np.clip(len(plain) / max(chance, 1e-9), 1e-6, 1e3))
    if found["toxic"].nunique() < 2:
        share = float(found["toxic"].mean()) if len(found) else 0.0
        model.curve = np.array([0.0, 0.0, 0.0, np.log((share + 1e-6) / (1 - share + 1e-6))])
        return model
    again = rows.mapInArrow(
        _training_features(context.broadcast(model)),
        _TRAINED,
    ).toPandas()
    model.curve = logistic(
        again[_INPUTS].to_numpy(dtype=float), again["toxic"].to_numpy(dtype=float), 1e-2
    )
    return model


def toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, score, n_tokens, passages)`` for every row of ``docs``: ``score`` from 0 to 1, and
    each significant passage with its place (code points, end exclusive), its segment's score and how
    many such segments chance is expected to make in this text.

    A null or empty text has no passage and the score of a text of one ordinary token. Each row stands
    for itself, so repeated rows and a null ``doc_id`` change nothing.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    passage = "array<struct<start: bigint, end: bigint, score: double, expected: double>>"
    return documents(docs).mapInArrow(
        _scores(shared), f"doc_id long, score double, n_tokens long, passages {passage}"
    )
