"""Quality by importance resampling.

Two generative models over hashed words and word pairs, one of the target (documents labelled as
good) and one of the raw text (all documents), give each document an importance weight: how much
likelier the target is to produce it than the raw text. A Gumbel variate drawn from ``doc_id`` is added
to the logarithm of the weight, and the ``k`` largest sums are sampled, which draws ``k`` documents
without replacement in proportion to their weights. ``k`` is a share of all documents: that of good ones
among the labelled rows, if no other is given.

The raw model covers all documents. The target model takes at most ``LABELLED_ROWS`` labelled documents,
those with the smallest hash of ``doc_id``; they decide one row of numbers of a fixed size. Only the two
models leave a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.llm.words import WITH_SIGNS, Hasher, chunks, sequences
from labelloom.llm.work import documents, stored, tidy

BUCKETS = 10_000
#: The bound of the labelled sample.
LABELLED_ROWS = 50_000
SEED = 17
_BINS = 4096


def _features(hasher: Hasher, data, offsets, buckets: int):
    """Of each document the buckets of its words and word pairs; bucket 0 is for a word twice."""
    _, _, hashes, first = hasher.words(data, offsets)
    words = (hashes % np.uint64(buckets - 1)).astype(np.int64) + 1
    pairs = (sequences(hashes, 2) % np.uint64(buckets - 1)).astype(np.int64) + 1
    pairs[hashes[1:] == hashes[:-1]] = 0
    for a, b in zip(first[:-1], first[1:], strict=True):
        yield np.concatenate([words[a:b], pairs[a : max(a, b - 1)]])


def _counts(buckets: int):
    """The bucket counts of a task: of the raw text, and of the good and the bad labelled rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, total = Hasher(WITH_SIGNS), np.zeros((2, buckets), dtype=np.int64)
        for batch in batches:
            good = batch.column(batch.schema.get_field_index("quality")).to_pylist()
            for a, b, data, offsets in chunks(batch):
                features = list(_features(hasher, data, offsets, buckets))
                total[0] += np.bincount(np.concatenate(features), minlength=buckets)
                labelled = [f for f, q in zip(features, good[a:b], strict=True) if q == 1]
                if labelled:
                    total[1] += np.bincount(np.concatenate(labelled), minlength=buckets)
        kind, bucket = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(kind.astype(np.int32)),
                pa.array(bucket.astype(np.int32)),
                pa.array(total[kind, bucket]),
            ],
            ["kind", "bucket", "n"],
        )

    return tidy(run)


def _ratios(ratio):
    """``(doc_id, n_grams, log_weight)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, log_ratio = Hasher(WITH_SIGNS), ratio.value
        for batch in batches:
            n, weight = [], []
            for _, _, data, offsets in chunks(batch):
                for f in _features(hasher, data, offsets, len(log_ratio)):
                    n.append(len(f))
                    weight.append(float(log_ratio[f].sum()))
            n, weight = np.array(n, dtype=np.int64), np.array(weight, dtype=float)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(batch.schema.get_field_index("doc_id")),
                    pa.array(n),
                    pa.array(weight),
                ],
                ["doc_id", "n_grams", "log_weight"],
            )

    return tidy(run)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Coefficients (the last one constant) of a logistic regression by Newton's method."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + ridge * w
        bend = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def kth_largest(df: DataFrame, column: str, k: int) -> float:
    """The ``k``-th largest value of ``column``, by counting in ever narrower bins."""
    low, high, n = df.agg(F.min(column), F.max(column), F.count(column)).first()
    if k >= n:
        return low
    while low < high:
        width = (high - low) / _BINS
        inside = df.where((F.col(column) >= low) & (F.col(column) <= high))
        bins = F.least(F.floor((F.col(column) - low) / width), F.lit(_BINS - 1)).alias("bin")
        found = inside.groupBy(bins).agg(
            F.count("*").alias("n"), F.min(column).alias("low"), F.max(column).alias("high")
        )
        for row in sorted(found.collect(), key=lambda r: -r["bin"]):
            if k <= row["n"]:
                low, high = row["low"], row["high"]
                break
            k -= row["n"]
        if width == 0:
            break
    return low


def quality_sample(
    docs: DataFrame,
    labels: DataFrame,
    share: float | None = None,
    buckets: int = BUCKETS,
    labelled_rows: int = LABELLED_ROWS,
    seed: int = SEED,
) -> DataFrame:
    """``(doc_id, n_grams, log_weight, gumbel_key, kept)`` for every row of ``docs``.

    ``kept`` says whether the row is in the sample of ``share`` of all rows (rounded to a whole number);
    without a share it is that of the good ones among the labelled rows. Rows that tie with the last
    one are all in it, so rows that repeat a ``doc_id`` and its text go or stay together. A null or empty
    text has no n-grams and the log weight 0. Without any good or any bad labelled row everything is
    kept. A document labelled twice counts as bad if one label says so. Whole texts are read, very long
    ones as a chunk of their own. Other columns do not matter. No input: no rows.
    """
    docs = documents(docs)
    context = docs.sparkSession.sparkContext
    marked = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int"))
        .where("doc_id IS NOT NULL AND quality IN (0, 1)")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"))
        .limit(labelled_rows)
    )
    marked = stored(marked, "labelled")
    counts = (
        docs.join(F.broadcast(marked), "doc_id", "left")
        .select("doc_id", "text", "quality")
        .mapInArrow(_counts(buckets), "kind int, bucket int, n long")
        .groupBy("kind", "bucket")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    model = np.ones((2, buckets))  # one is added to each count
    model[counts["kind"], counts["bucket"]] += counts["n"]
    model /= model.sum(axis=1, keepdims=True)
    ratio = context.broadcast(np.log(model[1] / model[0]))
    uniform = (F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    weighed = stored(
        docs.mapInArrow(_ratios(ratio), "doc_id long, n_grams long, log_weight double").withColumn(
            "gumbel_key", F.col("log_weight") - F.log(-F.log(uniform))
        ),
        "weighed",
    )
    good, labelled = marked.agg(F.sum("quality"), F.count("*")).first()
    if not good or good == labelled:
        return weighed.withColumn("kept", F.lit(True))
    share = good / labelled if share is None else share
    k = round(share * weighed.count())
    least = kth_largest(weighed, "gumbel_key", k) if k else float("inf")
    return weighed.withColumn("kept", F.col("gumbel_key") >= F.lit(least))
