"""Language-model scores by Katz backoff.

The model is a bigram model over all words of the training texts, one slot for words never seen, and
the text's start and end:

* ``P(w | h) = d(r) r / (c(h) + 1)`` for a pair seen ``r`` times, ``d`` being the Good-Turing discount
  for ``r`` up to ``DISCOUNTED`` and 1 above. The one added to each history keeps mass for what was
  not seen after it even where nothing is discounted.
* ``P(w | h) = b(h) P(w)`` for other pairs: the backoff weight ``b(h)``, the mass left divided by the
  unigram mass of the unseen, makes every history sum to 1 exactly. (The start counts as a word that
  nothing is followed by, so there always is an unseen one.)

Every word and every pair of all training texts is counted, whatever the size of the corpus. A word is
known by 64 bits, a pair by those of both words.

How the counts and the texts meet: a block of documents becomes, for each bucket, one compressed row
of its distinct pairs and of who has them how often. A pair goes to the bucket of its second word, so
the task of a bucket knows the counts of its pairs and of their second words. It adds up what each
document gets from them, and writes its part of the table of histories: of each first word how many
pairs were seen how often, and the unigram mass of what was seen. The parts are added up by history,
which gives the backoff weights; the pairs of documents that were never seen look theirs up there.

Words and pairs that are frequent in a sample, ``HOT_KEYS`` of each at most, are counted first and sent
to all tasks, as all their rows would go to one bucket else: a pair with such a word is dealt by both
words, such a pair by document. The sample decides the way alone, never a count.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelloom.llm.words import Hasher, chunks, mixed
from labelloom.llm.work import small_batches, stored, tidy

DISCOUNTED = 5
SAMPLE_DOCUMENTS = 10_000
HOT_KEYS = 2_048
#: Text in a block of documents, and text for each bucket of keys.
BLOCK_BYTES = 4 << 20
BUCKET_BYTES = 16 << 20

_START, _END = np.uint64(1), np.uint64(2)

_PACKED = {
    "bucket": "int",
    "docs": "binary",
    "train": "binary",
    "h": "binary",
    "w": "binary",
    "sizes": "binary",
    "who": "binary",
    "times": "binary",
}
_PACKED_SCHEMA = ", ".join(f"{name} {kind}" for name, kind in _PACKED.items())
_TYPES = [np.int64, np.bool_, np.uint64, np.uint64, np.uint32, np.uint32, np.uint32]
_FOUND = "kind int, id long, h long, v array<double>"


def _pack(x: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x).tobytes())


def _unpack(x: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(x), dtype=kind)


def _mapped(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == np.uint64 else x)


def pair_keys(h: np.ndarray, w: np.ndarray) -> np.ndarray:
    """A number for each pair of words; equal numbers say that pairs may be equal."""
    return mixed(h * np.uint64(0x9E3779B97F4A7C15) + mixed(w + np.uint64(1)))


def _new(*columns: np.ndarray) -> np.ndarray:
    """Whether a row differs from the one before."""
    out = np.zeros(len(columns[0]), dtype=bool)
    out[:1] = True
    for c in columns:
        out[1:] |= c[1:] != c[:-1]
    return out


def by_pair(h: np.ndarray, w: np.ndarray) -> np.ndarray:
    """An order in which equal pairs stand together, and otherwise as they are."""
    keys = pair_keys(h, w)
    order = np.argsort(keys, kind="stable")
    same = ~_new(keys[order])
    if (same & _new(h[order], w[order])).any():  # different pairs with one key
        order = np.lexsort((h, w))
    return order


class _Pairs:
    """Turns texts into pairs of words; starts and ends are words of their own."""

    def __init__(self) -> None:
        self.hasher = Hasher()

    def __call__(self, data: np.ndarray, offsets: np.ndarray):
        """``(first words, second words, document of each)``; a document has a pair for each word
        and one for its end."""
        _, _, hashes, first = self.hasher.words(data, offsets)
        n = len(first) - 1
        of = np.repeat(np.arange(n), np.diff(first))
        tokens = np.empty(len(hashes) + 2 * n, dtype=np.uint64)
        begin = first + 2 * np.arange(n + 1)
        tokens[np.arange(len(hashes)) + 2 * of + 1] = np.maximum(hashes, np.uint64(16))
        tokens[begin[:-1]], tokens[begin[1:] - 1] = _START, _END
        inside = np.ones(len(tokens), dtype=bool)
        inside[begin[1:] - 1] = False
        places = np.flatnonzero(inside)
        return tokens[places], tokens[places + 1], np.repeat(np.arange(n), np.diff(begin) - 1)


@dataclass
class Hot:
    """Frequent words, sorted, and frequent pairs, sorted by key, with their exact counts; ``tokens``
    is the number of all tokens."""

    words: np.ndarray
    word_counts: np.ndarray
    keys: np.ndarray
    h: np.ndarray
    w: np.ndarray
    pair_counts: np.ndarray
    tokens: int = 0

    def places(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the words are among the frequent ones, and whether they are."""
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        return at, self.words[at] == words

    def pair_places(self, h: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.keys):
            return np.zeros(len(h), dtype=np.int64), np.zeros(len(h), dtype=bool)
        at = np.minimum(np.searchsorted(self.keys, pair_keys(h, w)), len(self.keys) - 1)
        return at, (self.h[at] == h) & (self.w[at] == w)


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(h, w, n)`` of words (with ``h`` 0) and of pairs that repeat in a piece of the sample."""
    pairs = _Pairs()
    for batch in batches:
        for _, _, data, offsets in chunks(batch):
            h, w, _ = pairs(data, offsets)
            words, n = np.unique(w, return_counts=True)
            order = by_pair(h, w)
            h, w = h[order], w[order]
            new = np.flatnonzero(_new(h, w))
            times = np.diff(np.append(new, len(h)))
            parts = [(np.zeros_like(words), words, n), (h[new], w[new], times)]
            for h, w, n in parts:
                often = n > 8
                columns = [_mapped(x[often]) for x in (h, w, n)]
                yield pa.RecordBatch.from_arrays(columns, ["h", "w", "n"])


def _counted(shared):
    """``(place, n)``: a task's counts of the hot words, then of the hot pairs, then of all tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, hot = _Pairs(), shared.value
        words, both = len(hot.words), len(hot.keys)
        total = np.zeros(words + both + 1, dtype=np.int64)
        for batch in batches:
            for _, _, data, offsets in chunks(batch):
                h, w, _ = pairs(data, offsets)
                at, own = hot.places(w)
                total[:words] += np.bincount(at[own], minlength=words)
                at, own = hot.pair_places(h[own], w[own])  # the second word of a hot pair is hot
                total[words:-1] += np.bincount(at[own], minlength=both)
                total[-1] += len(w)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(total))), pa.array(total)], ["place", "n"]
        )

    return tidy(run)


def _dealt(shared, buckets: int, block_bytes: int):
    """The rows of blocks, one for each bucket of pairs, and one with the ids of the documents."""

    def rows(block: list[tuple], row: int) -> Iterator[pa.RecordBatch]:
        hot = shared.value
        train = np.concatenate([x[1] for x in block])
        docs = np.arange(row, row + len(train))
        shift = np.cumsum([0, *(len(x[1]) for x in block)])
        h, w = (np.concatenate([x[k] for x in block]) for k in (2, 3))
        who = np.concatenate([x[4] + s for x, s in zip(block, shift[:-1], strict=True)])
        order = by_pair(h, w)  # documents are in order and stay so
        h, w, who = h[order], w[order], who[order]
        new = np.flatnonzero(_new(h, w, who))
        times = np.diff(np.append(new, len(h)))
        h, w, who = h[new], w[new], who[new]
        bucket = mixed(w) % np.uint64(buckets)
        common = np.flatnonzero(hot.places(w)[1])
        bucket[common] = pair_keys(h[common], w[common]) % np.uint64(buckets)
        common = common[hot.pair_places(h[common], w[common])[1]]
        bucket[common] = mixed(docs[who[common]].astype(np.uint64)) % np.uint64(buckets)
        order = np.argsort(w, kind="stable")  # equal words side by side take little room
        small = np.uint16 if buckets < 1 << 16 else np.uint32
        order = order[np.argsort(bucket[order].astype(small), kind="stable")]
        cuts = np.searchsorted(bucket[order], np.arange(buckets + 1, dtype=np.uint64))
        for b in range(buckets):
            mine = order[cuts[b] : cuts[b + 1]]
            if not len(mine):
                continue
            new = np.flatnonzero(_new(h[mine], w[mine]))
            sizes = np.diff(np.append(new, len(mine)))
            present, local = np.unique(who[mine], return_inverse=True)
            first = mine[new]
            parts = (docs[present], train[present], h[first], w[first], sizes, local, times[mine])
            packed = [_pack(p.astype(t)) for p, t in zip(parts, _TYPES, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([b], pa.int32()), *(pa.array([p], pa.binary()) for p in packed)],
                list(_PACKED),
            )
        ids = pa.concat_arrays([x[0] for x in block])
        told = [_pack(docs), _pack(ids.is_valid().to_numpy(zero_copy_only=False))]
        told.append(_pack(ids.fill_null(0).to_numpy().view(np.uint64)))
        told += [None] * (len(_PACKED) - 1 - len(told))
        yield pa.RecordBatch.from_arrays(
            [pa.array([row % buckets], pa.int32()), *(pa.array([p], pa.binary()) for p in told)],
            list(_PACKED),
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, block, size, n = _Pairs(), [], 0, 0
        row = TaskContext.get().partitionId() << 36
        for batch in batches:
            ids = batch.column("doc_id")
            train = batch.column("train").to_numpy(zero_copy_only=False)
            for a, b, data, offsets in chunks(batch):
                block.append((ids[a:b], train[a:b], *pairs(data, offsets)))
                size, n = size + len(data), n + b - a
                if size >= block_bytes:
                    yield from rows(block, row)
                    block, size, row, n = [], 0, row + n, 0
        if block:
            yield from rows(block, row)

    return tidy(run)


def _told(kind: int, ids: np.ndarray, h: np.ndarray | pa.Array | None = None, v=None) -> pa.RecordBatch:
    n = len(ids)
    v = np.zeros((n, 0)) if v is None else np.ascontiguousarray(v, dtype=float)
    lists = pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * v.shape[1], pa.array(v.ravel()))
    if h is None:
        h = pa.nulls(n, pa.int64())
    elif isinstance(h, np.ndarray):
        h = _mapped(h)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(n, kind, dtype=np.int32)), _mapped(ids), h, lists.cast(pa.list_(pa.float64()))],
        ["kind", "id", "h", "v"],
    )


def history_sums(h: np.ndarray, r: np.ndarray, mass: np.ndarray):
    """``(history, how many pairs were seen once, ... DISCOUNTED + 1 times, the sum of all larger
    counts than DISCOUNTED, unigram mass of the seen)`` of distinct pairs."""
    ids, at = np.unique(h, return_inverse=True)
    times = [np.bincount(at, r == k, len(ids)) for k in range(1, DISCOUNTED + 2)]
    large = np.bincount(at, r * (r > DISCOUNTED), len(ids))
    return ids, np.column_stack([*times, large, np.bincount(at, mass, len(ids))])


def unigram(counts: np.ndarray, tokens: int, ends: np.ndarray | bool = False) -> np.ndarray:
    """The chance of words by their counts: one more for the end, one slot for the never seen, and
    one for the start, which never follows anything."""
    return np.maximum(counts + ends, 1) / (tokens + 3)


def _of_pairs(shared):
    """0: a document's sums; 1: the parts of the histories; 2: pairs to back off, by document and
    first word; 3: how many words a bucket has seen; 4: the ids of documents."""

    def run(table: pa.Table) -> pa.Table:
        hot, out, parts, entries = shared.value, [], [], []
        columns = [table.column(name) for name in list(_PACKED)[1:]]
        for k in range(table.num_rows):
            packed = [c[k].as_py() for c in columns]
            if packed[-1] is None:
                docs, valid, ids = (_unpack(x, t) for x, t in zip(packed, _TYPES[:3], strict=False))
                out.append(_told(4, docs, pa.array(ids.view(np.int64), mask=~valid)))
                continue
            docs, train, h, w, sizes, who, times = (_unpack(x, t) for x, t in zip(packed, _TYPES, strict=True))
            pair = np.repeat(np.arange(len(h), dtype=np.int32), sizes)
            parts.append((h, w, np.bincount(pair, times * train[who], len(h))))
            entries.append((docs, pair, who, times))
        if not parts:
            return pa.Table.from_batches(out)
        h, w, n = (np.concatenate(x) for x in zip(*parts, strict=True))
        starts = np.cumsum([0, *(len(x[0]) for x in parts)])
        del parts
        order = by_pair(h, w)
        new = _new(h[order], w[order])
        number = np.empty(len(h), dtype=np.int32)
        number[order] = np.cumsum(new, dtype=np.int32) - 1
        first = np.flatnonzero(new)
        r = np.add.reduceat(n[order], first)
        h, w = h[order][first], w[order][first]
        del order, new, n
        at, hot_pair = hot.pair_places(h, w)
        r[hot_pair] = hot.pair_counts[at[hot_pair]]
        words, of = np.unique(w, return_inverse=True)
        c = np.bincount(of, r, len(words))
        at, hot_word = hot.places(words)
        c[hot_word] = hot.word_counts[at[hot_word]]  # the others' pairs are all in this bucket
        out.append(_told(3, np.zeros(1, dtype=np.int64), v=[[((c > 0) & ~hot_word).sum()]]))
        chance = unigram(c, hot.tokens, words == _END)[of]
        known, log_c, log_chance = (c > 0)[of], np.log10(c + 1)[of], np.log10(chance)
        seen = r > 0
        large = np.where(r > DISCOUNTED, np.log10(np.maximum(r, 1)), 0.0)
        for (docs, pair, who, times), start in zip(entries, starts, strict=False):
            p = number[start + pair]
            own = r[p]
            sums = [
                times,
                times * known[p],
                times * log_c[p],
                times * np.where(own > 0, large[p], log_chance[p]),
                *(times * (own == k) for k in range(1, DISCOUNTED + 1)),
            ]
            out.append(_told(0, docs, v=np.column_stack([np.bincount(who, x, len(docs)) for x in sums])))
            rest = own == 0
            if rest.any():
                out.append(_told(2, docs[who[rest]], h[p[rest]], times[rest][:, None]))
        mine = seen & ~hot_pair
        ids, sums = history_sums(h[mine], r[mine], chance[mine])
        out.append(_told(1, ids, v=sums))
        return pa.Table.from_batches(out)

    return tidy(run)


def discounts(seen: list[float]) -> list[float]:
    """The discounts for counts from 1 to ``DISCOUNTED``, from how many pairs were seen 1, 2, ...
    ``DISCOUNTED + 1`` times. A count for which the formula has no sense is not discounted."""
    k = len(seen) - 1
    if not seen[0]:
        return [1.0] * k
    common = (k + 1) * seen[k] / seen[0]
    out = []
    for r in range(1, k + 1):
        d = 1.0
        if seen[r - 1] and seen[r] and common < 1:
            d = ((r + 1) * seen[r] / (r * seen[r - 1]) - common) / (1 - common)
        out.append(d if 0 < d < 1 else 1.0)
    return out


def _hot(learned: DataFrame, sample: DataFrame, most: int) -> Hot:
    """The frequent words and pairs of the sample, with their counts in all of ``learned``."""
    found = stored(
        sample.mapInArrow(_sampled, "h long, w long, n long")
        .groupBy("h", "w")
        .agg(F.sum("n").alias("n")),
        "often",
    )
    top = lambda pairs: found.where(pairs).orderBy(F.desc("n"), "h", "w").limit(most).toPandas()
    as_ids = lambda x: x.to_numpy(dtype=np.int64).view(np.uint64)
    pairs = top("h <> 0")
    h, w = as_ids(pairs["h"]), as_ids(pairs["w"])
    order = np.argsort(pair_keys(h, w))
    h, w = h[order], w[order]
    words = np.unique(np.concatenate([as_ids(top("h = 0")["w"]), w, [_END]]).astype(np.uint64))
    hot = Hot(words, np.zeros(len(words)), pair_keys(h, w), h, w, np.zeros(len(h)))
    counts = learned.mapInArrow(
        _counted(learned.sparkSession.sparkContext.broadcast(hot)), "place long, n long"
    )
    counts = counts.groupBy("place").agg(F.sum("n").alias("n")).collect()
    total = np.zeros(len(words) + len(h) + 1)
    for row in counts:
        total[row["place"]] = row["n"]
    hot.word_counts, hot.pair_counts = total[: len(words)], total[len(words) : -1]
    hot.tokens = int(total[-1])
    return hot


def histories(found: DataFrame, hot: Hot) -> tuple[DataFrame, list[float]]:
    """``(h, weight, seen)``, a row for each history: the logarithms of its backoff weight and of its
    count and one; and the discounts."""
    spark = found.sparkSession
    names = [f"r{r}" for r in range(1, DISCOUNTED + 2)] + ["large", "mass"]
    parts = found.where("kind = 1").select(
        F.col("id").alias("h"), *(F.col("v")[k].alias(name) for k, name in enumerate(names))
    )
    own = hot.pair_counts > 0
    if own.any():
        at, _ = hot.places(hot.w[own])
        chance = unigram(hot.word_counts[at], hot.tokens, hot.w[own] == _END)
        h, sums = history_sums(hot.h[own], hot.pair_counts[own], chance)
        rows = [(int(a), *map(float, s)) for a, s in zip(h.view(np.int64), sums, strict=True)]
        parts = parts.union(spark.createDataFrame(rows, parts.schema))
    whole = stored(parts.groupBy("h").agg(*(F.sum(n).alias(n) for n in names)), "histories")
    n_seen = whole.agg(*(F.sum(n) for n in names[: DISCOUNTED + 1])).first()
    d = discounts([v or 0.0 for v in n_seen])
    of_count = [(r, F.col(f"r{r}"), d[r - 1]) for r in range(1, DISCOUNTED + 1)]
    total = sum((n * r for r, n, _ in of_count), F.col("large"))
    used = sum((n * r * x for r, n, x in of_count), F.col("large"))
    weight = (1 - used / (total + 1)) / F.greatest(1 - F.col("mass"), F.lit(1e-12))
    return whole.select("h", F.log10(weight).alias("weight"), F.log10(total + 1).alias("seen")), d


def katz_scores(
    docs: DataFrame,
    train: Column,
    block_bytes: int = BLOCK_BYTES,
    bucket_bytes: int = BUCKET_BYTES,
    sample_documents: int = SAMPLE_DOCUMENTS,
    hot_keys: int = HOT_KEYS,
) -> DataFrame:
    """``(doc_id, n_tokens, n_known, train_tokens, base_score, score)`` for every row of ``docs``;
    the rows for which ``train`` holds are learned from.

    Words are ``[^\\x20\\x09-\\x0D]+`` in lower case (A-Z alone), and one end follows them. A null text
    is an empty one and has the end alone. Rows count each, also if they repeat ``doc_id`` or have
    none; equal texts score the same. A very long text is a block of its own. Without training rows
    every word is a never seen one. Other columns do not matter. No input: no rows.
    """
    small_batches(docs.sparkSession)
    named = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
        F.coalesce(train, F.lit(False)).alias("train"),
    )
    n_train, n_bytes = named.agg(
        F.count_if("train"), F.sum(F.octet_length("text").cast("long"))
    ).first()
    buckets = max(1, math.ceil((n_bytes or 0) / bucket_bytes))
    learned = named.where("train").select("text")
    sample = learned
    if n_train > sample_documents:
        sample = stored(learned.sample(sample_documents / n_train, seed=11), "sample")
    hot = _hot(learned, sample, hot_keys)
    shared = docs.sparkSession.sparkContext.broadcast(hot)
    found = stored(
        named.mapInArrow(_dealt(shared, buckets, block_bytes), _PACKED_SCHEMA)
        .groupBy("bucket")
        .applyInArrow(_of_pairs(shared), _FOUND),
        "pairs",
        "kind",
    )
    table, d = histories(found, hot)
    table = stored(table, "backoff")

    # Pairs never seen: their first words are in the table of histories; the hot ones by broadcast.
    hot_words = docs.sparkSession.createDataFrame(
        [(int(w),) for w in [*hot.words.view(np.int64), int(_START)]], "h long"
    )
    hot_table = table.join(F.broadcast(hot_words), "h")
    unseen = found.where("kind = 2").select("id", "h", F.col("v")[0].alias("times"))
    of_hot = unseen.join(F.broadcast(hot_words), "h").join(F.broadcast(hot_table), "h", "left")
    others = unseen.join(F.broadcast(hot_words), "h", "left_anti").join(table, "h", "left")
    # After a history never seen the unigrams alone decide.
    both = F.coalesce(F.col("weight") + F.col("seen"), F.lit(0.0))
    gains = of_hot.unionByName(others).groupBy("id").agg(F.sum(F.col("times") * both).alias("backed"))

    names = ["tokens", "known", "logs", "score", *(f"r{r}" for r in range(1, DISCOUNTED + 1))]
    sums = found.where("kind = 0").groupBy("id").agg(
        *(F.sum(F.col("v")[k]).alias(name) for k, name in enumerate(names))
    )
    n_words = found.where("kind = 3").agg(F.sum(F.col("v")[0])).first()[0] or 0
    n_words += int((hot.word_counts > 0).sum())
    ids = found.where("kind = 4").select("id", F.col("h").alias("doc_id"))
    seen = sum((F.col(f"r{r}") * math.log10(d[r - 1] * r) for r in range(1, DISCOUNTED + 1)), F.col("score"))
    # Every token but the start is the second word of a pair, every one but the end the first word of
    # one; starts and ends are as many. So the logarithms of the counts add up to the same for both.
    return (
        ids.join(sums, "id")
        .join(gains, "id", "left")
        .select(
            "doc_id",
            F.round("tokens").cast("long").alias("n_tokens"),
            F.round("known").cast("long").alias("n_known"),
            F.lit(hot.tokens).cast("long").alias("train_tokens"),
            (F.col("logs") - F.col("tokens") * math.log10(hot.tokens + n_words + 1)).alias("base_score"),
            (seen - F.col("logs") + F.coalesce("backed", F.lit(0.0))).alias("score"),
        )
    )
