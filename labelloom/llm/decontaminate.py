"""Benchmark decontamination: every training passage is a query on an index of the test items.

The items are the indexed documents of BM25. The threshold of an item is the least score of a passage
that has enough of the item's shingles to be reported: each missing shingle takes away one word at
most, so it is the sum of the item's smallest weights without so many of the largest; but a question or
an answer that may be missing as a whole takes away all words that only it has. Weights are
divided by it, and the threshold is 1 for all. Documents are cut into overlapping passages, twice as
long as the longest item and starting one such length apart, so that any copy of an item is whole in
one of them. A passage goes through

1. block maxima: for ever smaller blocks of items, the largest weights of the passage's distinct terms
   in each block are summed, for all passages of a chunk at once. Where no sum reaches the threshold,
   no item of any block can;
2. block-max WAND over the posting lists of the other blocks, which retrieves every item at or above
   the threshold;
3. verification: the share of the item's five-word shingles, of its question and its answer, that are
   in the passage.

Documents are only scanned, never shuffled. The index is sent to all tasks in slices of at most
``POSTINGS`` postings; a larger benchmark takes more slices, each of which scans the documents once.
Statistics (document frequencies, lengths) are of all items in any case.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.llm.words import ALPHANUMERIC, Hasher, chunks, sequences
from labelloom.llm.work import documents, stored

OVERLAP = 0.8
SHINGLE_WORDS = 5
POSTINGS = 500_000
#: Blocks of items in the first and in the last rounds of sums, the table of maxima permitting.
BOUND_BLOCKS = (16, 64, 256)
BOUND_BYTES = 64 << 20
BLOCK_ITEMS = 8
_K1, _B = 1.2, 0.75

_OUT = (
    "doc_id long, item_id long, score double, overlap double, question_overlap double,"
    " answer_overlap double"
)


class Index:
    """Posting lists of a slice of items, by term; items are numbered by their lengths."""

    def __init__(self, items: list[tuple], postings: list[tuple], overlap: float) -> None:
        """``items``: (item_id, words, question, answer); ``postings``: (item_id, term, weight)."""
        items = sorted(items, key=lambda x: (x[1], x[0]))
        self.item_ids = [x[0] for x in items]
        self.longest = max((x[1] for x in items), default=1) or 1
        number = {x: k for k, x in enumerate(self.item_ids)}
        hasher = Hasher(ALPHANUMERIC)
        texts = [[_part(hasher, text) for text in x[2:]] for x in items]
        self.parts = [[(size, shingles) for size, shingles, _ in x] for x in texts]
        where = np.array([number[x[0]] for x in postings], dtype=np.int64)
        terms = np.array([x[1] for x in postings], dtype=np.int64).view(np.uint64)
        weights = np.array([x[2] for x in postings], dtype=np.float64)
        order = np.argsort(where, kind="stable")
        self.whole = np.bincount(where, weights, minlength=len(items))  # the score of all its terms
        least = np.ones(len(items))
        cuts = np.cumsum(np.bincount(where, minlength=len(items)))[:-1]
        of_items = zip(np.split(terms[order], cuts), np.split(weights[order], cuts), strict=True)
        for k, (own, w) in enumerate(of_items):
            least[k] = _least(own, w, [x[1:] for x in texts[k]], overlap)
        weights = weights / least[where]
        self.whole /= least
        order = np.lexsort((where, terms))
        where, terms, weights = where[order], terms[order], weights[order]
        self.terms, starts = np.unique(terms, return_index=True)
        cuts = [*starts.tolist(), len(terms)]
        self.lists = [where[a:b].tolist() for a, b in zip(cuts, cuts[1:], strict=False)]
        self.weights = [weights[a:b].tolist() for a, b in zip(cuts, cuts[1:], strict=False)]
        self.most = [max(w) for w in self.weights]
        self.blocks = []  # for each term, the largest weight in each block of items it occurs in
        for items_of, weights_of in zip(self.lists, self.weights, strict=True):
            most: dict[int, float] = {}
            for k, w in zip(items_of, weights_of, strict=True):
                most[k // BLOCK_ITEMS] = max(w, most.get(k // BLOCK_ITEMS, 0.0))
            self.blocks.append(most)
        of = np.repeat(np.arange(len(self.terms)), np.diff(cuts))
        self.bounds = []
        for n in BOUND_BLOCKS:
            if n == BOUND_BLOCKS[0] or 4 * n * len(self.terms) <= BOUND_BYTES:
                table = np.zeros((len(self.terms), n), dtype=np.float32)
                np.maximum.at(table, (of, where // (-(-len(items) // n) or 1)), weights)
                self.bounds.append(table)

    def search(self, terms: list[int], blocks: list[tuple[int, int]]) -> list[tuple[int, float]]:
        """Every (item number, score) at or above the threshold in these ranges of item numbers."""
        found = []
        for first, end in blocks:
            cursors = []  # item, term, place in its list
            for t in terms:
                items = self.lists[t]
                place = bisect_left(items, first)
                if place < len(items) and items[place] < end:
                    cursors.append([items[place], t, place])
            found += self._searched(cursors, end)
        return found

    def _searched(self, cursors: list[list[int]], end: int) -> list[tuple[int, float]]:
        """Block-max WAND up to the item number ``end``."""
        found, threshold = [], 1 - 1e-6
        while True:
            cursors.sort()
            bound, pivot = 0.0, None
            for k, (item, t, _) in enumerate(cursors):
                if item == end:
                    break
                bound += self.most[t]
                if bound >= threshold:
                    pivot = k
                    break
            if pivot is None:
                return found
            item = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
                pivot += 1
            block = item // BLOCK_ITEMS
            front = cursors[: pivot + 1]
            if sum(self.blocks[t].get(block, 0.0) for _, t, _ in front) < threshold:
                # No item of this block up to the next list's can reach it.
                target = (block + 1) * BLOCK_ITEMS
                if pivot + 1 < len(cursors):
                    target = min(target, cursors[pivot + 1][0])
                target = max(target, item + 1)
            elif front[0][0] == item:
                score = sum(self.weights[t][place] for _, t, place in front)
                if score >= threshold:
                    found.append((item, score))
                target = item + 1
            else:
                target = item
            for c in front:
                if c[0] < target:
                    items = self.lists[c[1]]
                    c[2] = bisect_left(items, target, c[2])
                    c[0] = min(items[c[2]], end) if c[2] < len(items) else end


def _least(terms: np.ndarray, weights: np.ndarray, parts: list[tuple], overlap: float) -> float:
    """The least score of a passage with so much of an item. ``parts``: (shingles, terms)."""
    missing = int((1 - overlap) * sum(len(shingles) for shingles, _ in parts) + 1e-9)

    def without_largest(w: np.ndarray, n: int) -> float:
        return float(np.sort(w)[: max(1, len(w) - n)].sum())

    least = without_largest(weights, missing)  # no part is missing as a whole
    for k, (shingles, _) in enumerate(parts):
        others = [own for j, (_, own) in enumerate(parts) if j != k]
        left = np.isin(terms, np.concatenate(others)) if others else np.zeros(len(terms), dtype=bool)
        if len(shingles) <= missing and left.any():
            least = min(least, without_largest(weights[left], missing - len(shingles)))
    return least


def _part(hasher: Hasher, text: str) -> tuple[int, np.ndarray, np.ndarray]:
    """``(words in a shingle, shingles, terms)``, each once."""
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    hashes = hasher.words(data, np.array([0, len(data)]))[2]
    size = min(SHINGLE_WORDS, len(hashes)) or 1
    return size, np.unique(sequences(hashes, size)), np.unique(hashes)


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(item_id, words, term, tf)`` of the items' whole texts."""
    hasher = Hasher(ALPHANUMERIC)
    for batch in batches:
        ids = batch.column(batch.schema.get_field_index("item_id")).to_pylist()
        for a, _, data, offsets in chunks(batch):
            _, _, hashes, first = hasher.words(data, offsets)
            for d in range(len(offsets) - 1):
                own = hashes[first[d] : first[d + 1]]
                term, tf = np.unique(own, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([ids[a + d]] * len(term), pa.int64()),
                        pa.array(np.full(len(term), len(own), dtype=np.int64)),
                        pa.array(term.view(np.int64)),
                        pa.array(tf.astype(np.int64)),
                    ],
                    ["item_id", "words", "term", "tf"],
                )


def _candidates(index: Index, hashes, first):
    """``(document, first word, last word + 1, distinct terms, ranges of items)`` of the passages that
    may reach the threshold, and where."""
    step = index.longest
    counts = np.diff(first)
    passages = np.maximum(1, -(-counts // step) - 1)
    base = np.concatenate([[0], np.cumsum(passages)])
    term = np.searchsorted(index.terms, hashes)
    known = np.flatnonzero(index.terms[np.minimum(term, len(index.terms) - 1)] == hashes)
    if not len(known):
        return
    document = np.searchsorted(first, known, side="right") - 1
    part = (known - first[document]) // step
    n = len(index.terms)
    keys = []
    for shift in (0, 1):  # a part is the first half of a passage and the second of the one before
        p = part - shift
        ok = (p >= 0) & (p < passages[document])
        keys.append((base[document[ok]] + p[ok]) * n + term[known[ok]])
    keys = np.unique(np.concatenate(keys))
    passage, term = np.divmod(keys, n)
    starts = np.flatnonzero(np.diff(passage, prepend=-1))
    for bounds in index.bounds:
        enough = np.add.reduceat(bounds[term], starts, axis=0) >= 1 - 1e-4
        some = enough.any(axis=1)
        keep = np.repeat(some, np.diff(np.append(starts, len(term))))
        passage, term, enough = passage[keep], term[keep], enough[some]
        if not len(term):
            return
        starts = np.flatnonzero(np.diff(passage, prepend=-1))
    size = -(-len(index.item_ids) // enough.shape[1]) or 1
    for p, own, good in zip(passage[starts], np.split(term, starts[1:]), enough, strict=True):
        d = int(np.searchsorted(base, p, side="right")) - 1
        a = int(first[d] + (p - base[d]) * step)
        blocks = [(k * size, (k + 1) * size) for k in np.flatnonzero(good).tolist()]
        yield d, a, min(a + 2 * step, int(first[d + 1])), own.tolist(), blocks


def _leaks(shared, overlap: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, hasher = shared.value, Hasher(ALPHANUMERIC)
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("doc_id")).to_pylist()
            best: dict[tuple[int, int], tuple] = {}
            for row, _, data, offsets in chunks(batch):
                _, _, hashes, first = hasher.words(data, offsets)
                for d, a, b, terms, blocks in _candidates(index, hashes, first):
                    for item, score in index.search(terms, blocks):
                        found, sizes = [], []
                        for size, shingles in index.parts[item]:
                            own = sequences(hashes[a:b], size)
                            found.append(int(np.isin(shingles, own).sum()))
                            sizes.append(len(shingles))
                        share = sum(found) / (sum(sizes) or 1)
                        if share >= overlap:
                            parts = [f / s if s else None for f, s in zip(found, sizes, strict=True)]
                            key = (row + d, item)
                            if key not in best or share > best[key][0]:
                                best[key] = (share, score / index.whole[item], parts)
            rows = sorted(best.items(), key=lambda x: x[0])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([ids[d] for (d, _), _ in rows], pa.int64()),
                    pa.array([index.item_ids[k] for (_, k), _ in rows], pa.int64()),
                    pa.array([x[1] for _, x in rows], pa.float64()),
                    pa.array([x[0] for _, x in rows], pa.float64()),
                    pa.array([x[2][0] for _, x in rows], pa.float64()),
                    pa.array([x[2][1] for _, x in rows], pa.float64()),
                ],
                ["doc_id", "item_id", "score", "overlap", "question_overlap", "answer_overlap"],
            )

    return run


def questions_and_answers(benchmark: DataFrame) -> DataFrame:
    """``(item_id, question, answer)`` of items that are one text: the last sentence or line is the
    answer; a text of one sentence is all question."""
    text = F.coalesce(F.col("text"), F.lit(""))
    split = r"(?s)^(.*[.!?\n])\s+(\S.*?)\s*$"
    question, answer = F.regexp_extract(text, split, 1), F.regexp_extract(text, split, 2)
    return benchmark.select(
        F.col("item_id").cast("long").alias("item_id"),
        F.when(answer == "", text).otherwise(question).alias("question"),
        answer.alias("answer"),
    )


def leaked_items(
    docs: DataFrame,
    items: DataFrame,
    overlap: float = OVERLAP,
    slice_postings: int = POSTINGS,
) -> DataFrame:
    """``(doc_id, item_id, score, overlap, question_overlap, answer_overlap)`` for every row of
    ``docs`` and item of ``items`` (``item_id``, ``question``, ``answer``) that it contains.

    ``score`` is the BM25 score of the best passage as a share of the item's own, 1 at most; ``overlap`` the share of the item's
    shingles in it, ``overlap`` or more. A part of fewer than five words is one shingle; the overlap
    of a part without words is null. Null and empty texts contain nothing, and items without words
    or ``item_id`` are nowhere; items that repeat an ``item_id`` are one item, by their smallest
    texts. Repeated documents are reported each.
    """
    docs = documents(docs)
    spark = docs.sparkSession
    items = stored(
        items.where("item_id IS NOT NULL")
        .select(
            "item_id",
            F.struct(
                F.coalesce("question", F.lit("")).alias("question"),
                F.coalesce("answer", F.lit("")).alias("answer"),
            ).alias("parts"),
        )
        .groupBy("item_id")
        .agg(F.min("parts").alias("parts"))
        .select("item_id", "parts.question", "parts.answer"),
        "items",
    )
    texts = items.select("item_id", F.concat_ws("\n", "question", "answer").alias("text"))
    terms = stored(
        texts.mapInArrow(_terms, "item_id long, words long, term long, tf long"), "terms"
    )
    n, average, postings = terms.agg(
        F.count_distinct("item_id"), F.avg("words"), F.count("*")
    ).first()
    if not n:
        return spark.createDataFrame([], _OUT)
    found_in = terms.groupBy("term").agg(F.count("*").alias("df"))
    weight = (
        F.log(1 + (F.lit(n) - F.col("df") + 0.5) / (F.col("df") + 0.5))
        * F.col("tf")
        * (_K1 + 1)
        / (F.col("tf") + _K1 * (1 - _B + _B * F.col("words") / F.lit(average)))
    )
    weights = stored(terms.join(found_in, "term").withColumn("weight", weight), "weights")
    lengths = weights.groupBy("item_id").agg(F.max("words").alias("words"))
    slices = math.ceil(postings / slice_postings)
    of = F.pmod(F.xxhash64("item_id"), F.lit(slices))
    parts = []
    for k in range(slices):
        own = weights.where(of == k)
        own = own.select("item_id", "term", "weight")
        named = items.where(of == k).join(lengths, "item_id")
        named = named.select("item_id", "words", "question", "answer")
        index = Index([tuple(r) for r in named.collect()], [tuple(r) for r in own.collect()], overlap)
        shared = spark.sparkContext.broadcast(index)
        parts.append(docs.mapInArrow(_leaks(shared, overlap), _OUT))
    return reduce(DataFrame.union, parts)
