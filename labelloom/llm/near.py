"""Near duplicates: a join of shingle sets by Jaccard similarity, and its connected groups.

The sets are the distinct five-word shingles of the texts (``words.shingle_sets``). Equal sets are
one set from the first step on. Shingles are put in one order for all sets: rare ones first, then
frequent ones, each by their hash. Two sets of sizes up to ``n`` that are similar share ``t`` or more
shingles, ``t`` being 80 % of ``n``; the first ``c`` they share stand among the first ``n - t + c``
of either. So each set is indexed under

* every rare shingle among its first ``n - t + 1``: the first shared one, if that is rare;
* else, all shared ones being frequent: the first ``n - t + 1 + m`` are dealt into ``m`` classes by
  their hash, and every pair of frequent ones in the same class is a key. Of ``m + 1`` shared ones
  two are in the same class. ``m`` grows with the size of the set, so its keys grow in proportion to
  its size; a set is indexed for the ``m`` of each size a larger partner can have.

Which shingles count as frequent decides the speed alone. A scan counts them block by block, and
those that repeat within blocks often enough are sent to all tasks, the most frequent
``FREQUENT_SHINGLES`` at most.

Under each key one set is the pivot, and the others are compared with it first: a group of thousands
of near copies is linked by as many comparisons. The pivot is the set with the smallest share of
shingles that only it has, which the original of many copies is. Keys under which the others are not all
connected by then go on as in ``minmax``: only sets of different components under a key are compared, and
under keys of many sets those with too few shingles that open sets of other components share meet
nobody again. Nothing is left out.

A pair is dropped when its overlap is bound too low: by the keys that each of the sets has for itself,
and as shared shingles that are not among its shared single keys come, in one of the sets, after the
last of these. Of the other pairs, sets of half hashes are intersected, which finds no fewer common
shingles than there are, and where those suffice whole sets are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelloom.llm.minmax import Search, digest_of, linked, lowest_ids, named_sets, sets_of
from labelloom.llm.words import mixed
from labelloom.llm.work import documents, only, stored, tidy

SIMILARITY = 80
SHINGLE_WORDS = 5
#: Times a shingle is seen again within blocks before it counts as frequent.
FREQUENT_FROM = 48
#: Frequent shingles sent to every task, 8 bytes each.
FREQUENT_SHINGLES = 1 << 18
#: Shingles counted at a time.
BLOCK_SHINGLES = 2 << 20
#: Texts that go to a task at a time: their shingles take more room than they do.
TEXTS = 250
#: Names of sets that a task remembers.
SEEN_SETS = 500_000
#: Sets under a key up to which their shared shingles need not be counted.
FEW_SETS = 64
#: Rounds of comparing with a pivot before sets under a key are compared with each other.
PIVOT_ROUNDS = 2


def _repeats(words: int, block: int):
    """``(shingle, n)``: how many of the different sets of a block have it, if more than one does."""

    def counted(sets: list[np.ndarray]) -> pa.RecordBatch:
        shingles = np.concatenate(sets)
        sets.clear()
        shingles, n = np.unique(shingles, return_counts=True)
        again = n > 1
        return pa.RecordBatch.from_arrays(
            [pa.array(shingles[again].view(np.int64)), pa.array(n[again].astype(np.int64))],
            ["shingle", "n"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, seen = [], 0, set()
        for _, sets in sets_of(batches, words):
            for s in sets:
                if len(s) and (name := digest_of(s)) not in seen:
                    seen.add(name)
                    held.append(s)
                    size += len(s)
            if size >= block:
                yield counted(held)
                held, size, seen = [], 0, set()
        if held:
            yield counted(held)

    return tidy(run)


def levels(n: int, similarity: int) -> range:
    """The numbers ``k`` of ``2 ** k`` classes under which a set of size ``n`` is indexed."""
    return range((n // 40).bit_length(), (100 * n // similarity // 40).bit_length() + 1)


def keys_of(shingles: np.ndarray, frequent: np.ndarray, similarity: int):
    """The keys of a set, and how many of them are single shingles. Those come first; the place of
    each is its position in the set."""
    n = len(shingles)
    spare = n - (similarity * n + 99) // 100  # it may lack so many of a similar set's shingles
    where = np.searchsorted(frequent, shingles)
    common = frequent[np.minimum(where, len(frequent) - 1)] == shingles if len(frequent) else None
    if common is None or not common.any():
        return shingles[: spare + 1], spare + 1
    rare, common = shingles[~common], shingles[common]
    keys = [rare[: spare + 1]]
    if len(rare) <= spare:
        for k in levels(n, similarity):
            first = common[: spare + 1 + (1 << k) - len(rare)]
            kind = first & np.uint64((1 << k) - 1)
            order = np.argsort(kind, kind="stable")
            first, kind = first[order], kind[order]
            for part in np.split(first, np.flatnonzero(np.diff(kind)) + 1):
                i, j = np.triu_indices(len(part), 1)
                keys.append(
                    mixed(part[i] * np.uint64(0x9E3779B97F4A7C15) + mixed(part[j] + np.uint64(k)))
                )
    return np.concatenate(keys), len(keys[0])


def all_rare(n: int, singles: int, similarity: int) -> bool:
    """Whether a set's single keys are all its rare shingles."""
    return singles <= n - (similarity * n + 99) // 100


def _indexed(frequent, words: int, similarity: int):
    """Of each document its set's digest and size; with the first document of a set in a task also
    the keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = frequent.value
        seen: set[bytes] = set()
        row = TaskContext.get().partitionId() << 36
        for ids, sets in sets_of(batches, words):
            names, keys, singles = [], [], []
            for s in sets:
                name = digest_of(s) if len(s) else None
                names.append(name)
                if name is None or name in seen:
                    keys.append(None)
                    singles.append(None)
                else:
                    seen.add(name)
                    k, single = keys_of(s, common, similarity)
                    keys.append(k.view(np.int64))
                    singles.append(single)
            if len(seen) > SEEN_SETS:
                seen.clear()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(row, row + len(sets))),
                    ids,
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(names, pa.binary()),
                    pa.array(keys, pa.list_(pa.int64())),
                    pa.array(singles, pa.int32()),
                ],
                ["row", "doc_id", "n_shingles", "digest", "keys", "singles"],
            )
            row += len(sets)

    return tidy(run)


def _halves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(node, shingles)`` with half of each hash, in ascending order."""
    for batch in batches:
        halves = [
            np.sort(np.frombuffer(x.as_buffer(), dtype=np.uint64).astype(np.uint32)).tobytes()
            for x in batch.column("shingles")
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column("node"), pa.array(halves, pa.binary())], ["node", "shingles"]
        )


def _similar(similarity: int, kind: type):
    """The pairs whose whole sets are similar enough; with half hashes no pair of these is missing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x = np.frombuffer(x.as_buffer(), dtype=kind)
                y = np.frombuffer(y.as_buffer(), dtype=kind)
                at = np.minimum(np.searchsorted(y, x), max(len(y) - 1, 0))
                both = int((y[at] == x).sum()) if len(y) else 0
                keep.append(100 * both >= similarity * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return tidy(run)


def _possible(similarity: int):
    """The pairs that may be similar by the keys they share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            columns = (batch.column(k) for k in range(2, 8))
            for m, n, i, j, x, y in zip(*columns, strict=True):
                m, n = m.as_py(), n.as_py()
                i, j = i.as_py(), j.as_py()
                x, y = x.values.to_numpy()[:i], y.values.to_numpy()[:j]
                both = len(np.intersect1d(x, y, assume_unique=True))
                # Every shared shingle up to the end of the keys that end first is counted. Where all
                # rare ones are keys, only frequent ones are left.
                x_whole, y_whole = all_rare(m, i, similarity), all_rare(n, j, similarity)
                if x_whole and y_whole:
                    most = both + min(m - i, n - j)
                elif y_whole or not x_whole and x.view(np.uint64)[-1] < y.view(np.uint64)[-1]:
                    most = both + m - i
                else:
                    most = both + n - j
                keep.append((100 + similarity) * most >= similarity * (m + n))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return tidy(run)


class _Join(Search):
    """The search with keys of rare shingles and of pairs of frequent ones. ``reach`` bounds the
    overlap of two sets from one side: for the one whose keys end first."""

    carried = ("reach", "singles", "extra")
    of_rows = ("single",)
    few = FEW_SETS

    def under_keys(self) -> DataFrame:
        rows = self.sets.select(
            F.col("n").cast("int").alias("n"),
            "node",
            "singles",
            F.posexplode("keys").alias("position", "key"),
        )
        rows = rows.select(
            "key",
            F.hash("key").alias("part"),
            "node",
            "n",
            "singles",
            (F.col("position") < F.col("singles")).alias("single"),
        )
        # Half the bits of a key are enough to drop nearly all that occur once, at half the cost.
        repeated = rows.groupBy("part").agg(F.count("*").alias("times")).where("times > 1").select("part")
        met = stored(rows.join(repeated, "part").drop("part"), "met")
        # Shingles of a set that are keys of others, too, or no keys.
        reach = met.groupBy(F.col("node").alias("of")).agg(
            F.least(F.max(F.col("n") - F.col("singles")) + F.count_if("single"), F.max("n"))
            .cast("int")
            .alias("reach")
        )
        reach = stored(reach, "reach")
        rows = met.join(reach, met["node"] == reach["of"]).drop("of")
        return stored(
            rows.withColumn("met", F.col("reach") / F.col("n"))
            .withColumn("usable", F.col("n"))
            .withColumn("extra", F.col("singles"))
            .withColumn("component", F.col("node"))
            .withColumn("done", F.lit(False)),
            "shared",
        )

    def split(self, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        """``extra`` is how many single keys of a set are not among the rows."""
        light, heavy = super().split(rows)
        others = heavy.groupBy(F.col("node").alias("of")).agg(F.count_if("single").alias("others"))
        light = light.join(others, light["node"] == others["of"], "left").drop("of", "extra")
        light = light.withColumn("extra", F.coalesce("others", F.lit(0)).cast("int")).drop("others")
        return stored(light, "light"), heavy

    def met(self, joined: DataFrame) -> DataFrame:
        """Between components every shared key of few sets is met here. The same bound as in
        ``_possible``, but for not knowing whose keys end first."""
        about = [f"{c}_{x}" for c in ("node", "n", "singles", "extra") for x in "ab"]
        fit = joined.where((F.col("component_a") != F.col("component_b")) & self.fits())
        met = fit.groupBy(*about).agg(F.count_if("single").alias("shared"))
        rest = [F.col(f"n_{x}") - F.col(f"singles_{x}") for x in "ab"]
        spare = lambda x: F.col(f"n_{x}") - F.ceil(F.col(f"n_{x}") * self.similarity / 100.0)
        whole = (F.col("singles_a") <= spare("a")) & (F.col("singles_b") <= spare("b"))
        most = F.when(whole, F.least(*rest)).otherwise(F.greatest(*rest))
        most = most + F.col("shared") + F.least("extra_a", "extra_b")
        enough = (100 + self.similarity) * most >= self.similarity * (F.col("n_a") + F.col("n_b"))
        return met.where(enough).select(
            F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")
        )

    def fits(self) -> Column:
        """Whether two sets can have enough in common. What the further keys of the set whose keys end
        last share may be no key of the other set, so the larger reach counts."""
        both = (100 + self.similarity) * F.greatest("reach_a", "reach_b")
        return self.sizes_fit() & (both >= self.similarity * (F.col("n_a") + F.col("n_b")))

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """The links among ``pairs``; reads the keys, and then the texts, of those alone."""
        pairs = stored(pairs, "pairs")
        wanted = stored(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "wanted")
        keys = only(self.sets.select("node", "n", "singles", "keys"), wanted, "node")
        possible = stored(
            self.with_both(pairs, keys).mapInArrow(_possible(self.similarity), "a long, b long"),
            "possible",
        )
        contents = self.contents(possible.select(F.explode(F.array("a", "b")).alias("node")))
        halves = contents.mapInArrow(tidy(_halves), "node long, shingles binary")
        for kind, shingles in ((np.uint32, halves), (np.uint64, contents)):
            both = self.with_both(possible, shingles)
            possible = stored(both.mapInArrow(_similar(self.similarity, kind), "a long, b long"), "links")
        return possible


def near_groups(
    docs: DataFrame,
    similarity: int = SIMILARITY,
    words: int = SHINGLE_WORDS,
    frequent_from: int = FREQUENT_FROM,
    pivot_rounds: int = PIVOT_ROUNDS,
    block_shingles: int = BLOCK_SHINGLES,
) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for every row of ``docs``: the smallest ``doc_id``
    that links lead to, a link being a similarity of ``similarity`` percent or more.

    A null text and one without words have no shingles and no links. Rows of equal words are one
    group. A null ``doc_id`` never names a group that has another. No input: no rows.
    """
    docs = documents(docs, TEXTS)
    context = docs.sparkSession.sparkContext
    often = (
        docs.mapInArrow(_repeats(words, block_shingles), "shingle long, n long")
        .groupBy("shingle")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= frequent_from)
        .orderBy(F.desc("n"), "shingle")
        .limit(FREQUENT_SHINGLES)
        .select("shingle")
        .toArrow()["shingle"]
    )
    frequent = context.broadcast(np.sort(often.to_numpy().view(np.uint64)))
    rows = stored(
        docs.mapInArrow(
            _indexed(frequent, words, similarity),
            "row long, doc_id long, n_shingles long, digest binary, keys array<long>, singles int",
        ),
        "sets",
    )
    names, firsts = named_sets(rows, "keys", "singles")
    search = _Join(docs, firsts, words, similarity)
    lowest = lowest_ids(names, linked(search, pivot_rounds))
    return rows.select("doc_id", "n_shingles", "digest").join(lowest, "digest", "left").select(
        "doc_id", "n_shingles", F.coalesce("lowest", "doc_id").alias("component_id")
    )
