"""Near duplicates by min-max hashing.

The sets are the distinct three-word shingles of the texts; equal sets are one set from the first step
on. Under each of ``PERMUTATIONS`` permutations both the least and the greatest hash of a set are kept,
so a signature has two values for each hash that is evaluated. Each is equal for two sets with their
Jaccard similarity as probability; as a set's least and greatest seldom are the same shingle, their
mean varies less than that of as many values of half the permutations would.

* Banding: the values of ``BAND`` permutations make the key of a band. At a similarity of 0.85 two
  sets share none of the 32 bands with a probability of 3 in 10 million.
* Four bits of each value make a sketch of 192 bytes. Pairs under a key whose sketches differ in more
  values than those of similar sets do (but for 1 in 10 million) go no further.
* What is left is confirmed on the full sets.

Under a key not all sets meet: the one that meets the most sets over all its keys, which the original
of many copies does, is compared with the others first. Keys under which the others are not all
connected by then go on. Of their sets the shingles that sets of different components share are counted:
no two sets can have more in common than the lesser of their counts, so a copy with too many words of
its own meets nobody again. The next pivot of a key comes from outside the component of the first; after
``ROUNDS`` of them, only sets of different components under a key are compared, the sets of a large
key block by block. Nothing is left out.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelloom.llm.components import components
from labelloom.llm.words import Hasher, chunks, mixed, shingle_sets
from labelloom.llm.work import documents, only, stored, tidy

SIMILARITY = 85
SHINGLE_WORDS = 3
PERMUTATIONS = 192
#: Permutations in a band, two values each, and in all bands; the sketches have values of all.
BAND = 3
BANDED = 96
#: Bits of each value in a sketch.
SKETCH_BITS = 4
#: Probability that the sketches of two sets that just are similar enough differ in too many values.
SKETCH_MISS = 1e-7
ROUNDS = 2
#: Sets under a key that meet in one task.
BLOCK_SETS = 2_000
#: Names of sets that a task remembers.
SEEN_SETS = 500_000

_SETS = (
    "row long, doc_id long, n_shingles long, digest binary, keys array<long>, sketch array<long>"
)


class MinMax:
    """Least and greatest hashes of sets under permutations of the 64-bit numbers."""

    def __init__(self, permutations: int = PERMUTATIONS, seed: int = 5) -> None:
        random = np.random.default_rng(seed)
        flips, factors = random.integers(0, 1 << 64, size=(2, permutations, 1), dtype=np.uint64)
        self.flips, self.factors = flips, factors | np.uint64(1)

    def __call__(self, shingles: np.ndarray) -> np.ndarray:
        """``(permutations, 2)``: the least and the greatest."""
        parts = []
        for k in range(0, len(shingles), 1024):
            hashes = (shingles[None, k : k + 1024] ^ self.flips) * self.factors
            parts.append((hashes.min(axis=1), hashes.max(axis=1)))
        least, greatest = zip(*parts, strict=True)
        return np.column_stack([np.minimum.reduce(least), np.maximum.reduce(greatest)])


def band_keys(values: np.ndarray, band: int = BAND) -> np.ndarray:
    """A key for each band; those of different bands differ, too."""
    values = values.reshape(len(values) // band, 2 * band)
    keys = np.arange(1, len(values) + 1, dtype=np.uint64)
    for k in range(values.shape[1]):
        keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + values[:, k])
    return keys


def sketch(values: np.ndarray, bits: int = SKETCH_BITS) -> np.ndarray:
    """Some bits of each value: the first ones of 64 values in a number each, then the second ones."""
    stirred = mixed(values.ravel())
    planes = [(stirred >> np.uint64(k)) & np.uint64(1) for k in range(bits)]
    return np.packbits(np.concatenate(planes).astype(np.uint8)).view(np.int64)


def most_differing(
    values: int, similarity: int, bits: int = SKETCH_BITS, miss: float = SKETCH_MISS
) -> int:
    """The number of values in which sketches of similar sets differ at most, but for ``miss``."""
    p, beyond, k = (1 - similarity / 100) * (1 - 0.5**bits), 1.0, -1
    while beyond > miss and k < values:
        k += 1
        beyond -= math.comb(values, k) * p**k * (1 - p) ** (values - k)
    return k


def digest_of(shingles: np.ndarray) -> bytes:
    """A name for the set that depends on all of it."""
    return hashlib.blake2b(shingles, digest_size=16).digest()


def sets_of(batches: Iterator[pa.RecordBatch], words: int):
    """``(doc ids, shingle sets)`` for pieces of the batches."""
    hasher = Hasher()
    for batch in batches:
        ids = batch.column(batch.schema.get_field_index("doc_id"))
        for a, b, data, offsets in chunks(batch):
            yield ids[a:b], shingle_sets(hasher, data, offsets, words)


def _signed(words: int, permutations: int, band: int, banded: int):
    """A row for each document; the first of a set in a task has the set's keys and sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sign, seen = MinMax(permutations), set()
        row = TaskContext.get().partitionId() << 36
        for ids, sets in sets_of(batches, words):
            digests, keys, sketches = [], [], []
            for s in sets:
                digests.append(digest_of(s) if len(s) else None)
                if len(s) and digests[-1] not in seen:
                    seen.add(digests[-1])
                    values = sign(s)
                    keys.append(band_keys(values[:banded], band).view(np.int64))
                    sketches.append(sketch(values))
                else:
                    keys.append(None)
                    sketches.append(None)
            if len(seen) > SEEN_SETS:
                seen.clear()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(row, row + len(sets))),
                    ids,
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(keys, pa.list_(pa.int64())),
                    pa.array(sketches, pa.list_(pa.int64())),
                ],
                ["row", "doc_id", "n_shingles", "digest", "keys", "sketch"],
            )
            row += len(sets)

    return tidy(run)


def _contents(words: int):
    """``(digest, shingles)`` of whole sets, each once in a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, sets in sets_of(batches, words):
            found = {digest_of(s): s.tobytes() for s in sets}
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.binary())],
                ["digest", "shingles"],
            )

    return tidy(run)


def _each_shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(node, component, shingle)`` from ``(node, component, shingles)``."""
    for batch in batches:
        sizes = pc.divide(pc.binary_length(batch.column("shingles")), 8).to_numpy()
        of = pa.array(np.repeat(np.arange(batch.num_rows), sizes))
        whole = b"".join(batch.column("shingles").to_pylist())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("node").take(of),
                batch.column("component").take(of),
                pa.array(np.frombuffer(whole, dtype=np.int64)),
            ],
            ["node", "component", "shingle"],
        )


def _confirmed(similarity: int):
    """The pairs whose full sets are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("shingles_a"), batch.column("shingles_b"), strict=True):
                x, y = (np.frombuffer(s.as_buffer(), dtype=np.uint64) for s in (x, y))
                both = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
                keep.append(100 * both >= similarity * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return tidy(run)


class Search:
    """Finds links among the distinct sets ``(node, n, digest, first, keys, ...)``, by sets that share
    a key. ``carried`` are columns of a set that decide whether two of them ``fits``."""

    carried: tuple[str, ...] = ()
    #: What is known of a set under one key.
    of_rows: tuple[str, ...] = ()
    #: Sets under a key up to which their shingles need not be counted; 0: those of all keys are, and
    #: before each further pivot.
    few = 0

    def __init__(self, docs: DataFrame, sets: DataFrame, words: int, similarity: int) -> None:
        self.docs, self.sets, self.words, self.similarity = docs, sets, words, similarity

    def under_keys(self) -> DataFrame:
        """The sets of each key that several have, ``(key, node, n, met, usable, component, done)`` and
        what is carried: ``met`` is larger for a better pivot, ``usable`` is how many shingles a set may
        share, ``done`` whether it has been compared with all others of the key."""
        raise NotImplementedError

    def fits(self) -> Column:
        """Whether what is known of ``a`` and ``b`` allows a link."""
        raise NotImplementedError

    def sizes_fit(self) -> Column:
        sizes = 100 * F.least("n_a", "n_b") >= self.similarity * F.greatest("n_a", "n_b")
        both = (100 + self.similarity) * F.least("usable_a", "usable_b")
        return sizes & (both >= self.similarity * (F.col("n_a") + F.col("n_b")))

    def with_both(self, pairs: DataFrame, about: DataFrame) -> DataFrame:
        """``pairs`` with the columns of ``about`` for ``a`` and for ``b``, side by side."""
        names = [c for c in about.columns if c != "node"]
        of = lambda x: about.select(
            F.col("node").alias(x), *(F.col(c).alias(f"{c}_{x}") for c in names)
        )
        joined = pairs.join(of("a"), "a").join(of("b"), "b")
        return joined.select("a", "b", *(f"{c}_{x}" for c in names for x in "ab"))

    def _names(self) -> list[str]:
        return ["node", "n", "usable", "component", *self.carried]

    def _side(self, rows: DataFrame, x: str, *more: str) -> DataFrame:
        return rows.select(*more, *(F.col(c).alias(f"{c}_{x}") for c in self._names()))

    def _pairs(self, joined: DataFrame) -> DataFrame:
        fit = joined.where((F.col("component_a") != F.col("component_b")) & self.fits())
        return fit.select(
            F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")
        ).distinct()

    def met(self, joined: DataFrame) -> DataFrame:
        """The pairs that may be links among the sets that meet."""
        return self._pairs(joined)

    def open_rows(self, rows: DataFrame) -> DataFrame:
        """The rows of keys whose sets that are not done are in several components."""
        several = (
            rows.where("NOT done")
            .groupBy("key")
            .agg(F.min("component").alias("low"), F.max("component").alias("high"))
            .where("low < high")
            .select("key")
        )
        return stored(rows.join(several, "key"), "open-members")

    def split(self, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The open rows of keys with few sets, and those of the other keys."""
        sizes = rows.where("NOT done").groupBy("key").agg(F.count("*").alias("size"))
        rows = stored(rows.where("NOT done").join(sizes, "key"), "open-by-size")
        parts = rows.where(F.col("size") <= self.few), rows.where(F.col("size") > self.few)
        return tuple(part.drop("size") for part in parts)

    def after(self, rows: DataFrame, pivots: DataFrame, found: DataFrame | None) -> DataFrame:
        """The rows still open after the comparison with ``pivots``."""
        past = pivots.select("key", F.col("p.node").alias("node"), F.lit(True).alias("past"))
        rows = rows.join(past, ["key", "node"], "left")
        rows = rows.withColumn("done", F.col("done") | F.coalesce("past", F.lit(False))).drop("past")
        if found is not None:
            found = found.select(F.col("node").alias("of"), F.col("component").alias("by_now"))
            rows = rows.join(found, rows["node"] == found["of"], "left")
            rows = rows.withColumn("component", F.coalesce("by_now", "component")).drop("of", "by_now")
        return self.open_rows(stored(rows, "placed-members"))

    def pruned(self, rows: DataFrame, contents: DataFrame) -> DataFrame:
        """The open rows of sets that can have a link to another component, by the shingles that open
        sets of different components share; ``contents`` has the shingles."""
        nodes = rows.where("NOT done").select("node", "component").distinct()
        each = nodes.join(contents, "node").mapInArrow(
            tidy(_each_shingle), "node long, component long, shingle long"
        )
        each = stored(each, "shingles-of-open")
        shared = (
            each.groupBy("shingle")
            .agg(F.min("component").alias("low"), F.max("component").alias("high"))
            .where("low < high")
            .select("shingle")
        )
        usable = each.join(shared, "shingle").groupBy(F.col("node").alias("of")).agg(F.count("*").alias("u"))
        usable = stored(usable, "usable-of-open")
        least = rows.where("NOT done").groupBy("key").agg(F.min("n").alias("least"))
        rows = rows.join(usable, rows["node"] == usable["of"], "left").join(least, "key")
        rows = rows.withColumn("usable", F.coalesce("u", F.lit(0))).drop("of", "u")
        # the smallest partner that a set can have under the key
        partner = F.greatest(F.ceil(F.col("n") * self.similarity / F.lit(100)), "least")
        enough = (100 + self.similarity) * F.col("usable") >= self.similarity * (F.col("n") + partner)
        return self.open_rows(stored(rows.where(F.col("done") | enough).drop("least"), "pruned-members"))

    def pivots(self, rows: DataFrame) -> DataFrame:
        """``(key, p)``: the set of each key that the others are compared with; one from outside the
        components of those before it."""
        order = F.struct("met", F.xxhash64("node"), *self._names())
        used = rows.where("done").select("key", "component").distinct()
        choice = rows.where("NOT done").join(used, ["key", "component"], "left_anti")
        return stored(choice.groupBy("key").agg(F.max(order).alias("p")), "pivots")

    def with_pivots(self, rows: DataFrame, pivots: DataFrame) -> DataFrame:
        """The pairs of each key's pivot and its other sets."""
        side = pivots.select("key", *(F.col("p")[c].alias(f"{c}_b") for c in self._names()))
        return self._pairs(self._side(rows.where("NOT done"), "a", "key").join(side, "key"))

    def across(self, rows: DataFrame) -> DataFrame:
        """The pairs under a key from different components. The sets of a large key are dealt into
        blocks, and each pair of blocks has a task to itself."""
        rows = rows.where("NOT done")
        sizes = rows.groupBy("key").agg(F.count("*").alias("left"))
        rows = rows.join(sizes, "key")
        blocks = F.ceil(F.col("left") / F.lit(BLOCK_SETS)).cast("int")
        rows = rows.withColumn("blocks", blocks).withColumn(
            "block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
        )
        rows = stored(rows, "blocks")
        each = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
        rows = rows.withColumn("other", each)
        low, high = F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")
        left = self._side(rows, "a", "key", low, high, F.col("block").alias("block_a"), *self.of_rows)
        right = self._side(rows, "b", "key", low, high, F.col("block").alias("block_b"))
        joined = left.join(right, ["key", "i", "j"])
        once = (F.col("i") == F.col("j")) & (F.col("node_a") < F.col("node_b"))
        once = once | ((F.col("block_a") == F.col("i")) & (F.col("block_b") == F.col("j")) & (F.col("i") < F.col("j")))
        return self.met(joined.where(once))

    def contents(self, nodes: DataFrame) -> DataFrame:
        """``(node, shingles)``: the full sets, made again from the texts."""
        wanted = stored(nodes.select("node").distinct(), "wanted")
        names = stored(
            only(self.sets.select("node", "first", "digest"), wanted, "node"), "wanted-names"
        )
        chosen = names.select(F.col("first").alias("doc_id")).distinct()
        made = only(self.docs, stored(chosen, "chosen")).mapInArrow(
            _contents(self.words), "digest binary, shingles binary"
        )
        # A repeated ``doc_id`` brings other sets and the same set again.
        made = made.groupBy("digest").agg(F.first("shingles").alias("shingles"))
        return stored(names.join(made, "digest").select("node", "shingles"), "contents")

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """The links among ``pairs``, by their full sets."""
        pairs = stored(pairs, "pairs")
        contents = self.contents(pairs.select(F.explode(F.array("a", "b")).alias("node")))
        both = self.with_both(pairs, contents)
        return stored(both.mapInArrow(_confirmed(self.similarity), "a long, b long"), "links")


class _Banded(Search):
    """The search with keys of bands, and with sketches."""

    def __init__(self, docs: DataFrame, sets: DataFrame, words: int, similarity: int, values: int):
        super().__init__(docs, sets, words, similarity)
        self.most, self.numbers = most_differing(values, similarity), values // 64
        self.carried = tuple(f"s{k}" for k in range(SKETCH_BITS * self.numbers))

    def under_keys(self) -> DataFrame:
        """``met`` is how many sets a set meets under its keys."""
        rows = self.sets.select(F.explode("keys").alias("key"), "node")
        sizes = rows.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
        rows = stored(rows.join(stored(sizes, "key-sizes"), "key"), "members")
        about = self.sets.select(
            F.col("node").alias("of"),
            "n",
            *(F.col("sketch")[k].alias(s) for k, s in enumerate(self.carried)),
        )
        met = rows.groupBy("node").agg(F.sum("size").alias("met"))
        met = stored(met.join(about, met["node"] == about["of"]).drop("of"), "met")
        rows = rows.drop("size").join(met, "node")
        rows = rows.withColumn("usable", F.col("n")).withColumn("component", F.col("node"))
        return stored(rows.withColumn("done", F.lit(False)), "members-met")

    def fits(self) -> Column:
        apart = []
        for k in range(self.numbers):
            planes = (f"s{k + j * self.numbers}" for j in range(SKETCH_BITS))
            differ = (F.col(f"{s}_a").bitwiseXOR(F.col(f"{s}_b")) for s in planes)
            apart.append(F.bit_count(reduce(Column.bitwiseOR, differ)))
        return self.sizes_fit() & (sum(apart, F.lit(0)) <= self.most)


def named_sets(rows: DataFrame, *about: str) -> tuple[DataFrame, DataFrame]:
    """Of documents ``(row, doc_id, n_shingles, digest, ...)``: ``(digest, node, first)``, a number and
    the smallest id of each set; and the sets ``(node, n, digest, first, ...)`` with what is told
    ``about`` them in the first row of a set in each task."""
    names = stored(
        rows.where("digest IS NOT NULL")
        .groupBy("digest")
        .agg(F.min("row").alias("node"), F.min("doc_id").alias("first")),
        "names",
    )
    # The first row of a set is the first of its task, too, so it is one that tells.
    firsts = only(
        rows.where(f"{about[0]} IS NOT NULL").select("row", "n_shingles", *about),
        names.select(F.col("node").alias("row")),
        "row",
    )
    firsts = firsts.select(F.col("row").alias("node"), F.col("n_shingles").alias("n"), *about)
    return names, stored(firsts.join(names, "node"), "distinct-sets")


def linked(search: Search, rounds: int) -> DataFrame | None:
    """``(node, component)`` of the sets that have links; none if none has."""
    members = search.under_keys()
    links = found = contents = None
    for turn in range(rounds + 1):
        if members.isEmpty():
            break
        if turn and not search.few:
            contents = search.contents(members.where("NOT done")) if contents is None else contents
            members = search.pruned(members, contents)
        if turn < rounds:
            pivots = search.pivots(members)
            pairs = search.with_pivots(members, pivots)
        elif not search.few:
            pairs = search.across(members)
        else:
            light, heavy = search.split(members)
            pairs = search.across(light)
            if not heavy.isEmpty():
                heavy = search.pruned(heavy, search.contents(heavy))
                pairs = pairs.union(search.across(heavy)).distinct()
        more = search.confirmed(pairs)
        if not more.isEmpty():
            links = more if links is None else links.union(more)
            found = stored(components(links), "components")
        if turn < rounds:
            members = search.after(members, pivots, found)
    return found


def lowest_ids(names: DataFrame, found: DataFrame | None) -> DataFrame:
    """``(digest, lowest)``: the smallest id of each set's component."""
    if found is None:
        return names.select("digest", F.col("first").alias("lowest"))
    found = found.withColumnRenamed("node", "of")
    placed = stored(
        names.join(found, names["node"] == found["of"], "left").select(
            "digest", "first", F.coalesce("component", "node").alias("component")
        ),
        "placed",
    )
    least = placed.groupBy("component").agg(F.min("first").alias("lowest"))
    return placed.join(least, "component").select("digest", "lowest")


def min_max_groups(
    docs: DataFrame,
    similarity: int = SIMILARITY,
    words: int = SHINGLE_WORDS,
    permutations: int = PERMUTATIONS,
    band: int = BAND,
    banded: int = BANDED,
    rounds: int = ROUNDS,
) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for every row of ``docs``: the smallest ``doc_id``
    that links lead to, a link being a Jaccard similarity of ``similarity`` percent or more.

    ``permutations`` is a multiple of 32, and ``banded`` of them, a multiple of ``band``, make the keys. A null text and one without words have no
    shingles and no links; with fewer than ``words`` words all of them are one shingle. Rows of equal
    sets are one group, whatever their ids. A null ``doc_id`` never names a group that has another; a
    row without one is kept if its group has none. Whole texts are read, very long ones in slices of
    their shingles. Other columns of ``docs`` do not matter. No input: no rows.
    """
    docs = documents(docs)
    rows = stored(docs.mapInArrow(_signed(words, permutations, band, banded), _SETS), "signed")
    names, firsts = named_sets(rows, "keys", "sketch")
    search = _Banded(docs, firsts, words, similarity, 2 * permutations)
    lowest = lowest_ids(names, linked(search, rounds))
    component = F.coalesce("lowest", "doc_id")
    kept = F.coalesce(F.col("doc_id") == component, component.isNull())
    return rows.select("doc_id", "n_shingles", "digest").join(lowest, "digest", "left").select(
        "doc_id", "n_shingles", component.alias("component_id"), kept.alias("kept")
    )
