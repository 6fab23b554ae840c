"""Removal of passages that occur earlier in the corpus, byte by byte.

A byte goes if a ``SPAN``-byte string that covers it also starts earlier: in a document with a smaller
``doc_id``, or before it in the same one. Strings are judged on the input.

1. Anchors. Each string has the ``GRAM``-byte gram with the smallest hash in it as its anchor, so equal
   strings have equal anchors at the same place in them. The strings of one anchor are consecutive;
   they form a region of less than two spans. A text has an anchor about every ``(SPAN - GRAM) / 2``
   bytes, and those whose gram occurs once in the corpus need nothing more.
2. Equal regions. All but the first of the corpus are repeats as a whole. A block of documents sends
   each of its regions once and already knows the later ones as repeats, so a passage that everybody
   has is one row for each block.
3. Different regions of one gram share strings or not. Their first occurrences are fetched, cut to
   what can be shared by comparing them outwards from the anchor; of those that are then equal the
   earliest stays. They are put into one text for a number of grams, in which a longest run of bytes
   that the same pieces agree in is one symbol, and its suffixes are sorted (``suffixes``). Suffixes
   that agree in the symbols of a string are then neighbours; of each such group all strings but the
   earliest are repeats. A gram with more than ``GROUP_REGIONS`` regions is dealt by its strings
   instead, each of which then is a region for itself.
4. The repeats come together by document, where they are merged and cut out.

A null text is empty. Rows that repeat a ``doc_id`` and its text are one document and are cut alike;
rows of one ``doc_id``, or without one, with different texts are different documents, in the order of the
SHA-256 of their texts. Null ids come last. A very long text is a chunk of its own. No input: no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.llm.suffixes import suffix_array
from labelloom.llm.words import _FACTOR, _INVERSE, _powers, chunks, mixed
from labelloom.llm.work import documents, only, stored, tidy

SPAN = 100
GRAM = 24
GROUP_REGIONS = 1 << 14
#: Bytes of text whose anchors are found at a time: few enough that what is made of them stays near.
CHUNK_BYTES = 128 << 10
#: Anchors of a block of documents, and symbols of regions sorted at a time.
BLOCK_ANCHORS = 1 << 20
SORT_SYMBOLS = 1 << 16
LATER_ROWS = 20_000

_LAST = (1 << 63) - 1
_PLACE = "gram long, region long, doc long, start long, length int, offset int"


def _sliding(x: np.ndarray, width: int, pick, fill) -> np.ndarray:
    """``pick`` over every ``width`` neighbours, by running picks from both ends of blocks."""
    n = len(x) - width + 1
    padded = np.full(-(-len(x) // width) * width, fill, dtype=x.dtype)
    padded[: len(x)] = x
    blocks = padded.reshape(-1, width)
    forward = pick.accumulate(blocks, axis=1).ravel()
    backward = pick.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return pick(backward[:n], forward[width - 1 : width - 1 + n])


class Anchors:
    """Finds the anchors and regions of texts."""

    def __init__(self, span: int, gram: int) -> None:
        self.span, self.gram, self.width = span, gram, span - gram + 1
        self._letters = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_FACTOR))
        self._up = self._down = np.ones(1, dtype=np.uint64)

    def _places(self, data: np.ndarray, offsets: np.ndarray):
        """The anchors' places, all grams, sums of the bytes before, and of each string the least gram."""
        n, width = len(data), self.width
        if len(self._up) <= n:
            self._up, self._down = _powers(_FACTOR, n), _powers(_INVERSE, n)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(self._letters[data] * self._up[:n], out=sums[1:])
        grams = mixed((sums[self.gram :] - sums[: -self.gram]) * self._down[: n - self.gram + 1])
        grams |= np.uint64(1)  # 0 is below all
        least = _sliding(grams, width, np.minimum, np.uint64(_LAST * 2 + 1))
        # Strings that would cross into another document are none.
        ends = np.repeat(offsets[1:], np.diff(offsets))[: len(least)]
        least[np.arange(len(least)) + self.span > ends] = 0
        around = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
        most = _sliding(around, width, np.maximum, np.uint64(0))
        return np.flatnonzero(most == grams), grams, sums, around

    def grams(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The grams of the anchors alone."""
        if len(data) < self.span:
            return np.zeros(0, dtype=np.uint64)
        at, grams, *_ = self._places(data, offsets)
        return grams[at]

    def __call__(self, data: np.ndarray, offsets: np.ndarray):
        """``(gram, region, document, start, length, offset)``: hashes, and where in the document the
        region starts, how long it is and where in it the anchor is."""
        width = self.width
        if len(data) < self.span:
            return (np.zeros(0, dtype=np.uint64),) * 2 + (np.zeros(0, dtype=np.int64),) * 4
        at, grams, sums, around = self._places(data, offsets)
        # The strings of an anchor: those that cover it and have it as the least.
        view = np.lib.stride_tricks.sliding_window_view(around, width)
        first, last = np.empty_like(at), np.empty_like(at)
        for a in range(0, len(at), 1 << 15):  # a text of few signs has very many anchors
            some = at[a : a + (1 << 15)]
            mine = view[some] == grams[some, None]
            first[a : a + len(some)] = some - width + 1 + mine.argmax(axis=1)
            last[a : a + len(some)] = some - mine[:, ::-1].argmax(axis=1)
        stop = last + self.span
        region = (sums[stop] - sums[first]) * self._down[first]
        region = mixed(region + mixed(((stop - first) * 4096 + (at - first)).astype(np.uint64)))
        document = np.searchsorted(offsets, at, side="right") - 1
        return grams[at], region, document, first - offsets[document], stop - first, at - first


def _grams(span: int, gram: int):
    """``(part, n)``: how often a task has the grams with this half of the hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, held, size = Anchors(span, gram), [], 0

        def counted() -> pa.RecordBatch:
            part, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(part), pa.array(np.minimum(n, 2).astype(np.int32))], ["part", "n"]
            )

        for batch in batches:
            for _, _, data, offsets in chunks(batch, CHUNK_BYTES):
                held.append(_half(find.grams(data, offsets)))
                size += len(held[-1])
            if size >= BLOCK_ANCHORS:
                yield counted()
                held, size = [], 0
        if held:
            yield counted()

    return tidy(run)


def _half(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _regions(span: int, gram: int):
    """The regions of a task; ``known`` are those that have an equal one earlier in its block."""

    def rows(held: list[tuple]) -> pa.RecordBatch:
        grams, regions, docs, start, length, offset = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.lexsort((start, docs, regions, grams))
        grams, regions = grams[order], regions[order]
        known = np.zeros(len(order), dtype=bool)
        known[1:] = (grams[1:] == grams[:-1]) & (regions[1:] == regions[:-1])
        # A document that is there twice is no repeat of itself.
        same = np.zeros(len(order), dtype=bool)
        same[1:] = (np.diff(docs[order]) == 0) & (np.diff(start[order]) == 0)
        known &= ~same
        keep = ~(same & (grams == np.roll(grams, 1)) & (regions == np.roll(regions, 1)))
        columns = [
            pa.array(_half(grams)),
            pa.array(grams.view(np.int64)),
            pa.array(regions.view(np.int64)),
            pa.array(docs[order]),
            # One number for the place, as these rows are many.
            pa.array((start[order] << 20) | (length[order] << 10) | offset[order]),
            pa.array(known),
        ]
        names = ["part", "gram", "region", "doc", "place", "known"]
        return pa.RecordBatch.from_arrays(columns, names).filter(pa.array(keep))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, held, size = Anchors(span, gram), [], 0
        for batch in batches:
            docs = batch.column(0).to_numpy()
            for a, b, data, offsets in chunks(batch, CHUNK_BYTES):
                grams, regions, document, *rest = find(data, offsets)
                held.append((grams, regions, docs[a:b][document], *rest))
                size += len(grams)
            if size >= BLOCK_ANCHORS:
                yield rows(held)
                held, size = [], 0
        if held:
            yield rows(held)

    return tidy(run)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index("text")).cast(pa.binary())
        packed = pa.array([pack(t.as_py()) for t in texts], pa.binary())
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], packed], [*batch.schema.names[:-1], "packed"])


def _fetched(span: int):
    """Of documents with ``wanted`` regions, ``(gram, doc, start, offset, content)`` of each; of those of
    large groups each string, with a hash of it for its gram."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            rows = []
            for doc, packed, wanted in zip(*(c for c in batch.columns), strict=True):
                text = unpack(packed.as_py())
                for x in wanted.as_py():
                    start, length = x["start"], x["length"]
                    if not x["large"]:
                        rows.append((x["gram"], doc.as_py(), start, x["offset"], text[start : start + length], False))
                        continue
                    for k in range(start, start + length - span + 1):
                        content = text[k : k + span]
                        name = hashlib.blake2b(content, digest_size=8).digest()
                        name = int.from_bytes(name, "little", signed=True)
                        rows.append((name, doc.as_py(), k, 0, content, True))
                if len(rows) > 20_000:
                    yield _fetched_batch(rows)
                    rows = []
            yield _fetched_batch(rows)

    return tidy(run)


def _fetched_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * 6
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.bool_())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
        ["gram", "doc", "start", "offset", "content", "string"],
    )


def _common(a: bytes, b: bytes) -> int:
    """How many first bytes agree."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    x = np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)
    return int(x.argmax())


def shareable(group: list[tuple], span: int) -> list[tuple]:
    """``(doc, start, content, offset)`` of a gram's regions ``(doc, start, offset, content)``, each cut to
    what agrees, outwards from the anchor, with some other; none if that is shorter than a span."""
    left, right = [0] * len(group), [0] * len(group)
    for side, most in ((0, left), (1, right)):
        parts = [x[3][x[2] :] if side else x[3][: x[2]][::-1] for x in group]
        order = sorted(range(len(group)), key=parts.__getitem__)
        for i, j in zip(order, order[1:], strict=False):
            n = _common(parts[i], parts[j])
            most[i], most[j] = max(most[i], n), max(most[j], n)
    out = []
    for (doc, start, offset, content), a, b in zip(group, left, right, strict=True):
        if a + b >= span:
            out.append((doc, start + offset - a, content[offset - a : offset + b], a))
    return out


def distinct(pieces: list[tuple]) -> tuple[list[tuple], list[tuple]]:
    """The earliest of equal pieces with the anchor at one place, and ``(doc, first, stop)`` of the
    others."""
    first: dict[tuple, tuple] = {}
    later = []
    for piece in sorted(pieces, key=lambda x: x[:2]):
        if first.setdefault(piece[2:], piece)[:2] != piece[:2]:
            later.append((piece[0], piece[1], piece[1] + len(piece[2])))
    return list(first.values()), later


def tree(parts: list[bytes]) -> tuple[list[int], list[int], list[int]]:
    """``(depth, up, leaf)`` of the tree in which parts go together as far as they agree: how long what
    leads to a node is, the node above it (the first node is the root), and where each part ends."""
    depth, up, path, leaf, before = [0], [-1], [0], [0] * len(parts), b""
    for i in sorted(range(len(parts)), key=parts.__getitem__):
        n, last = _common(before, parts[i]), -1
        while depth[path[-1]] > n:
            last = path.pop()
        for size in (n, len(parts[i])):
            if depth[path[-1]] < size:
                if size == n:
                    up[last] = len(depth)
                up.append(path[-1])
                path.append(len(depth))
                depth.append(size)
        leaf[i], before = path[-1], parts[i]
    return depth, up, leaf


class Runs:
    """Pieces of a number of grams as one text whose suffixes are sorted. A symbol is a longest run of
    bytes, on one side of the anchor, in which the same pieces of a gram agree; so pieces share a string
    just if they share the symbols it touches."""

    def __init__(self, span: int) -> None:
        self.span, self.text, self.symbols, self.rows = span, [], 0, []

    def add(self, pieces: list[tuple]) -> None:
        """Pieces ``(doc, start, content, offset)`` of a gram."""
        left, above, outer = tree([x[2][: x[3]][::-1] for x in pieces])
        right, below, inner = tree([x[2][x[3] :] for x in pieces])
        centre = self.symbols
        rights = centre + len(left) - 1
        self.symbols = rights + len(right)
        for (doc, start, _, offset), v, w in zip(pieces, outer, inner, strict=True):
            before, after = [v], []
            while v:
                v = above[v]
                before.append(v)
            while w:
                after.append(w)
                w = below[w]
            after.reverse()
            at, k, a, q = len(self.text), 0, left[before[0]], 0
            self.text += [centre + v for v in before]
            self.text += [rights + w for w in after]
            while a >= 0:
                while q < len(after) and right[after[q]] < self.span - a:
                    q += 1
                if q == len(after):
                    break
                end = left[before[k + 1]] + 1 if before[k] else 0
                low = max(end, self.span - right[after[q]])
                first = start + offset - a
                self.rows.append((at + k, len(before) - k + q + 1, doc, first, first + a - low + self.span))
                a = low - 1
                k += low == end

    def later(self) -> list[tuple]:
        """``(doc, first, stop)``: the bytes of the pieces covered by strings that start earlier in
        another piece."""
        if not self.rows:
            return []
        at, size, doc, first, stop = np.array(self.rows, dtype=np.int64).T
        order = np.array(suffix_array(self.text), dtype=np.int64)
        text = np.append(np.array(self.text, dtype=np.int64), -1)
        agree = np.zeros(len(order), dtype=np.int64)  # symbols shared with the suffix before
        alive = np.arange(1, len(order))
        for k in range(int(size.max())):
            x, y = order[alive] + k, order[alive - 1] + k
            alive = alive[(np.maximum(x, y) < len(order)) & (text[np.minimum(x, len(order))] == text[np.minimum(y, len(order))])]
            agree[alive] += 1
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        kind = np.empty_like(at)
        for k in np.unique(size):
            own = size == k
            kind[own] = np.cumsum(agree < k)[rank[at[own]]]
        by = np.lexsort((first, doc, kind, size))
        doc, first, stop = doc[by], first[by], stop[by]
        head = np.ones(len(by), dtype=bool)
        head[1:] = (np.diff(kind[by]) != 0) | (np.diff(size[by]) != 0)
        least = np.flatnonzero(head)[np.cumsum(head) - 1]
        again = (doc != doc[least]) | (first != first[least])  # two anchors may have the same piece
        doc, first, stop = doc[again], first[again], stop[again]
        if not len(doc):
            return []
        by = np.lexsort((first, doc))
        doc, first, stop = doc[by], first[by], stop[by]
        # Where each run of a document starts beyond all before it.
        text_of = np.cumsum(np.diff(doc, prepend=doc[0]) != 0) * (int(stop.max()) + 1)
        so_far = np.maximum.accumulate(stop + text_of)
        breaks = np.flatnonzero((first + text_of)[1:] > so_far[:-1]) + 1
        cuts = np.concatenate([[0], breaks])
        lasts = np.concatenate([breaks, [len(doc)]]) - 1
        ends = so_far[lasts] - text_of[lasts]
        return list(zip(doc[cuts].tolist(), first[cuts].tolist(), ends.tolist(), strict=True))


def _resolved(span: int):
    """Rows sorted by gram: the repeats among the regions of each."""

    def batch_of(runs: Runs, later: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*later, *runs.later(), strict=True)) or [[]] * 3
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc", "first", "stop"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram, group, runs, later = None, [], Runs(span), []

        def settle() -> None:
            own, same = distinct(shareable(group, span))
            later.extend(same)
            if len(own) > 1:
                runs.add(own)

        for batch in batches:
            for g, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if g != gram:
                    settle()
                    gram, group = g, []
                    if len(runs.text) >= SORT_SYMBOLS or len(later) >= LATER_ROWS:
                        yield batch_of(runs, later)
                        runs, later = Runs(span), []
                group.append(tuple(row))
        settle()
        yield batch_of(runs, later)

    return tidy(run)


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        out = []
        for packed, cuts in zip(batch.column("packed"), batch.column("cuts").to_pylist(), strict=True):
            text = unpack(packed.as_py())
            kept, at, spans = [], 0, []
            for x in sorted((c["first"], min(c["stop"], len(text))) for c in cuts or ()):
                if spans and x[0] <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], x[1])
                elif x[0] < x[1]:
                    spans.append(list(x))
            for first, stop in spans:
                kept.append(text[at:first])
                at = stop
            kept = b"".join([*kept, text[at:]])
            out.append(
                (len(text), len(text) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), kept)
            )
        columns = list(zip(*out, strict=True)) or [[]] * 5
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
        )


def numbered(docs: DataFrame) -> DataFrame:
    """``docs``, ``(doc_id, text)``, with a number ``doc`` for each different row, in their order.

    That is the ``doc_id`` where each has one text, which one pass over the digests tells. Else the
    different rows are sorted over the cluster and numbered by their places.
    """
    digest = F.sha2(F.col("text").cast("binary"), 256)
    marked = docs.select("doc_id", digest.alias("digest"))
    odd = (
        marked.groupBy("doc_id")
        .agg(F.min("digest").alias("low"), F.max("digest").alias("high"))
        .where("low <> high OR doc_id IS NULL")
    )
    if odd.isEmpty():
        return docs.select(F.col("doc_id").alias("doc"), "doc_id", "text")
    place = F.monotonically_increasing_id()  # the partition above 33 bits, and the place in it
    placed = stored(
        marked.distinct().orderBy(F.asc_nulls_last("doc_id"), "digest").withColumn("place", place), "order"
    )
    part = F.shiftright("place", 33)
    sizes = sorted(map(tuple, placed.groupBy(part.alias("part")).count().collect()))
    before = dict(zip((p for p, _ in sizes), np.cumsum([0, *(n for _, n in sizes)]).tolist(), strict=False))
    shift = F.create_map(*(F.lit(x) for pair in before.items() for x in pair))
    numbers = placed.select(
        F.col("doc_id").alias("own"),
        "digest",
        (shift[part] + F.col("place").bitwiseAND(F.lit((1 << 33) - 1))).alias("doc"),
    )
    marked = docs.withColumn("digest", digest)
    same = marked["doc_id"].eqNullSafe(numbers["own"]) & (marked["digest"] == numbers["digest"])
    return marked.join(numbers, same).select("doc", "doc_id", "text")


def without_repeats(
    docs: DataFrame, span: int = SPAN, gram: int = GRAM, group_regions: int = GROUP_REGIONS
) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept)`` for every row of ``docs``: the
    remaining bytes, which may cut a character, and how many maximal runs went."""
    docs = numbered(documents(docs))
    texts = docs.select("doc", "text")
    counts = texts.mapInArrow(_grams(span, gram), "part int, n int")
    repeated = counts.groupBy("part").agg(F.sum("n").alias("n")).where("n > 1").select("part")
    found = texts.mapInArrow(
        _regions(span, gram), "part int, gram long, region long, doc long, place long, known boolean"
    )
    shared = stored(found.join(repeated, "part").drop("part"), "regions")
    place = F.struct("doc", "place")
    firsts = stored(
        shared.where("NOT known").groupBy("gram", "region").agg(F.min(place).alias("at")), "firsts"
    )
    in_all = shared.where("NOT known").join(firsts, ["gram", "region"])
    start, length = F.shiftright("place", 20), F.shiftright("place", 10).bitwiseAND(F.lit(1023))
    cut = lambda df: df.select("doc", start.alias("first"), (start + length).alias("stop"))
    later = cut(in_all.where(place != F.col("at"))).union(cut(shared.where("known")))

    sizes = firsts.groupBy("gram").agg(F.count("*").alias("regions")).where("regions > 1")
    wanted = (
        firsts.join(sizes, "gram")
        .select("gram", "regions", "at.doc", "at.place")
        .select(
            F.col("doc").alias("of"),
            F.struct(
                "gram",
                start.alias("start"),
                length.alias("length"),
                F.col("place").bitwiseAND(F.lit(1023)).alias("offset"),
                (F.col("regions") > group_regions).alias("large"),
            ).alias("x"),
        )
        .groupBy("of")
        .agg(F.collect_list("x").alias("wanted"))
    )
    wanted = stored(wanted, "wanted")
    some = only(texts, wanted.select(F.col("of").alias("doc")), "doc").dropDuplicates(["doc"])
    some = some.mapInArrow(tidy(_pack), "doc long, packed binary")
    fetched = stored(
        some.join(wanted, some["doc"] == wanted["of"])
        .select("doc", "packed", "wanted")
        .mapInArrow(
            _fetched(span),
            "gram long, doc long, start long, offset int, content binary, string boolean",
        ),
        "fetched",
    )
    # Equal strings of large groups: the first in the corpus and the later ones.
    strings = fetched.where("string").select("gram", "content", "doc", "start")
    at = F.struct("doc", "start")
    first_of = stored(
        strings.groupBy("gram", "content").agg(F.min(at).alias("at"), F.count("*").alias("n"))
        .where("n > 1")
        .select("gram", F.col("content").alias("same"), "at"),
        "strings",
    )
    later_in_large = (
        strings.join(first_of, "gram")
        .where((F.col("content") == F.col("same")) & (at != F.col("at")))
        .select("doc", F.col("start").alias("first"), (F.col("start") + span).alias("stop"))
    )
    resolved = (
        fetched.where("NOT string")
        .select("gram", "doc", "start", "offset", "content")
        .repartition("gram")
        .sortWithinPartitions("gram")
        .mapInArrow(_resolved(span), "doc long, first long, stop long")
    )
    cuts = (
        later.union(later_in_large)
        .union(resolved)
        .groupBy(F.col("doc").alias("of"))
        .agg(F.collect_list(F.struct("first", "stop")).alias("cuts"))
    )
    packed = docs.mapInArrow(tidy(_pack), "doc long, doc_id long, packed binary")
    return (
        packed.join(cuts, packed["doc"] == cuts["of"], "left")
        .select("doc_id", "packed", "cuts")
        .mapInArrow(
            tidy(_kept),
            "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary",
        )
    )
