"""Alignment of the tokens that two tokenizers make of the same texts.

A byte-level BPE (``A``) and a sentence-piece BPE (``B``) cut the same bytes. Every token points to
its farthest-right overlapping token of the other side, or to itself where both sides end: such a
token is the last of its group. Pointer jumping replaces each token's successor by its successor's,
for all tokens of a chunk of documents at once, until nothing changes: after as many rounds as the
logarithm of the longest chain each token points to the last one of its group, which names it.

What the corpus knows of a pair of ids is the number of documents that link it. One scan aligns the
texts and writes three tables: the documents, the distinct pairs of each with how often (packed, a row
a chunk), and each task's counts of pairs. The counts are summed, and the highest for each id of ``A``
(as many rows as it has ids) is sent to all tasks. The counts then go back to the documents: those of
the most frequent pairs, ``COMMON_PAIRS`` at most, are sent to all tasks, the other pairs meet theirs
in a join. Such pairs are rare ones, and what was found already is spread by document, so no key has
many rows. How many pairs are sent decides the speed, never the result.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.llm.work import documents, stored

#: Pairs whose counts are sent to every task, 12 bytes each.
COMMON_PAIRS = 3_000_000
#: Characters of text handled at a time; a longer text is a chunk of its own.
CHUNK_CHARS = 600_000
#: Pairs that a task holds while it counts.
HELD_PAIRS = 2_000_000
#: Ids of either side are below ``1 << ID_BITS``, rows of a chunk below ``1 << (64 - 2 * ID_BITS)``.
ID_BITS = 24

_SHIFT, _MASK = np.uint64(ID_BITS), np.uint64((1 << ID_BITS) - 1)
_BYTE_LEVEL_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)

_FIELDS = {
    "kind": pa.int32(),
    "row": pa.int64(),
    "doc_id": pa.int64(),
    "n_a": pa.int64(),
    "n_b": pa.int64(),
    "n_groups": pa.int64(),
    "n_links": pa.int64(),
    "groups_sha256": pa.string(),
    "rows": pa.binary(),
    "sizes": pa.binary(),
    "pairs": pa.binary(),
    "times": pa.binary(),
    "pair": pa.int64(),
    "n": pa.int64(),
}
_SCHEMA = (
    "kind int, row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
    "groups_sha256 string, rows binary, sizes binary, pairs binary, times binary, pair long, n long"
)


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable characters of
    Latin-1 for themselves, those from 256 on for the other bytes in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class ByteLevel:
    """Side ``A``: a byte-level BPE given as JSON of the ``tokenizers`` library.

    Where its ids are in the order of its merges and nothing else is set, ``tiktoken`` gives the same
    ids several times as fast and is used; else the library itself is.
    """

    def __init__(self, tokenizer: str) -> None:
        told = json.loads(tokenizer)
        alphabet, model = byte_alphabet(), told["model"]
        special = {t["content"] for t in told["added_tokens"]}
        self.pieces = [b""] * (1 + max(model["vocab"].values()))
        for piece, k in model["vocab"].items():
            self.pieces[k] = (
                piece.encode() if piece in special else bytes(alphabet[c] for c in piece)
            )
        merged = [m if isinstance(m, str) else " ".join(m) for m in model["merges"]]
        ids = [model["vocab"][m.replace(" ", "")] for m in merged]
        before = told["pre_tokenizer"] or {}
        plain = before.get("type") == "ByteLevel" and before.get("use_regex", True)
        plain = plain and not before["add_prefix_space"] and not told["normalizer"]
        odd = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix")
        plain = plain and not any(model.get(k) for k in (*odd, "ignore_merges"))
        if plain and all(a < b for a, b in zip(ids, ids[1:], strict=False)):
            import tiktoken

            ranks = {p: k for k, p in enumerate(self.pieces) if p and p.decode("utf-8", "replace") not in special}
            coder = tiktoken.Encoding(
                "plain", pat_str=_BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={}
            )
            self.encode = coder.encode_to_numpy
        else:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            coder = Tokenizer.from_str(tokenizer)
            coder.encode_special_tokens = True
            coder.no_truncation()
            coder.no_padding()
            self.encode = lambda text: np.array(coder.encode(text, add_special_tokens=False).ids)


class SentencePiece:
    """Side ``B``: a sentence-piece model, given as its bytes."""

    def __init__(self, model: bytes) -> None:
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.pieces = []
        for k in range(self._model.get_piece_size()):
            piece = self._model.id_to_piece(k)
            if self._model.is_byte(k):
                self.pieces.append(bytes([int(piece[3:5], 16)]))
            else:
                self.pieces.append(piece.replace("▁", " ").encode())

    def encode(self, text: str) -> np.ndarray:
        return np.array(self._model.encode(text, num_threads=1), dtype=np.int64)


def last_tokens(a_ends: np.ndarray, b_ends: np.ndarray) -> np.ndarray:
    """For each token of ``A``, then of ``B``, the last token of its group, as its place in ``B``.

    Tokens are given by where they end, in order; both sides end with the same byte.
    """
    n, m = len(a_ends), len(b_ends)
    if not n:
        return np.zeros(0, dtype=np.int64)
    # How many tokens of a side end before a byte is the place of the token that covers it.
    to_b = np.zeros(int(a_ends[-1]) + 1, dtype=np.int32)
    to_a = to_b.copy()
    to_b[b_ends] = 1
    to_a[a_ends] = 1
    np.cumsum(to_b, out=to_b)
    np.cumsum(to_a, out=to_a)
    after = to_a[b_ends - 1].astype(np.int64)
    successor = np.concatenate([n + to_b[a_ends - 1].astype(np.int64), after])
    both = a_ends[after] == b_ends
    successor[n:][both] = n + np.flatnonzero(both)
    while True:
        further = successor[successor]
        if np.array_equal(further, successor):
            return successor - n
        successor = further


def links_of(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places in ``A`` and in ``B`` of the tokens of each overlapping pair: two tokens overlap in
    one stretch of bytes, and it ends where either side has a token's end."""
    ends = np.union1d(a_ends, b_ends)
    return np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends)


class Aligner:
    """Aligns many texts at once."""

    def __init__(self, a: ByteLevel, b: SentencePiece) -> None:
        self.a, self.b = a, b
        self.lengths = [np.array([len(p) for p in side.pieces], dtype=np.int64) for side in (a, b)]
        numbers = lambda side, sign: np.array(
            [f"{k}{sign}" for k in range(len(side.pieces))], dtype=object
        )
        self.within = [numbers(side, ",") for side in (a, b)]
        self.closing = [numbers(a, "|"), numbers(b, ";")]

    def _tokens(self, texts: list[str]) -> tuple[list, np.ndarray]:
        """The ids of both sides for each text whose bytes both give back, else none; which do."""
        sides = [[self.a.encode(" " + t) for t in texts], [self.b.encode(t) for t in texts]]
        whole = [b" " + t.encode() for t in texts]
        good = np.array([bool(t) for t in texts])
        for side, ids, lengths in zip((self.a, self.b), sides, self.lengths, strict=True):
            n = np.array([lengths[x].sum() for x in ids], dtype=np.int64)
            good &= n == np.array([len(w) for w in whole])
            piece = side.pieces.__getitem__
            for k in np.flatnonzero(good):
                good[k] = b"".join(map(piece, ids[k].tolist())) == whole[k]
        none = np.zeros(0, dtype=np.int64)
        return [[x if g else none for x, g in zip(ids, good, strict=True)] for ids in sides], good

    def __call__(self, texts: list[str]):
        """``(numbers of tokens of A, of B, of groups, of links, groups written out, places and pairs
        of the links)``; the first five by text, the last two by link."""
        sides, _ = self._tokens(texts)
        counts = [np.array([len(x) for x in ids], dtype=np.int64) for ids in sides]
        ids = [np.concatenate([*x, np.zeros(0, dtype=np.int64)]).astype(np.int64) for x in sides]
        ends = [np.cumsum(lengths[x]) for lengths, x in zip(self.lengths, ids, strict=True)]
        n = len(ids[0])
        last = last_tokens(*ends)
        closes = np.zeros(len(ids[1]), dtype=bool)
        closes[last] = True
        number = np.cumsum(closes) - 1  # of the groups
        groups = [number[last[:n]], number[last[n:]]]
        n_groups = int(number[-1]) + 1 if len(number) else 0
        # In the written form a group's tokens of A come first, then those of B.
        sizes = [np.bincount(g, minlength=n_groups) for g in groups]
        up_to = [np.concatenate([[0], np.cumsum(s)]) for s in sizes]
        out = np.empty(len(ids[0]) + len(ids[1]), dtype=object)
        for k in (0, 1):
            strings = self.within[k][ids[k]]
            ending = up_to[k][1:] - 1
            strings[ending] = self.closing[k][ids[k][ending]]
            out[np.arange(len(ids[k])) + up_to[1 - k][groups[k] + k]] = strings
        begin = np.concatenate([[0], np.cumsum(counts[0] + counts[1])])
        written = ["".join(out[s:e].tolist())[:-1] for s, e in zip(begin[:-1], begin[1:], strict=True)]
        a_of, b_of = links_of(*ends)
        text_of = np.repeat(np.arange(len(texts)), counts[0])[a_of]
        pairs = (ids[0][a_of].astype(np.uint64) << _SHIFT) | ids[1][b_of].astype(np.uint64)
        in_text = np.repeat(np.arange(len(texts)), counts[1])[closes]
        by_text = lambda x: np.bincount(x, minlength=len(texts))
        return *counts, by_text(in_text), by_text(text_of), written, text_of, pairs


def _record(size: int, /, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(columns[name], kind) if name in columns else pa.nulls(size, kind)
            for name, kind in _FIELDS.items()
        ],
        list(_FIELDS),
    )


def _pack(x: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(x).tobytes())


def _unpack(x: pa.Scalar, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(x.as_py()), dtype=kind)


class _Counts:
    """How many documents of a task have a pair."""

    def __init__(self, most: int) -> None:
        self.most, self.new, self.size = most, [], 0
        self.pairs, self.n = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)

    def add(self, pairs: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.new.append(pairs)
        self.size += len(pairs)
        if self.size >= self.most:
            self._merge()
            if len(self.pairs) >= self.most // 2:
                yield from self.rest()

    def _merge(self) -> None:
        if not self.new:
            return
        pairs, n = np.unique(np.concatenate(self.new), return_counts=True)
        self.new, self.size = [], 0
        pairs, n = np.concatenate([self.pairs, pairs]), np.concatenate([self.n, n])
        order = np.argsort(pairs, kind="stable")
        pairs, n = pairs[order], n[order]
        first = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]]))
        self.pairs, self.n = pairs[first], np.add.reduceat(n, first)

    def rest(self) -> Iterator[pa.RecordBatch]:
        self._merge()
        for k in range(0, len(self.pairs), 100_000):
            pairs, n = self.pairs[k : k + 100_000], self.n[k : k + 100_000]
            kind = np.full(len(n), 2, dtype=np.int32)
            yield _record(len(n), kind=kind, pair=pairs.view(np.int64), n=n)
        self.pairs, self.n = self.pairs[:0], self.n[:0]


def _packed_deltas(pairs: np.ndarray) -> bytes:
    """Pairs as differences of the first ids, and the second ids, each in four bytes."""
    first = (pairs >> _SHIFT).astype(np.int64)
    return _pack(
        np.concatenate([np.diff(first, prepend=0), (pairs & _MASK).astype(np.int64)]).astype(np.int32)
    )


def _unpacked_pairs(packed: pa.Scalar) -> np.ndarray:
    both = _unpack(packed, np.int32).astype(np.int64)
    n = len(both) // 2
    return (np.cumsum(both[:n]) << ID_BITS) | both[n:]


def _aligned(a, b, chunk_chars: int, held: int):
    """Rows of kind 0 (documents), 1 (the pairs of a chunk's documents) and 2 (counts of pairs)."""

    def chunks(batch: pa.RecordBatch) -> Iterator[tuple[list, list[str]]]:
        ids, texts, size = [], [], 0
        for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
            text = text.as_py()
            if texts and size + len(text) > chunk_chars or len(texts) >= 30_000:
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(doc_id.as_py())
            texts.append(text)
            size += len(text)
        if texts:
            yield ids, texts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align = Aligner(ByteLevel(a.value), SentencePiece(b.value))
        counts, row = _Counts(held), TaskContext.get().partitionId() << 36
        for batch in batches:
            for ids, texts in chunks(batch):
                m = len(texts)
                n_a, n_b, n_groups, n_links, written, text_of, pairs = align(texts)
                digests = [hashlib.sha256(w.encode()).hexdigest() if w else "" for w in written]
                rows = np.arange(row, row + m)
                row += m
                yield _record(
                    m, kind=np.zeros(m, dtype=np.int32), row=rows, doc_id=ids, n_a=n_a, n_b=n_b,
                    n_groups=n_groups, n_links=n_links, groups_sha256=digests,
                )
                if not len(pairs):
                    continue
                entries = np.sort((text_of.astype(np.uint64) << np.uint64(2 * ID_BITS)) | pairs)
                first = np.flatnonzero(np.concatenate([[True], entries[1:] != entries[:-1]]))
                times = np.diff(np.append(first, len(entries)))
                entries = entries[first]
                of = (entries >> np.uint64(2 * ID_BITS)).astype(np.int64)
                pairs = entries & np.uint64((1 << 2 * ID_BITS) - 1)
                sizes = np.bincount(of, minlength=m)
                yield _record(
                    1, kind=[1], rows=[_pack(rows)], sizes=[_pack(sizes.astype(np.int64))],
                    pairs=[_packed_deltas(pairs)], times=[_pack(times.astype(np.int32))],
                )
                yield from counts.add(pairs)
        yield from counts.rest()

    return run


def _looked_up(common):
    """``(row, pair, times, n_best, count_sum)``: sums of a document's common pairs under a number
    that is no pair, and its other pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n = common.value
        for batch in batches:
            for packed in zip(*(batch.column(c) for c in ("rows", "sizes", "pairs", "times")), strict=True):
                rows, sizes = (_unpack(x, np.int64) for x in packed[:2])
                pairs, times = _unpacked_pairs(packed[2]), _unpack(packed[3], np.int32).astype(np.int64)
                of = np.repeat(np.arange(len(rows)), sizes)
                count, found = np.zeros(len(pairs), dtype=np.int64), np.zeros(len(pairs), dtype=bool)
                if len(known):
                    at = np.minimum(np.searchsorted(known, pairs), len(known) - 1)
                    found = known[at] == pairs
                    count[found] = n[at[found]]
                # A count is stored doubled, with one added if it is its first id's highest.
                best, count = count & 1, count >> 1
                sums = [
                    np.add.reduceat(np.append(x * times, 0), np.cumsum(sizes) - sizes) * (sizes > 0)
                    for x in (best, count)
                ]
                m, rest = len(rows), ~found
                none = np.zeros(rest.sum(), dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([x, y]))
                        for x, y in (
                            (rows, rows[of[rest]]),
                            (-1 - rows, pairs[rest]),
                            (np.zeros(m, dtype=np.int64), times[rest]),
                            (sums[0], none),
                            (sums[1], none),
                        )
                    ],
                    ["row", "pair", "times", "n_best", "count_sum"],
                )

    return run


def _commonest(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs and their doubled counts: the most frequent ones, ``most`` at most, in order."""
    grade = F.floor(8 * F.log2("n")).cast("int")
    of_grade = {r["grade"]: r["pairs"] for r in counts.groupBy(grade.alias("grade")).agg(F.count("*").alias("pairs")).collect()}
    least, total = 0, 0
    for g in sorted(of_grade, reverse=True):
        total += of_grade[g]
        if total > most:
            least = g + 1
            break
    known = counts.where(grade >= least).select("pair", (2 * F.col("n") + F.col("best")).alias("n")).toPandas()
    order = np.argsort(known["pair"].to_numpy(dtype=np.int64))
    return known["pair"].to_numpy(dtype=np.int64)[order], known["n"].to_numpy(dtype=np.int64)[order]


def aligned(
    docs: DataFrame,
    a_path: str,
    b_path: str,
    common_pairs: int = COMMON_PAIRS,
    chunk_chars: int = CHUNK_CHARS,
    held_pairs: int = HELD_PAIRS,
) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)`` for every row of
    ``docs``.

    ``A`` encodes a space and the text, ``B`` the text, to which it adds a space; special tokens in a
    text are plain text. A null or empty text has no tokens, nor has one that either side does not
    give back byte by byte (as where it changes a character): all its numbers are 0 and the digest is
    empty. A very long text is a chunk of its own, which takes some 100 bytes of memory a byte. Rows
    count each, also if they repeat a ``doc_id`` or have none. Counts that are equally high are all
    the highest. Other columns of ``docs`` do not matter. No input: no rows.
    """
    context = docs.sparkSession.sparkContext
    with open(a_path, encoding="utf-8") as f:
        a = context.broadcast(f.read())
    with open(b_path, "rb") as f:
        b = context.broadcast(f.read())
    found = stored(
        documents(docs).mapInArrow(_aligned(a, b, chunk_chars, held_pairs), _SCHEMA), "aligned", "kind"
    )
    summed = stored(
        found.where("kind = 2").groupBy("pair").agg(F.sum("n").alias("n")), "pair-counts"
    )
    first = lambda: F.shiftright("pair", ID_BITS)
    highest = summed.groupBy(first().alias("a")).agg(F.max("n").alias("highest"))
    counts = stored(
        summed.withColumn("a", first())
        .join(F.broadcast(highest), "a")  # a row for each id of A at most
        .select("pair", "n", (F.col("n") == F.col("highest")).cast("long").alias("best")),
        "best-counts",
    )
    common = context.broadcast(_commonest(counts, common_pairs))
    entries = found.where("kind = 1").select("rows", "sizes", "pairs", "times")
    each = entries.mapInArrow(
        _looked_up(common), "row long, pair long, times long, n_best long, count_sum long"
    )
    sums = (
        each.join(counts, "pair", "left")
        .groupBy("row")
        .agg(
            F.sum(F.col("n_best") + F.coalesce(F.col("best") * F.col("times"), F.lit(0))).alias("n_best"),
            F.sum(F.col("count_sum") + F.coalesce(F.col("n") * F.col("times"), F.lit(0))).alias("count_sum"),
        )
    )
    rows = found.where("kind = 0").select(
        "row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"
    )
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return rows.join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256"
    )
