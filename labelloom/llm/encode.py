"""BPE encoding and decoding through a table of distinct words.

A tokenizer of the ``tokenizers`` library whose pre-tokenizer cuts texts into words encodes each word
by itself, so a word needs encoding once, however often it occurs.

1. Texts are split into words as the tokenizer's normalizer and pre-tokenizer do it.
2. The word table. The words that repeat in a bounded sample of documents, ``COMMON_WORDS`` at most,
   are encoded and sent to every task. Words that are not among them go, once per document, to the
   task that has all rows of the word; it encodes the word once and sends the ids back to their place
   in the document. The sample decides only which way a word takes, not what it becomes.
3. The words of a text are replaced by their ids, position by position. Texts travel compressed, with
   a dictionary of ``DICTIONARY_BYTES`` made from texts of the sample.
4. Ids are decoded through the table of id and piece, which is as large as the vocabulary.

A word that many documents have is in the sample, so no word brings many rows to one task.
"""

from __future__ import annotations

import hashlib
import json
import os
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.llm.work import documents, tidy

#: Documents read to find out which words are common.
SAMPLE_DOCUMENTS = 50_000
#: Words sent to every task, below 100 MB in each.
COMMON_WORDS = 350_000
DICTIONARY_BYTES = 110 << 10
#: Rows handled at a time, so that what is made of them stays small.
ROWS = 512


class Splitter:
    """The words of a text, of a tokenizer given as JSON.

    The normalizer may consist of NFC, the replacement of white space and lower case; the
    pre-tokenizer has to take what matches one expression. Added tokens are words of their own.
    """

    def __init__(self, tokenizer: str) -> None:
        told = json.loads(tokenizer)
        steps = (told["normalizer"] or {}).get("normalizers", [])
        self.kinds = [s["type"] for s in steps]
        (split,) = [
            s
            for s in told["pre_tokenizer"]["pretokenizers"]
            if s["type"] == "Split" and s["behavior"] == "Removed" and s["invert"]
        ]
        self.find = regex.compile(split["pattern"]["Regex"]).findall
        added = sorted((t["content"] for t in told["added_tokens"]), key=len, reverse=True)
        self.added = regex.compile("|".join(map(regex.escape, added))) if added else None

    def _plain(self, text: str) -> list[str]:
        if not text.isascii():
            if "NFC" in self.kinds:
                text = unicodedata.normalize("NFC", text)
            # Every character by itself: Python alone would treat a sigma at a word's end apart.
            text = text.replace("Σ", "σ")
        if "Lowercase" in self.kinds:
            text = text.lower()
        return self.find(text)

    def __call__(self, text: str) -> list[str]:
        if self.added is None or self.added.search(text) is None:
            return self._plain(text)
        words, at = [], 0
        for m in self.added.finditer(text):
            words += self._plain(text[at : m.start()])
            words.append(m.group())
            at = m.end()
        return words + self._plain(text[at:])


class Encoder:
    """The ids of distinct words, as bytes of four to an id."""

    def __init__(self, tokenizer: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks share the cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()

    def __call__(self, words: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch(words, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in found]


def _word_counts(tokenizer):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, counts = Splitter(tokenizer.value), Counter()
        for batch in batches:
            for text in batch.column(batch.schema.get_field_index("text")).to_pylist():
                counts.update(split(text))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
            ["word", "n"],
        )

    return tidy(run)


def _encoded_words(tokenizer):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(tokenizer.value)
        for batch in batches:
            words = batch.column(0)
            yield pa.RecordBatch.from_arrays(
                [words, pa.array(encode(words.to_pylist()), pa.binary())], ["word", "ids"]
            )

    return tidy(run)


def _known(table: bytes) -> dict[str, bytes]:
    words = pa.ipc.open_stream(pa.py_buffer(table)).read_all()
    return dict(zip(words["word"].to_numpy(), words["ids"].to_numpy(), strict=True))


class Known:
    """The ids of words as two columns, which is how they are sent. In a task it is a dictionary, which
    takes more than ten times the room."""

    def __init__(self, table: pa.Table) -> None:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as out:
            out.write_table(table)
        self.table = sink.getvalue().to_pybytes()

    def __reduce__(self):
        return _known, (self.table,)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            yield batch.slice(start, ROWS)


def _others(words: list[str], known: dict[str, bytes]) -> dict[str, int]:
    """The distinct words that are not common, numbered as they come."""
    other = set(words).difference(known)
    return {w: k for k, w in enumerate(dict.fromkeys(filter(other.__contains__, words)))}


def _other_words(tokenizer, common):
    """``(doc_id, word, place)``: once for each distinct word of a document that is not common."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, known = Splitter(tokenizer.value), common.value
        for batch in _slices(batches):
            ids, words, places = [], [], []
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            for doc, text in zip(batch.column("doc").to_pylist(), texts, strict=True):
                own = _others(split(text), known)
                ids += [doc] * len(own)
                words += own.keys()
                places += own.values()
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(words, pa.string()), pa.array(places, pa.int32())],
                ["doc", "word", "place"],
            )

    return tidy(run)


def _encode_runs(tokenizer):
    """Rows sorted by word get its ids; each distinct word is encoded once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, last, ids = Encoder(tokenizer.value), None, b""
        for batch in batches:
            words = batch.column("word").to_pylist()
            new = [w for k, w in enumerate(words) if w != (words[k - 1] if k else last)]
            table = dict(zip(new, encode(new), strict=True))
            if last is not None:
                table[last] = ids
            if words:
                last, ids = words[-1], table[words[-1]]
            found = pa.array([table[w] for w in words], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), batch.column("place"), found], ["doc", "place", "ids"]
            )

    return tidy(run)


def _packed(dictionary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = zstandard.ZstdCompressionDict(dictionary.value) if dictionary.value else None
        pack = zstandard.ZstdCompressor(level=3, dict_data=known).compress
        for batch in _slices(batches):
            texts = batch.column(batch.schema.get_field_index("text")).cast(pa.binary())
            packed = pa.array([pack(t.as_py()) for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("doc"), packed], ["doc_id", "doc", "packed"]
            )

    return tidy(run)


def _replaced(tokenizer, common, dictionary):
    """``(doc_id, ids)`` from ``(doc_id, packed, words)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, known = Splitter(tokenizer.value), common.value
        with_words = zstandard.ZstdCompressionDict(dictionary.value) if dictionary.value else None
        unpack = zstandard.ZstdDecompressor(dict_data=with_words).decompress
        for batch in _slices(batches):
            found = []
            packed, others = batch.column("packed"), batch.column("words")
            for p, told in zip(packed, others, strict=True):
                words = split(unpack(p.as_py()).decode())
                ids = list(map(known.get, words))
                if None in ids:
                    sent = {x["place"]: x["ids"] for x in told.as_py()}
                    own = {w: sent[k] for w, k in _others(words, known).items()}
                    ids = [own[w] if x is None else x for w, x in zip(words, ids, strict=True)]
                found.append(b"".join(ids))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found, pa.binary())], ["doc_id", "ids"]
            )

    return tidy(run)


def _dictionary(texts: list[str]) -> bytes:
    """A compression dictionary; none if there is too little text for one."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, [t.encode() for t in texts]).as_bytes()
    except zstandard.ZstdError:
        return b""


def encoded(
    docs: DataFrame,
    tokenizer_path: str,
    sample_documents: int = SAMPLE_DOCUMENTS,
    common_words: int = COMMON_WORDS,
) -> DataFrame:
    """``(doc_id, ids)`` for every row of ``docs``: the ids of the whole text, four bytes (the lowest
    first) to an id. A null or empty text has none.

    Rows with the same ``doc_id`` are encoded each; so are those without one. Extra columns of
    ``docs`` do not matter. No input: no rows.
    """
    docs = documents(docs).withColumn("doc", F.xxhash64("doc_id", "text"))
    context = docs.sparkSession.sparkContext
    with open(tokenizer_path, encoding="utf-8") as f:
        tokenizer = context.broadcast(f.read())
    total = docs.count()
    sample = docs if total <= sample_documents else docs.sample(sample_documents / total, seed=7)
    counted = (
        sample.mapInArrow(_word_counts(tokenizer), "word string, n long")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
        .where("n > 1")
        .orderBy(F.desc("n"), "word")
        .limit(common_words)
        .select("word")
    )
    table = counted.mapInArrow(_encoded_words(tokenizer), "word string, ids binary").toArrow()
    common = context.broadcast(Known(table))
    del table
    some = [r["text"][:20_000] for r in sample.select("text").limit(2_000).collect()]
    dictionary = context.broadcast(_dictionary(some))
    # Equal rows have the same ``doc``; their places are the same.
    others = (
        docs.mapInArrow(_other_words(tokenizer, common), "doc long, word string, place int")
        .repartition("word")
        .sortWithinPartitions("word")
        .mapInArrow(_encode_runs(tokenizer), "doc long, place int, ids binary")
        .groupBy(F.col("doc").alias("of"))
        .agg(F.collect_list(F.struct("place", "ids")).alias("words"))
    )
    packed = docs.mapInArrow(_packed(dictionary), "doc_id long, doc long, packed binary")
    return (
        packed.join(others, packed["doc"] == others["of"], "left")
        .select("doc_id", "packed", "words")
        .mapInArrow(_replaced(tokenizer, common, dictionary), "doc_id long, ids binary")
    )


def pieces_of(tokenizer_path: str) -> dict[int, str]:
    """The id-to-piece table, added tokens included."""
    with open(tokenizer_path, encoding="utf-8") as f:
        told = json.load(f)
    table = {k: piece for piece, k in told["model"]["vocab"].items()}
    return table | {t["id"]: t["content"] for t in told["added_tokens"]}


def _decoded(pieces, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.array([pieces.value.get(k, "") for k in range(max(pieces.value) + 1)], dtype=object)
        numbers = np.array([str(k) for k in range(len(table))], dtype=object)
        for batch in _slices(batches):
            n, ids_sha, text_sha, texts = [], [], [], []
            for x in batch.column("ids"):
                ids = np.frombuffer(x.as_buffer(), dtype="<u4")
                text = " ".join(table[ids])
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(" ".join(numbers[ids]).encode()).hexdigest())
                text_sha.append(hashlib.sha256(text.encode()).hexdigest())
                texts.append(text)
            columns = [
                batch.column("doc_id"),
                pa.array(n, pa.int64()),
                pa.array(ids_sha, pa.string()),
                pa.array(text_sha, pa.string()),
            ]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_text:
                columns, names = [*columns, pa.array(texts, pa.string())], [*names, "decoded"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return tidy(run)


def decoded(ids: DataFrame, tokenizer_path: str, with_text: bool = True) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256[, decoded])`` of ``(doc_id, ids)``.

    Each id is looked up in the table of id and piece; for a tokenizer without a decoder the pieces
    joined by spaces are what its own ``decode`` gives. The digests are of the decimal ids joined by
    spaces, and of the decoded text.
    """
    pieces = ids.sparkSession.sparkContext.broadcast(pieces_of(tokenizer_path))
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return ids.mapInArrow(_decoded(pieces, with_text), schema + ", decoded string" * with_text)
