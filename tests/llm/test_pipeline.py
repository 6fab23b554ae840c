"""The pipeline, stage by stage, against the operators it applies and their plain versions."""

from __future__ import annotations

import hashlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from labelloom.llm.decontaminate import questions_and_answers
from labelloom.llm.quality import BUCKETS
from labelloom.llm.suffixes import suffix_array
from tests.llm import brute
from tests.llm.conftest import SMALL, by_id, drawn, hashed


def _planted(spark, docs):
    """The documents with benchmark items put into some, and near copies that are longer or shorter."""
    rows = [r.asDict() for r in docs.orderBy("doc_id").collect()]
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet").orderBy("item_id").collect()
    for k, item in enumerate(items[:12]):
        rows[5 * k]["text"] = f"{rows[5 * k]['text']} {item['text']} {rows[5 * k + 1]['text']}"
    top = max(r["doc_id"] for r in rows)
    for k in range(12):
        words = (rows[3 * k + 1]["text"] or "").split()
        extra = words[: len(words) * (k + 4) // 40]
        rows.append({**rows[3 * k + 1], "doc_id": top + 1 + k, "text": " ".join(words + extra)})
    return spark.createDataFrame(rows, docs.schema).repartition(3)


@pytest.mark.parametrize("planted", [False, True])
def test_stages(spark, small, planted):
    """Each stage against its plain version, on the rows it is given."""
    docs, _ = small
    columns, stages = docs.columns, dict(corpus_pipeline.STAGES)
    if planted:
        docs = _planted(spark, docs)
    items = questions_and_answers(spark.read.parquet(f"{SMALL}/benchmark.parquet"))
    items = [tuple(r) for r in items.collect()]
    marked = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    kept, gone = docs, 0
    for name in ("quality", "exact_dedup", "near_dedup", "decontaminate"):
        before = [(r["doc_id"], r["text"]) for r in kept.collect()]
        kept = stages[name](spark, kept, SMALL)
        assert kept.columns == columns
        left = {r["doc_id"] for r in kept.collect()}
        if name == "quality":
            plain = brute.quality(before, marked, drawn(docs), BUCKETS, hashed)
            assert left == {d for d, x in plain.items() if x[3]}
        if name == "decontaminate":
            leaked = {d for d, _ in brute.leaks(before, items)}
            gone = len(leaked)
            assert left == {d for d, _ in before} - leaked
        if name == "exact_dedup":
            assert left == {d for d, x in brute.exact(before).items() if x[2]}
        if name == "near_dedup":
            assert left == {d for d, x in brute.near(before).items() if x[1] == d}
        assert left <= {d for d, _ in before}
    assert gone or not planted
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    encoded = by_id(stages["encode"](spark, kept, SMALL), "n_tokens", "ids_sha256")
    assert encoded.keys() == left
    for r in kept.select("doc_id", "text").collect():
        ids = tokenizer.encode(r["text"] or "", add_special_tokens=False).ids
        told = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert encoded[r["doc_id"]] == (len(ids), told)
    if not planted:
        assert by_id(corpus_pipeline.run(spark, SMALL)).keys() == left


def test_stages_on_odd_tables(spark, odd, empty, repeated):
    for docs in (odd[0], empty, repeated):
        rows = docs.count()
        for name, stage in corpus_pipeline.STAGES:
            left = stage(spark, docs, SMALL)
            assert left.count() <= rows, name
            if name != "encode":
                assert left.columns == docs.columns


def test_suffix_array():
    for text in (b"", b"a", b"banana", b"abababab", b"mississippi", bytes(range(50)) * 3, b"a" * 99):
        assert suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])
