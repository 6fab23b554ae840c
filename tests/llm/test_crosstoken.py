"""Alignment of two tokenizers against a plain version that uses both libraries text by text."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from labelloom.llm import queries
from labelloom.llm.crosstoken import Aligner, ByteLevel, SentencePiece, aligned, last_tokens, links_of
from tests.llm.conftest import SMALL

A, B = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "piece_bpe_32k.model"))

_ALPHABET: dict[str, int] = {}


def _plain_tokens(text, coders):
    """``[(id, start, end)]`` of both sides, or nothing."""
    a, b = coders
    if not text:
        return [], []
    whole = (" " + text).encode()
    sides = []
    encoded = a.encode(" " + text, add_special_tokens=False)
    pieces = [bytes(_byte(c) for c in a.id_to_token(k)) for k in encoded.ids]
    sides.append((encoded.ids, pieces))
    ids = b.encode(text)
    pieces = []
    for k in ids:
        p = b.id_to_piece(k)
        pieces.append(bytes([int(p[3:5], 16)]) if b.is_byte(k) else p.replace("▁", " ").encode())
    sides.append((ids, pieces))
    out = []
    for ids, pieces in sides:
        if b"".join(pieces) != whole:
            return [], []
        at, tokens = 0, []
        for k, p in zip(ids, pieces, strict=True):
            tokens.append((k, at, at + len(p)))
            at += len(p)
        out.append(tokens)
    return out


def _byte(c: str) -> int:
    """By the published rule: printable characters stand for themselves, others follow from 256."""
    if not _ALPHABET:
        n = 0
        for b in range(256):
            if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b:
                _ALPHABET[chr(b)] = b
            else:
                _ALPHABET[chr(256 + n)] = b
                n += 1
    return _ALPHABET[c]


def _plain(rows):
    """``[(doc_id, n_a, ..., groups_sha256)]``, in the order of the rows."""
    _byte("a")
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    coders = a, sentencepiece.SentencePieceProcessor(model_file=B)
    docs, having = [], Counter()
    for _, text in rows:
        x, y = _plain_tokens(text, coders)
        links, j = [], 0
        for k, s, e in x:
            while y[j][2] <= s:
                j += 1
            i = j
            while i < len(y) and y[i][1] < e:
                links.append((k, y[i][0]))
                i += 1
        docs.append((x, y, links))
        having.update(set(links))
    highest: dict[int, int] = {}
    for (k, _), n in having.items():
        highest[k] = max(n, highest.get(k, 0))
    out = []
    for (doc_id, _), (x, y, links) in zip(rows, docs, strict=True):
        cuts = sorted({e for _, _, e in x} & {e for _, _, e in y})
        groups, i, j = [], 0, 0
        for cut in cuts:
            parts = [[], []]
            while i < len(x) and x[i][2] <= cut:
                parts[0].append(str(x[i][0]))
                i += 1
            while j < len(y) and y[j][2] <= cut:
                parts[1].append(str(y[j][0]))
                j += 1
            groups.append("|".join(",".join(p) for p in parts))
        written = ";".join(groups)
        best = sum(having[p] == highest[p[0]] for p in links)
        total = sum(having[p] for p in links)
        digest = hashlib.sha256(written.encode()).hexdigest() if written else ""
        out.append((doc_id, len(x), len(y), len(groups), len(links), best, total, digest))
    return out


def _rows(df):
    names = "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256".split()
    assert df.columns == names
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_query_equals_the_plain_version(spark, small):
    assert _rows(queries.op12_alignment(spark, SMALL)) == sorted(_plain(small[1]), key=str)


@pytest.mark.parametrize("common,chunk,held", [(3_000_000, 600_000, 2_000_000), (40, 500, 300), (0, 1, 1)])
def test_odd_texts_at_any_size_of_table_chunk_and_buffer(odd, common, chunk, held):
    docs, rows = odd
    extra = ["a ▁ b", "<unk> <s> </s> <0x41>", "\x00 nul", "ﬁ ligature", "  two  spaces ", "\n\n\t tabs"]
    extra += ["日本語のテキスト", "🤝🏽 héllo wörld", "é combining", "﻿bom", "don't we'll I'd"]
    rows = rows + [(1000 + k, t) for k, t in enumerate(extra)]
    df = docs.sparkSession.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for name in ("row", "kind", "pair", "n", "best", "a", "n_a", "pairs"):
        df = df.withColumn(name, F.lit("clash"))
    assert _rows(aligned(df, A, B, common, chunk, held)) == sorted(_plain(rows), key=str)


def test_repeated_rows_and_null_ids(spark):
    rows = [(1, "one two"), (1, "one two"), (1, "three"), (None, "four five"), (None, "one"), (2, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert _rows(aligned(df, A, B)) == sorted(_plain(rows), key=str)


def test_empty_table(spark, empty):
    assert _rows(aligned(empty, A, B)) == []


def test_pairs_of_a_token_with_many_partners(spark):
    """One id of A in every document, with one partner in a third of them."""
    rows = [(k, "the " * (k % 3 + 1) + f"x{k}") for k in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for common in (3, 10_000):
        assert _rows(aligned(df, A, B, common)) == sorted(_plain(rows), key=str)


def test_groups_by_doubling():
    random.seed(4)
    for _ in range(200):
        n = random.randrange(1, 60)
        a = sorted({*random.sample(range(1, n + 1), random.randrange(0, n)), n})
        b = sorted({*random.sample(range(1, n + 1), random.randrange(0, n)), n})
        last = last_tokens(np.array(a), np.array(b))
        both = sorted(set(a) & set(b))
        plain = [b.index(next(c for c in both if c >= e)) for e in (*a, *b)]
        assert last.tolist() == plain
        x, y = links_of(np.array(a), np.array(b))
        spans = lambda ends: list(zip([0, *ends[:-1]], ends, strict=True))
        pairs = [
            (i, j)
            for i, (s, e) in enumerate(spans(a))
            for j, (t, f) in enumerate(spans(b))
            if s < f and t < e
        ]
        assert sorted(zip(x.tolist(), y.tolist(), strict=True)) == pairs


def test_one_chain_through_a_whole_long_text():
    """Ends that meet at the last byte alone: a chain of a million tokens, twenty doublings."""
    n = 1_000_000
    a = np.append(np.arange(2, 2 * n, 2), 2 * n)
    b = np.append(np.arange(1, 2 * n, 2), 2 * n)
    assert (last_tokens(a, b) == len(b) - 1).all()


def test_both_libraries_agree_on_every_code_point():
    with open(A, encoding="utf-8") as f:
        told = f.read()
    fast = ByteLevel(told)
    slow = Tokenizer.from_str(told)
    slow.encode_special_tokens = True
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for k in range(0, len(points), 4096):
        text = " ".join(f"a{c}1{c}{c}  {c}" for c in points[k : k + 4096])
        assert fast.encode(text).tolist() == slow.encode(text, add_special_tokens=False).ids
    for text in ("<|endoftext|>", " " * 30_000, "a" * 30_000, "\n" * 3_000 + "x", "'s't"):
        assert fast.encode(text).tolist() == slow.encode(text, add_special_tokens=False).ids


def test_a_tokenizer_with_other_settings_is_the_library_itself():
    with open(A, encoding="utf-8") as f:
        told = f.read().replace('"add_prefix_space":false', '"add_prefix_space":true', 1)
        told = told.replace('"add_prefix_space": false', '"add_prefix_space": true', 1)
    with open(B, "rb") as f:
        align = Aligner(ByteLevel(told), SentencePiece(f.read()))
    assert align(["x"])[0].tolist() == [1]
    slow = Tokenizer.from_str(told)
    assert align.a.encode("x y").tolist() == slow.encode("x y", add_special_tokens=False).ids
