"""Min-max hashing against the comparison of all pairs of word sets."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelloom.llm import minmax, near, queries
from labelloom.llm.near import near_groups
from labelloom.llm.minmax import MinMax, band_keys, min_max_groups, most_differing, sketch
from tests.llm import brute
from tests.llm.conftest import SMALL, by_id

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _shingles(text, size=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(_LOWER))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def _plain(rows, similarity=85):
    """``{doc_id: (n_shingles, component_id, kept)}`` for distinct ids, by all pairs that share a
    shingle."""
    sets = {i: _shingles(t) for i, t in rows}
    component = {i: i for i in sets}

    def root(i):
        while component[i] != i:
            i = component[i]
        return i

    having: dict[tuple, list] = {}
    for i, s in sets.items():
        for x in s:
            having.setdefault(x, []).append(i)
    for i, s in sets.items():
        for j in {j for x in s for j in having[x] if j < i}:
            both = len(s & sets[j])
            if 100 * both >= similarity * (len(s) + len(sets[j]) - both):
                a, b = sorted((root(i), root(j)))
                component[b] = a
    return {i: (len(s), root(i), root(i) == i) for i, s in sets.items()}


def _frame(spark, rows, parts=3):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)


def test_query_equals_all_pairs(spark, small):
    assert by_id(queries.op13_min_max(spark, SMALL)) == _plain(small[1])


def test_odd_texts(odd):
    docs, rows = odd
    assert by_id(min_max_groups(docs)) == _plain(rows)


def _families(seed=3):
    """Originals with copies that differ from the original a little and from each other more, chains,
    texts with something appended, frames with other fillings, and texts apart."""
    rnd = random.Random(seed)
    word = lambda: f"w{rnd.randrange(5_000)}"
    texts = []
    for _ in range(3):
        base = [word() for _ in range(200)]
        for _ in range(60):
            copy = list(base)
            for at in rnd.sample(range(200), rnd.randrange(2, 6)):
                copy[at] = word()
            texts.append(copy)
    step = [word() for _ in range(150)]
    for _ in range(25):
        texts.append(list(step))
        step[rnd.randrange(150)] = word()
        step[rnd.randrange(150)] = word()
    frame = [word() for _ in range(160)]
    texts += [frame + [word() for _ in range(rnd.randrange(20, 60))] for _ in range(80)]
    for share in range(5, 30):
        base = [word() for _ in range(120)]
        texts += [base, base + [word() for _ in range(120 * share // 100)]]
    texts += [[word() for _ in range(rnd.randrange(1, 40))] for _ in range(60)]
    texts += [texts[0]] * 40 + [["same", "short"]] * 30
    rnd.shuffle(texts)
    return [(k, " ".join(t)) for k, t in enumerate(texts)]


@pytest.mark.parametrize("rounds,block", [(2, 2_000), (0, 7), (1, 2_000), (3, 50)])
def test_families(spark, monkeypatch, rounds, block):
    monkeypatch.setattr(minmax, "BLOCK_SETS", block)
    monkeypatch.setattr(minmax.Search, "few", 64 if block > 100 else 1)
    rows = _families()
    assert by_id(min_max_groups(_frame(spark, rows, 7), rounds=rounds)) == _plain(rows)


@pytest.mark.parametrize("rounds,block,few", [(1, 2_000, 64), (0, 7, 1), (0, 2_000, 8)])
def test_families_by_n_grams(spark, monkeypatch, rounds, block, few):
    """The join of five-word shingles searches in the same way."""
    monkeypatch.setattr(minmax, "BLOCK_SETS", block)
    monkeypatch.setattr(near._Join, "few", few)
    rows = _families(9)
    found = by_id(near_groups(_frame(spark, rows, 5), frequent_from=6, pivot_rounds=rounds))
    assert found == brute.near(rows)


def test_words_whose_letters_swap_places_are_different(spark):
    first = "a"
    for _ in range(10):
        first += first.translate(str.maketrans("ab", "ba"))
    rows = [(1, first), (2, first.translate(str.maketrans("ab", "ba")))]
    assert by_id(min_max_groups(_frame(spark, rows))) == {1: (1, 1, True), 2: (1, 2, True)}


def test_repeated_and_missing_ids(spark):
    text = " ".join(f"w{k}" for k in range(100))
    rows = [(5, text), (5, "other words than these"), (None, text + " end"), (None, "lone one here")]
    rows += [(9, text), (5, text), (None, None), (3, "")]
    out = [tuple(r) for r in min_max_groups(_frame(spark, rows)).collect()]
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted(out, key=key) == sorted(
        [
            (None, 0, None, True), (None, 1, None, True), (None, 99, 5, False), (3, 0, 3, True),
            (5, 2, 5, True), (5, 98, 5, True), (5, 98, 5, True), (9, 98, 5, False),
        ],
        key=key,
    )


def test_columns_with_clashing_names_and_an_empty_table(spark, empty):
    rows = _families()[:60]
    df = _frame(spark, rows)
    for name in ("row", "keys", "key", "node", "n", "first", "component", "digest", "kept", "a", "b"):
        df = df.withColumn(name, F.lit("clash"))
    assert by_id(min_max_groups(df)) == _plain(rows)
    assert min_max_groups(empty).count() == 0


def test_signatures_estimate_similarity():
    random = np.random.default_rng(2)
    pool = random.integers(0, 1 << 64, size=1_200, dtype=np.uint64)
    x, y = pool[:1_100], pool[100:]  # 1000 of 1200
    a, b = (MinMax(960)(s) for s in (x, y))
    assert abs((a == b).mean() - 1000 / 1200) < 0.03
    bits = np.bitwise_count((sketch(a, 1) ^ sketch(b, 1)).view(np.uint64)).sum()
    assert abs(1 - 2 * bits / (2 * 960) - 1000 / 1200) < 0.06
    planes = (sketch(a) ^ sketch(b)).view(np.uint64).reshape(4, -1)
    apart = np.bitwise_count(np.bitwise_or.reduce(planes)).sum()
    assert abs(1 - apart / (2 * 960 * 15 / 16) - 1000 / 1200) < 0.04
    every = np.concatenate([MinMax()(np.sort(x[k:])) for k in (0, 700, 1_090)])
    assert (every[:, 0] <= every[:, 1]).all()
    assert (MinMax()(x[::-1].copy()) == MinMax()(x)).all()
    assert len(np.unique(band_keys(MinMax()(x)[:96]))) == 32


def test_sketches_of_similar_sets_seldom_differ_by_more():
    most = most_differing(192, 85, bits=1)
    random = np.random.default_rng(1)
    differing = (random.random((200_000, 192)) < 0.075).sum(axis=1)
    assert 30 < most < 45 and differing.max() <= most
    assert most_differing(192, 100) == 0 and most < most_differing(192, 85) < 60
