"""Each operator against its plain version, and on odd tables."""

from __future__ import annotations

import hashlib
import math
import pickle

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
from pyspark import SparkContext
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from labelloom.llm import lm, queries
from labelloom.llm.decontaminate import leaked_items, questions_and_answers
from labelloom.llm.encode import Known, decoded, encoded
from labelloom.llm.exact import bucket_of, exact_groups
from labelloom.llm.lm import katz_scores
from labelloom.llm.near import near_groups
from labelloom.llm.pii import personal_data
from labelloom.llm.quality import kth_largest, quality_sample
from labelloom.llm.repeats import GROUP_REGIONS, Runs, without_repeats
from labelloom.llm.secrets import secrets
from labelloom.llm.toxicity import maximal_segments, toxicity, train
from tests.llm import brute
from tests.llm.conftest import SMALL, by_id, drawn, hashed

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def _learned():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 != 2, F.lit(True))


def _labels(spark):
    return spark.read.parquet(f"{SMALL}/labels.parquet")


def _items(spark):
    return questions_and_answers(spark.read.parquet(f"{SMALL}/benchmark.parquet"))


def _operators(spark, docs):
    """Every operator's result for ``docs``."""
    corpus = spark.read.parquet(f"{SMALL}/documents.parquet")
    return {
        "toxicity": toxicity(docs, train(corpus, _labels(spark))),
        "encode": decoded(encoded(docs, TOKENIZER), TOKENIZER),
        "exact": exact_groups(docs),
        "pii": personal_data(docs),
        "quality": quality_sample(docs, _labels(spark)),
        "lm": katz_scores(docs, _learned()),
        "secrets": secrets(docs),
        "near": near_groups(docs),
        "repeats": without_repeats(docs),
    }


def test_empty_tables(spark, empty):
    for name, df in _operators(spark, empty).items():
        assert df.count() == 0, name
    assert leaked_items(empty, _items(spark)).count() == 0


def test_repeated_rows_and_null_ids(spark, repeated):
    for name, df in _operators(spark, repeated).items():
        rows = [r.asDict() for r in df.collect()]
        assert len(rows) == 8, name
        for doc_id in (1, 2, 3, None):
            a, b = (r for r in rows if r["doc_id"] == doc_id)
            assert a == b, name


@pytest.mark.parametrize("table_bytes", [1 << 20, 200])
def test_exact(odd, table_bytes):
    docs, rows = odd
    assert by_id(exact_groups(docs, table_bytes)) == brute.exact(rows)


def test_exact_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    expected = con.sql(queries.ORACLE_SQL["op3_exact_dedup"]).fetchall()
    found = queries.op3_exact_dedup(spark, SMALL).collect()
    assert sorted(map(tuple, found)) == sorted(expected)


def test_buckets_are_split_until_they_fit(spark):
    digests = spark.range(300).select(
        F.encode(F.col("id").cast("string"), "utf-8").alias("digest"), F.lit(10).alias("n_bytes")
    )
    placed = bucket_of(digests, 25, fan_out=2).groupBy("bucket").count().collect()
    assert sum(r["count"] for r in placed) == 300
    assert max(r["count"] for r in placed) <= 2


@pytest.mark.parametrize("settings", [{}, {"frequent_from": 2, "block_shingles": 500}])
def test_near(small, odd, settings):
    for docs, rows in (small, odd):
        assert by_id(near_groups(docs, **settings)) == brute.near(rows)


def test_near_links_a_large_group_without_all_pairs(spark):
    base = [f"w{i}" for i in range(300)]
    rows = [(k, " ".join([*base[: k % 290], f"x{k}", *base[k % 290 + 1 :]])) for k in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert by_id(near_groups(docs, frequent_from=5)) == brute.near(rows)


def test_near_links_texts_of_different_length(spark):
    rows = []
    for k in range(400):
        n = 40 + k % 160
        text = [f"t{k}w{i}" for i in range(n)]
        more = [f"t{k}x{i}" for i in range((n - 4) * (18 + k % 8) // 100)]
        rows += [(2 * k, " ".join(text)), (2 * k + 1, " ".join(text + more))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = brute.near(rows)
    assert sum(d != top for d, (_, top) in expected.items()) == 400
    assert by_id(near_groups(docs)) == expected


@pytest.mark.parametrize("settings", [{}, {"group_regions": 1}, {"span": 30, "gram": 8}])
def test_repeats(small, odd, settings):
    for docs, rows in (small, odd):
        columns = ("n_bytes", "n_removed", "n_spans", "kept_sha256")
        found = by_id(without_repeats(docs, **settings), *columns)
        assert found == brute.repeats(rows, settings.get("span", 100))


def test_repeats_of_rows_that_share_an_id(spark):
    """Different texts of one id, or without one, are documents of their own."""
    random = np.random.default_rng(8)
    text = lambda n: "".join(random.choice(list("abcdefgh"), n))
    a, b, c, d = (text(400) for _ in range(4))
    for rows in (
        [(1, a), (None, a), (None, b)],
        [(1, a), (2, a), (2, b)],
        [(1, a), (2, c + a), (2, b), (2, b), (None, c), (None, d + b[:200]), (3, d), (None, ""), (None, None)],
    ):
        order = sorted(
            set(rows), key=lambda r: (r[0] is None, r[0] or 0, hashlib.sha256((r[1] or "").encode()).hexdigest())
        )
        plain = brute.repeats([(k, t) for k, (_, t) in enumerate(order)])
        expected = sorted((str(i), *plain[order.index((i, t))]) for i, t in rows)
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        out = without_repeats(df).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
        assert sorted((str(r[0]), *r[1:]) for r in out.collect()) == expected


@pytest.mark.parametrize(
    "settings",
    [
        {},
        {"block_bytes": 5_000, "bucket_bytes": 9_000, "hot_keys": 5},
        {"block_bytes": 1, "bucket_bytes": 50_000, "hot_keys": 0, "sample_documents": 3},
    ],
)
def test_lm(small, odd, settings):
    for docs, rows in (small, odd):
        expected, chance, words = brute.katz(rows)
        found = by_id(katz_scores(docs, _learned(), **settings))
        assert found.keys() == expected.keys()
        for d, row in expected.items():
            assert found[d] == pytest.approx(row, rel=1e-9)
        for history in [1, 0, *list(words)[:3]]:
            assert sum(chance(history, w) for w in words) == pytest.approx(1)


def test_lm_is_one_model_in_any_layout(small):
    docs, _ = small
    first = by_id(katz_scores(docs.repartition(1), _learned()))
    for parts, settings in ((5, {"sample_documents": 60}), (40, {"hot_keys": 50, "sample_documents": 20})):
        other = by_id(katz_scores(docs.repartition(parts), _learned(), bucket_bytes=100_000, **settings))
        assert other.keys() == first.keys()
        for d, row in first.items():
            assert other[d] == pytest.approx(row, rel=1e-9)


def test_lm_histories_sum_to_one(spark):
    """The operator's own scores of all words after a history, taken apart from texts of one or two."""
    learned = "a b a c a b d a b . c c b a b a c d d a a b".split()
    words = [*sorted(set(learned)), "unseen"]
    texts = [" ".join(learned), " ".join(learned[::2])] + words
    texts += [f"{h} {w}" for h in words for w in words]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = by_id(katz_scores(df, F.col("doc_id") < 2, hot_keys=2), "score")
    score = {t: found[i][0] for i, t in enumerate(texts)}
    n = 2 + len(learned) + len(learned[::2])  # tokens learned from
    slot = math.log10(1 / (n + 3))  # after a word never seen, as of the start, unigrams alone decide
    ends = {"unseen": math.log10(3 / (n + 3))}
    ends |= {w: score[f"unseen {w}"] - score["unseen"] + ends["unseen"] - _unigram(learned, w, n) for w in words[:-1]}
    for h in words:
        total = 10 ** ends[h]
        for w in words:
            total += 10 ** (score[f"{h} {w}"] - ends[w] - (score[h] - ends[h]))
        total += 10 ** _backoff(score, ends, h, slot) * 10**slot  # the start, which nothing is followed by
        assert total == pytest.approx(1, rel=1e-9), h


def _unigram(learned, w, n):
    return math.log10((learned + learned[::2]).count(w) / (n + 3))


def _backoff(score, ends, h, slot):
    """The weight of a history, by what it gives to a word never seen."""
    return score[f"{h} unseen"] - ends["unseen"] - (score[h] - ends[h]) - slot


def test_lm_tells_words_apart_whose_letters_swap_places(spark):
    first = "a"
    for _ in range(10):
        first += first.translate(str.maketrans("ab", "ba"))
    other = first.translate(str.maketrans("ab", "ba"))
    df = spark.createDataFrame([(1, first), (2, other), (3, first)], "doc_id long, text string")
    found = by_id(katz_scores(df, F.col("doc_id") != 2), "n_tokens", "n_known")
    assert found == {1: (2, 2), 2: (2, 1), 3: (2, 2)}


def test_lm_rows_that_share_an_id(spark):
    rows = [(1, "a b c"), (1, "d e"), (None, "a b"), (None, None), (2, "a b c")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = katz_scores(df, F.lit(True)).collect()
    assert sorted((str(r["doc_id"]), r["n_tokens"]) for r in out) == [
        ("1", 3), ("1", 4), ("2", 4), ("None", 1), ("None", 3),
    ]
    same = {r["score"] for r in out if r["n_tokens"] == 4}
    assert len(same) == 1


def test_pair_orders_survive_colliding_keys(monkeypatch):
    monkeypatch.setattr(lm, "pair_keys", lambda h, w: (h + w) % np.uint64(3))
    random = np.random.default_rng(1)
    h, w = random.integers(0, 9, size=(2, 500), dtype=np.uint64)
    order = lm.by_pair(h, w)
    assert lm._new(h[order], w[order]).sum() == len(set(zip(h.tolist(), w.tolist(), strict=True)))


def test_encode(small, odd):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    for docs, rows in (small, odd):
        for common in (400_000, 5):
            ids = encoded(docs, TOKENIZER, common_words=common)
            found = by_id(decoded(ids, TOKENIZER, with_text=False))
            for d, text in rows:
                ids = tokenizer.encode(text or "", add_special_tokens=False).ids
                back = tokenizer.decode(ids, skip_special_tokens=False)
                sha = [hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), back)]
                assert found[d] == (len(ids), *sha), text and text[:80]


def test_pii(small, odd):
    columns = ("n_email", "n_ip", "n_card", "n_phone", "base_sha256")
    for docs, rows in (small, odd):
        found = by_id(personal_data(docs), *columns)
        assert found == {d: brute.personal(t) for d, t in rows}


def test_pii_checks_and_context(spark):
    texts = [
        "IBAN DE89 3704 0044 0532 0130 00.",
        "IBAN DE88 3704 0044 0532 0130 00.",
        "social security 123-45-6789",
        "part 123-45-6789",
        "credit card 378282246310005",
        "number 378282246310005",
        "call (415) 555-1234",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kinds = {d: s.split(":")[0] for d, (s,) in by_id(personal_data(docs), "spans").items()}
    assert kinds == {0: "iban", 1: "", 2: "ssn", 3: "", 4: "card_short", 5: "", 6: "tel"}


def test_secrets(small, odd):
    columns = ("n_assign", "n_access", "n_hex", "base_sha256")
    for docs, rows in (small, odd):
        found = by_id(secrets(docs), *columns)
        assert found == {d: brute.secret_spans(t) for d, t in rows}


def test_secrets_that_many_own_are_examples(spark):
    own, copied = "Zk3vQ9xT7bN2mR5wY8cL1pD4", "Qm7rT2xV9bK4nZ6wJ1cH8sF3"
    rows = [(k, f"key {copied} here", f"s{k}") for k in range(5)] + [(9, f"key {own} here", "s1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = by_id(secrets(docs), "spans", "n_live", "n_copied")
    assert found[9] == ("entropy:4:28", 1, 0)
    assert found[0] == ("", 0, 1)


def test_maximal_segments():
    import numpy as np

    found = maximal_segments(np.array([0, 1, 9, 10, 30]), np.array([2.0, 1.0, 5.0, -1.0, 1.0]), 0.5)
    assert [(a, b) for a, b, _ in found] == [(0, 1), (9, 9), (30, 30)]
    found = maximal_segments(np.array([0, 2, 4]), np.array([2.0, 2.0, 2.0]), 0.5)
    assert found == [(0, 4, 5.0)]


def test_toxicity_is_right_on_held_out_rows(spark):
    folder = SMALL.replace("0.001", "0.1")
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    rows = queries.op1_toxicity(spark, folder).join(labels, "doc_id").where("held_out").collect()
    toxic = [r["predicted"] for r in rows if r["toxic"] == 1]
    clean = [r["predicted"] for r in rows if r["toxic"] == 0]
    assert sum(toxic) >= 0.85 * len(toxic)
    assert sum(clean) <= 0.02 * len(clean)


def test_toxicity_without_labels(spark, odd):
    docs, rows = odd
    model = train(docs, _labels(spark).where("toxic = 0"))
    scores = by_id(toxicity(docs, model), "score")
    assert len(scores) == len(rows) and all(0 <= s <= 1 for (s,) in scores.values())


@pytest.mark.parametrize("share", [None, 0.3])
def test_quality(spark, small, odd, share):
    names = ("n_grams", "log_weight", "gumbel_key", "kept")
    for docs, rows in (small, odd):
        marked = {r["doc_id"]: r["quality"] for r in _labels(spark).collect()}
        if docs is odd[0]:
            marked = {d: int(d % 3 > 0) for d in range(0, 160, 2)}
        labels = spark.createDataFrame(list(marked.items()), "doc_id long, quality int")
        found = by_id(quality_sample(docs, labels, share, buckets=500), *names)
        plain = brute.quality(rows, marked, drawn(docs), 500, hashed, share)
        assert found.keys() == plain.keys()
        for d, row in plain.items():
            assert found[d] == pytest.approx(row, rel=1e-9, abs=1e-9)


def test_quality_keeps_good_rows(spark, odd):
    folder = SMALL.replace("0.001", "0.01")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    kept = by_id(quality_sample(docs, labels), "kept")
    marked = by_id(labels, "quality")
    good = [kept[d] for d, (q,) in marked.items() if q == 1]
    bad = [kept[d] for d, (q,) in marked.items() if q == 0]
    assert sum(k for (k,) in good) >= 0.99 * len(good)
    assert sum(k for (k,) in bad) <= 0.1 * len(bad)
    docs, rows = odd
    assert all(k for (k,) in by_id(quality_sample(docs, labels.limit(0)), "kept").values())
    assert quality_sample(docs, labels).count() == len(rows)


def test_kth_largest(spark):
    df = spark.createDataFrame([(float(x % 50),) for x in range(500)], "x double")
    ranked = sorted((float(x % 50) for x in range(500)), reverse=True)
    for k in (1, 10, 11, 250, 500, 900):
        assert kth_largest(df, "x", k) == ranked[min(k, 500) - 1]


@pytest.mark.parametrize("slice_postings", [500_000, 300])
def test_decontaminate(spark, small, odd, slice_postings):
    items = _items(spark)
    told = [tuple(r) for r in items.collect()]
    for docs, rows in (small, odd):
        expected = brute.leaks(rows, told)
        found = leaked_items(docs, items, slice_postings=slice_postings).collect()
        assert {(r["doc_id"], r["item_id"]) for r in found} == expected


def test_decontaminate_finds_parts_of_items(spark):
    words = [f"w{i}" for i in range(40)]
    question, answer = " ".join(words[:34]), " ".join(words[34:])
    items = spark.createDataFrame(
        [(1, question, answer), (2, None, None), (None, "a", "b")],
        "item_id long, question string, answer string",
    )
    filler = " ".join(f"f{i}" for i in range(500))
    texts = [f"{filler} {question} {answer} {filler}", " ".join(words[4:]), " ".join(words[15:]), None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r for r in leaked_items(docs, items).collect()}
    assert found.keys() == {0, 1}
    assert found[0]["score"] == pytest.approx(1) and found[0]["answer_overlap"] == 1


def test_decontaminate_finds_items_without_a_whole_part(spark):
    items, texts, expected = [], [], set()
    for size in range(2, 9):  # shingles of the part that is missing
        for swapped in (False, True):
            k = len(items)
            # The words of the part are rarer than those of the rest, so they weigh more.
            rest = " ".join(f"common{i}" for i in range(4 * size + 4))
            part = " ".join(f"k{k}p{i}" for i in range(size + 4))
            items.append((k, part, rest) if swapped else (k, rest, part))
            texts.append(f"{rest} k{k}end")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    table = spark.createDataFrame(items, "item_id long, question string, answer string")
    grams = lambda text: brute.shingles(text.split())
    for d, text in enumerate(texts):
        for k, question, answer in items:
            parts = [grams(question), grams(answer)]
            both = sum(len(p & grams(text)) for p in parts)
            if 5 * both >= 4 * sum(map(len, parts)):
                expected.add((d, k))
    assert {(k, k) for k in range(len(items))} <= expected
    found = {(r["doc_id"], r["item_id"]) for r in leaked_items(docs, table).collect()}
    assert found == expected


def test_word_table_is_no_dictionary_on_the_driver(small, monkeypatch):
    table = pa.table({"word": ["a", "é", ""], "ids": [b"1234", b"12345678", b""]})
    assert pickle.loads(pickle.dumps(Known(table))) == {"a": b"1234", "é": b"12345678", "": b""}
    sent, send = [], SparkContext.broadcast
    monkeypatch.setattr(SparkContext, "broadcast", lambda context, x: sent.append(x) or send(context, x))
    encoded(small[0], TOKENIZER)
    assert not [x for x in sent if isinstance(x, dict)]
    (known,) = (x for x in sent if isinstance(x, Known))
    assert len(known.table) < 40 * len(pickle.loads(pickle.dumps(known)))


def test_repeats_of_periodic_texts(spark):
    """One piece may have its anchor at several places."""
    random = np.random.default_rng(3)
    rows = []
    for k in range(60):
        period = "".join(random.choice(list("ab c"), random.integers(1, 40)))
        rows.append((k, "".join((period * 20)[: random.integers(50, 300)] for _ in range(3))))
        rows.append((k + 100, rows[random.integers(len(rows))][1][random.integers(9) :] + period))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for settings in ({}, {"group_regions": 2}):
        out = by_id(without_repeats(df, **settings), "n_bytes", "n_removed", "n_spans", "kept_sha256")
        assert out == brute.repeats(rows)


def test_repeats_sort_runs_of_bytes():
    """Edges of a passage that thousands have are sorted as few symbols, also in one group."""
    random = np.random.default_rng(4)
    passage = random.integers(97, 123, 176, dtype=np.uint8).tobytes()
    ends = random.integers(1, 60, 2_000)
    pieces = [(k, 10, passage[: 176 - n], 76) for k, n in enumerate(ends.tolist())]
    runs = Runs(100)
    runs.add(pieces)
    assert len(pieces) <= GROUP_REGIONS
    assert len(runs.text) < sum(len(x[2]) for x in pieces) / 3
    first = {}
    plain = set()
    for doc, start, content, _ in pieces:
        for k in range(len(content) - 99):
            if first.setdefault(content[k : k + 100], doc) != doc:
                plain.update((doc, b) for b in range(start + k, start + k + 100))
    assert {(d, b) for d, f, stop in runs.later() for b in range(f, stop)} == plain
