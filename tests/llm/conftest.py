from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelloom.llm.quality import SEED
from labelloom.llm.words import WITH_SIGNS, Hasher, sequences

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def small(spark):
    """The small documents, and the same as a list."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    return docs, [(r["doc_id"], r["text"]) for r in docs.collect()]


@pytest.fixture(scope="session")
def odd(spark):
    """Texts that are null, empty, blank, long, tied or random, with columns whose names clash."""
    rnd = random.Random(7)
    signs = ["a", "b", "1", ".", "@", "+", "-", " ", "(", "é", "😀", "token=", "AKIA", "é x\n", "12 34"]
    texts = [None, "", " \n\t", "x", "A b", "a  B", "a b c d e", "word " * 20_000, "a" * 50_000, "ab" * 300]
    texts += ["a b c d e f g h i j k l m n o p q r s t", "a b c d e f g h i j k l m n o p q r s T u"]
    texts += ["1 " * 3_000, "a@" * 500, "1.2.3.4" * 100, "4111 1111 1111 1111", "AKIA" + "A1" * 8]
    texts += ['TOKEN = "abcdef0123456789"', "ſecret=abcdefghijklmnop", "<|endoftext|> a's ΑΣ İ"]
    texts += ["".join(rnd.choice(signs) for _ in range(rnd.randrange(60))) for _ in range(150)]
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    names = ["id", "doc", "kept", "keep_id", "score", "words", "key", "packed", "digest", "n", "source"]
    for name in names:
        df = df.withColumn(name, F.lit(None).cast("string"))
    return df, rows


@pytest.fixture(scope="session")
def repeated(spark):
    """A table in which every row is there twice, ``doc_id`` null for one of them."""
    text = "one two three four five six seven eight nine ten " * 5
    rows = [(1, "a b c"), (2, text), (None, "no id"), (3, text + "end")]
    return spark.createDataFrame(rows * 2, "doc_id long, text string").withColumn("source", F.lit("s"))


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, source string")


def by_id(df, *columns):
    """The rows as a dictionary from ``doc_id`` to the tuple of ``columns``."""
    names = columns or [c for c in df.columns if c != "doc_id"]
    return {r["doc_id"]: tuple(r[c] for c in names) for r in df.collect()}


def hashed(first, second=None):
    """The hash of a word, or of two hashes, by the operators' own hasher."""
    if second is not None:
        return int(sequences(np.array([first, second], dtype=np.uint64), 2)[0])
    data = np.frombuffer(first, dtype=np.uint8)
    return int(Hasher(WITH_SIGNS).words(data, np.array([0, len(data)]))[2][0])


def drawn(docs, seed=SEED):
    """The uniform variates of documents."""
    uniform = (F.pmod(F.xxhash64(F.col("doc_id").cast("long"), F.lit(seed)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    return {r[0]: r[1] for r in docs.select("doc_id", uniform).collect()}
