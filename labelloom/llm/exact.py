"""Exact deduplication by Grace hashing.

Texts are equal when they are identical after deleting the characters ``[\\x20\\x09-\\x0D]``.

1. One scan takes a SHA-256 digest of each normalised text. Unequal digests prove unequal texts, so
   a document with a digest of its own is done; its text is never moved.
2. The others are read again. Each task collapses equal texts in an open-addressing table (Python's
   ``dict``, which compares complete contents), so a text that fills a third of the corpus leaves a
   task once. The table is emptied when it is full; what it then misses is found below.
3. What is left is partitioned by a hash of the digest, and too large buckets again by another hash,
   until the distinct texts of each fit one table. Every bucket then goes through such a table.

A class is joined back through the representative of its task, so no join has a key with more rows
than a task reads. A null text is an empty text. Rows with the same ``doc_id`` and equal texts stay
or go together and are all counted. A null ``doc_id`` comes last in ties. No input: no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.llm.work import documents, only, stored, tidy

#: Bytes of distinct text in one table.
TABLE_BYTES = 64 << 20
#: Parts a too large bucket is dealt into.
FAN_OUT = 16

_SPACES = bytes([0x20, *range(0x09, 0x0E)])


def _normalised(batch: pa.RecordBatch) -> list[bytes]:
    texts = batch.column(batch.schema.get_field_index("text")).cast(pa.binary())
    return [t.as_py().translate(None, _SPACES) for t in texts]


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = _normalised(batch)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(2),
                pa.array([len(t) for t in texts], pa.int64()),
                pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()),
            ],
            ["doc_id", "n_chars", "n_bytes", "digest"],
        )


def _collapse(table_bytes: int):
    """Rows as they come, each with the first row of its text in this table (``first_id``); only
    that row keeps its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table: dict[bytes, int | None] = {}
        held = 0
        for batch in batches:
            firsts, digests, contents = [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), _normalised(batch), strict=True):
                new = text not in table
                if new:
                    if held + len(text) > table_bytes:
                        table, held = {}, 0
                    table[text] = doc_id
                    held += len(text)
                firsts.append(table[text])
                digests.append(hashlib.sha256(text).digest())
                contents.append(text if new else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array(firsts, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(contents, pa.binary()),
                ],
                ["doc_id", "n_chars", "first_id", "digest", "content"],
            )

    return tidy(run)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the rows of one bucket after another, the class of each (numbered in its digest)."""
    bucket, table, numbers = None, {}, {}
    for batch in batches:
        classes = []
        for b, digest, content in zip(
            *(batch.column(k).to_pylist() for k in ("bucket", "digest", "content")), strict=True
        ):
            if b != bucket:
                bucket, table, numbers = b, {}, {}
            if content not in table:
                table[content] = numbers[digest] = numbers.get(digest, -1) + 1
            classes.append(table[content])
        yield pa.RecordBatch.from_arrays(
            [batch.column("first_id"), batch.column("digest"), pa.array(classes, pa.int32())],
            ["first_id", "digest", "class"],
        )


def bucket_of(contents: DataFrame, table_bytes: int, fan_out: int = FAN_OUT) -> DataFrame:
    """``(digest, bucket)`` for the rows ``(digest, n_bytes)``: a bucket's sum of ``n_bytes`` is at
    most ``table_bytes``, unless it has one digest alone."""
    total = contents.agg(F.sum("n_bytes")).first()[0] or 0
    start = 2 * total // table_bytes + 1
    level = lambda k, n: F.pmod(F.xxhash64("digest", F.lit(k)), F.lit(n)).cast("string")
    placed = contents.select("digest", "n_bytes", level(0, start).alias("bucket"))
    for k in range(1, 64):
        sizes = placed.groupBy("bucket").agg(
            F.sum("n_bytes").alias("size"), F.count("*").alias("digests")
        )
        large = sizes.where((F.col("size") > table_bytes) & (F.col("digests") > 1))
        if large.isEmpty():
            break
        again = F.concat_ws(".", "bucket", level(k, fan_out))
        placed = stored(
            placed.join(large, "bucket", "left").select(
                "digest",
                "n_bytes",
                F.when(F.col("size").isNull(), F.col("bucket")).otherwise(again).alias("bucket"),
            ),
            "buckets",
        )
    return placed.select("digest", "bucket")


def exact_groups(docs: DataFrame, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)`` for every row of ``docs``: the row with
    the most code points, then the smallest ``doc_id``, stays of each group of equal texts."""
    docs = documents(docs).withColumn("n_chars", F.char_length("text").cast("long"))
    digests = stored(
        docs.mapInArrow(tidy(_digests), "doc_id long, n_chars long, n_bytes long, digest binary"),
        "digests",
    )
    repeated = stored(
        digests.groupBy("digest")
        .agg(F.count("*").alias("n"), F.max("n_bytes").alias("n_bytes"))
        .where("n > 1")
        .select("digest", "n_bytes"),
        "repeated",
    )
    again = digests.join(repeated.select("digest"), "digest", "left_semi").select("doc_id")
    rows = stored(
        only(docs, stored(again, "again")).mapInArrow(
            _collapse(table_bytes),
            "doc_id long, n_chars long, first_id long, digest binary, content binary",
        ),
        "collapsed",
    )
    buckets = bucket_of(repeated, table_bytes)
    classes = stored(
        rows.where("content IS NOT NULL")
        .join(buckets, "digest")
        .select("first_id", "digest", "content", "bucket")
        .repartition("bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(tidy(_compare), "first_id long, digest binary, class int")
        .distinct(),
        "classes",
    )
    # Sums by the first row in a task, then by class: each key has few rows at either step.
    best = F.struct(F.col("n_chars"), F.col("doc_id").isNotNull(), -F.col("doc_id")).alias("best")
    firsts = rows.groupBy("first_id", "digest").agg(F.count("*").alias("n"), F.max(best).alias("best"))
    same = lambda a, b: a["first_id"].eqNullSafe(b["first_id"]) & (a["digest"] == b["digest"])
    named = firsts.join(classes, same(firsts, classes)).select(
        firsts["first_id"], firsts["digest"], "class", "n", "best"
    )
    groups = (
        named.groupBy("digest", "class")
        .agg(F.sum("n").alias("group_size"), F.max("best").alias("best"))
        .select("digest", "class", "group_size", (-F.col("best.col3")).alias("keep_id"))
    )
    by_first = classes.join(groups, ["digest", "class"]).drop("class")
    members = rows.select("doc_id", "first_id", "digest").distinct()
    found = (
        members.join(by_first, same(members, by_first))
        .groupBy(members["doc_id"].alias("id"), members["digest"].alias("key"))
        .agg(F.max("keep_id").alias("keep_id"), F.max("group_size").alias("group_size"))
    )
    return digests.join(
        found, digests["doc_id"].eqNullSafe(F.col("id")) & (F.col("digest") == F.col("key")), "left"
    ).select(
        "doc_id",
        F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.when(F.col("key").isNull(), True)
        .otherwise(F.col("doc_id").eqNullSafe(F.col("keep_id")))
        .alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
