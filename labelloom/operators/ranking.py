"""Numbering the labels of each column in a chosen order."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelloom.functions import sql

FREQUENCY_DESC = "frequencyDesc"
FREQUENCY_ASC = "frequencyAsc"
ALPHABET_DESC = "alphabetDesc"
ALPHABET_ASC = "alphabetAsc"
ORDERS = (FREQUENCY_DESC, FREQUENCY_ASC, ALPHABET_DESC, ALPHABET_ASC)

# a 64-bit id made by monotonically_increasing_id holds the partition above this many bits
_POSITION_BITS = 33


def sort_keys(order: str) -> list[Column]:
    """Sort keys of a label order; labels of equal frequency go alphabetically in both."""
    return {
        FREQUENCY_DESC: [F.desc("n"), F.asc("label")],
        FREQUENCY_ASC: [F.asc("n"), F.asc("label")],
        ALPHABET_DESC: [F.desc("label")],
        ALPHABET_ASC: [F.asc("label")],
    }[order]


def rank_by_window(counts: DataFrame, order: str) -> DataFrame:
    """Number the labels with one window per column, as ``(col_name, label, n, idx)``.

    The labels of a column meet in one task: for columns known to have few.
    """
    by_column = Window.partitionBy("col_name").orderBy(*sort_keys(order))
    idx = (F.row_number().over(by_column) - 1).cast("double")
    return counts.select("col_name", "label", "n", idx.alias("idx"))


@contextmanager
def ranked_by_range(counts: DataFrame, order: str) -> Iterator[DataFrame]:
    """The labels of columns that may have any number of them, numbered as ``(col_name, label, n,
    idx)``; to be used once, inside the block.

    All labels are sorted across the cluster. The number of a label is its position in its partition
    plus the number of labels its column has in earlier partitions. Only these offsets, about one per
    partition, come to the driver, and they go back as part of an expression.
    """
    place = F.monotonically_increasing_id()
    placed = (
        counts.orderBy("col_name", *sort_keys(order))
        .withColumn("place", place)
        .select(
            "col_name",
            "label",
            "n",
            F.shiftright("place", _POSITION_BITS).cast("int").alias("part"),
            F.col("place").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)).alias("pos"),
        )
        # sorted once: the positions that are counted are those that are written
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    try:
        runs = placed.groupBy("col_name", "part").agg(
            F.count(F.lit(1)).alias("size"), F.min("pos").alias("first")
        )
        idx = (F.col("pos") + _shift(runs.toArrow())).cast("double")
        yield placed.select("col_name", "label", "n", idx.alias("idx"))
    finally:
        placed.unpersist()


def _shift(runs: pa.Table) -> Column:
    """What to add to a position, from ``(col_name, part, size, first)``."""
    shifts: dict[str, tuple[int, list[int]]] = {}
    earlier = 0
    for run in runs.sort_by([("col_name", "ascending"), ("part", "ascending")]).to_pylist():
        if run["col_name"] not in shifts:
            shifts[run["col_name"]], earlier = (run["part"], []), 0
        start, own = shifts[run["col_name"]]
        # a partition between two of the same column may be empty
        own += [0] * (run["part"] - start - len(own)) + [earlier - run["first"]]
        earlier += run["size"]
    shift = F.lit(0)
    for name, (start, own) in shifts.items():
        found = F.expr(f"get({sql.array(own, 'bigint')}, part - {start})")
        shift = F.when(F.col("col_name") == F.lit(name), found).otherwise(shift)
    return shift
