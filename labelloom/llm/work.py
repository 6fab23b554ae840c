"""Tables written between the steps of an operator, and checks of sizes."""

from __future__ import annotations

import ctypes
import functools
import inspect
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is sent to every executor only up to this many rows of a few numbers each (about 8 MB).
BROADCAST_ROWS = 500_000
TEXTS_PER_BATCH = 1_000
_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def folder(spark: SparkSession) -> str:
    """The folder all machines share: ``spark.checkpoint.dir``, else one below the warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return (named or f"{spark.conf.get('spark.sql.warehouse.dir')}/_work").rstrip("/")


def stored(df: DataFrame, name: str, *partitions: str) -> DataFrame:
    """``df`` written to the shared folder and read again: what comes after never repeats what led
    to it, also if executors are lost."""
    spark = df.sparkSession
    path = f"{folder(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").partitionBy(*partitions).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, most: int = TEXTS_PER_BATCH) -> None:
    """Let fewer rows go to Python at a time: whole texts are long, and batches of them are what
    tasks hold most of. A smaller number that the session already has stays."""
    if int(spark.conf.get(_BATCH_ROWS)) > most:
        spark.conf.set(_BATCH_ROWS, most)


def tidy(run: Callable) -> Callable:
    """A task's function that gives the memory it has freed back to the machine when it ends: the
    process goes on to serve other tasks, and what it keeps is missing elsewhere."""

    def give_back() -> None:
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library
        if trim:
            trim(0)

    @functools.wraps(run)
    def of_batches(batches):
        yield from run(batches)
        give_back()

    @functools.wraps(run)
    def of_table(table):
        out = run(table)
        give_back()
        return out

    return of_batches if inspect.isgeneratorfunction(run) else of_table


def documents(df: DataFrame, most: int = TEXTS_PER_BATCH) -> DataFrame:
    """``doc_id`` and ``text`` alone, so that no other column can clash; no text is an empty text. At
    most ``most`` of them go to Python at a time."""
    small_batches(df.sparkSession, most)
    return df.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def only(df: DataFrame, ids: DataFrame, column: str = "doc_id") -> DataFrame:
    """The rows of ``df`` whose ``column`` is in that of ``ids``: by broadcast if those are few, else
    by a shuffled join. ``ids`` is counted, so it should be a stored table."""
    ids = ids.select(column).distinct()
    if ids.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        ids = F.broadcast(ids)
    return df.join(ids, df[column].eqNullSafe(ids[column]), "left_semi")


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, whose ``doc_id`` is not in ``gone``: by broadcast if those
    are few, else by a shuffled join."""
    gone = stored(gone.select(F.col("doc_id").alias("_gone")).distinct(), "gone")
    if gone.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        gone = F.broadcast(gone)
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")
