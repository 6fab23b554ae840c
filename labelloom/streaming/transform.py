"""Running a model over a stream."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import PipelineModel, Transformer
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from labelloom.plans.indexer import LabelIndexerModel


def transform_stream(
    model: Transformer,
    stream: DataFrame,
    output: str,
    checkpoint: str,
    *,
    available_now: bool = False,
    by_batch: bool = False,
    **options: str,
) -> StreamingQuery:
    """Start a query that transforms ``stream`` and appends the result to parquet files.

    Transforming a stream is transforming a table: dictionaries are the static side of a join and
    there is no state. A large dictionary is read from its buckets for each batch, and only the batch
    is dealt out. ``available_now`` stops the query once the present input is read; without it the
    query runs on.

    ``by_batch`` is for small batches and large dictionaries: the labels of a batch are collected
    first, and of the dictionary only their buckets are read and joined by broadcast. Each batch has
    its own folder in the output, so files have a further column ``batch_id`` when they are read; a
    batch that is repeated after a failure replaces its folder.
    """
    if by_batch:

        def write(batch: DataFrame, number: int) -> None:
            batch = batch.persist(StorageLevel.MEMORY_AND_DISK)  # read for its labels, too
            try:
                result = transform_batch(model, batch)
                result.write.mode("overwrite").options(**options).parquet(f"{output}/batch_id={number}")
            finally:
                batch.unpersist()

        writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    else:
        writer = (
            model.transform(stream)
            .writeStream.outputMode("append")
            .format("parquet")
            .options(**options)
            .option("checkpointLocation", checkpoint)
            .option("path", output)
        )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def transform_batch(model: Transformer, batch: DataFrame) -> DataFrame:
    """Transform a small table, reading of large dictionaries only what it needs."""
    for stage in model.stages if isinstance(model, PipelineModel) else [model]:
        if isinstance(stage, LabelIndexerModel):
            stage = stage.for_table(batch)
        batch = stage.transform(batch)
    return batch
