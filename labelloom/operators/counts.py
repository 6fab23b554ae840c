"""How often each label occurs."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StructField

from labelloom.functions.keys import label_text, require_label_type
from labelloom.functions.names import column, fields_of

# tables with more columns are counted column by column, batch by batch
WIDE_COLUMNS = 24
# labels of all columns that a task holds while it counts a wide table
HELD_LABELS = 500_000


def label_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Occurrences of each label of each column, as ``(col_name, label, n)``.

    One pass over ``df`` whatever the number of columns. Labels are counted inside each
    task first, so a label that fills a third of the table still reaches the shuffle as one
    row per task. In a wide table the columns of a batch are counted one after the other, so its rows
    are not made longer.
    """
    fields = list({f.name: f for f in fields_of(df, columns)}.values())
    for field in fields:
        require_label_type(field.name, field.dataType)
    names = F.array(*[F.lit(f.name) for f in fields])
    if len(fields) > WIDE_COLUMNS:
        counts = _batch_counts(df, fields).groupBy("place", "label").agg(F.sum("n").alias("n"))
        return counts.select(F.get(names, F.col("place")).alias("col_name"), "label", "n")
    texts = [label_text(column(f.name), f.dataType) for f in fields]
    if len(fields) == 1:
        labels = df.select(texts[0].alias("label"))
        # a filter on a computed label would compute it twice, so null is counted, as 0, and dropped
        counts = labels.groupBy("label").agg(F.count("label").alias("n")).where("n > 0")
        return counts.select(F.lit(fields[0].name).alias("col_name"), "label", "n")
    # a number is a cheaper grouping key than the name of the column
    labels = df.select(F.posexplode(F.array(*texts)).alias("place", "label"))
    counts = (
        labels.where("label is not null")
        .groupBy("place", "label")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return counts.select(F.get(names, F.col("place")).alias("col_name"), "label", "n")


def _batch_counts(df: DataFrame, fields: list[StructField]) -> DataFrame:
    """``(place, label, n)``: what each task counted, ``place`` being the number of the column."""

    def value(f: StructField) -> Column:
        # whole numbers print the same everywhere; Spark alone knows how it prints the others
        whole = isinstance(f.dataType, IntegralType)
        return column(f.name).cast("bigint") if whole else label_text(column(f.name), f.dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[pa.Array]] = [[] for _ in fields]
        size = 0
        for batch in batches:
            for place, values in enumerate(batch.columns):
                counted = pc.value_counts(values.drop_null())
                held[place].append(counted)
                size += len(counted)
            if size > HELD_LABELS:
                held, size = _merged(held)
                if size > HELD_LABELS // 2:  # mostly different labels: others add them up
                    yield from _told(held)
                    held, size = [[] for _ in fields], 0
        yield from _told(_merged(held)[0])

    values = df.select(*[value(f).alias(f"c{i}") for i, f in enumerate(fields)])
    return values.mapInArrow(run, "place int, label string, n bigint")


def _merged(held: list[list[pa.Array]]) -> tuple[list[list[pa.Array]], int]:
    """Each column's counts added up by label, and how many labels there are in all."""
    out, size = [], 0
    for parts in held:
        if len(parts) > 1:
            table = pa.Table.from_struct_array(pa.chunked_array(parts))
            summed = table.group_by("values").aggregate([("counts", "sum")])
            counts = summed.column("counts_sum").combine_chunks()
            labels = summed.column("values").combine_chunks()
            parts = [pa.StructArray.from_arrays([labels, counts], ["values", "counts"])]
        out.append(parts)
        size += sum(map(len, parts))
    return out, size


def _told(held: list[list[pa.Array]]) -> Iterator[pa.RecordBatch]:
    for place, parts in enumerate(held):
        for counted in parts:
            if len(counted):
                columns = [
                    pa.array([place] * len(counted), pa.int32()),
                    counted.field("values").cast(pa.string()),
                    counted.field("counts").cast(pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["place", "label", "n"])


def label_sets(df: DataFrame, columns: list[str]) -> DataFrame:
    """The distinct labels of each column, as ``(col_name, label)``."""
    return label_counts(df, columns).select("col_name", "label")
