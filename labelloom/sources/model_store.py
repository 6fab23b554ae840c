"""Saving and loading fitted models.

A saved model is a folder: ``metadata`` holds the settings, ``data`` the dictionaries. Three
layouts of ``data`` are read, told apart by their columns:

- ``(column, label, n, idx)``: one row per label, for dictionaries of any size; ``column`` is the
  number of the input column;
- ``labelsArray array<array<string>>``: a single row, with ``countsArray`` beside it if we wrote it;
- ``labels array<string>``: a single row for a single column, as written before Spark 3.

The first one is written unless ``option("layout", "labelsArray")`` asks for the second.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReader, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.plans.dictionary import (
    ColumnDictionary,
    collect_dictionaries,
    glance,
    labels_table,
    local_table,
    split_dictionaries,
    stored_dictionaries,
    summarize,
)

TABLE_LAYOUT = "table"
ARRAY_LAYOUT = "labelsArray"


class ModelWriter(MLWriter):
    def __init__(self, model):
        super().__init__()
        self.model = model

    def save(self, path: str) -> None:
        inside = f"{path.rstrip('/')}/data/"
        stored = [d.stored for d in self.model.dictionaries if d.labels is None]
        if any(inside in file for table in stored for file in table.inputFiles()):
            raise ValueError(f"This model reads its dictionaries from {path}; save it elsewhere.")
        super().save(path)

    def saveImpl(self, path: str) -> None:
        layout = self.optionMap.get("layout", TABLE_LAYOUT)
        if layout.lower() == ARRAY_LAYOUT.lower():
            # counts are in a column of their own, which other readers of this layout ignore
            dictionaries = self.model.local_dictionaries()
            counts = [list(d.counts or [None] * d.size) for d in dictionaries]
            data = local_table(
                self.sparkSession,
                labelsArray=pa.array(
                    [[list(d.labels) for d in dictionaries]], pa.list_(pa.list_(pa.string()))
                ),
                countsArray=pa.array([counts], pa.list_(pa.list_(pa.int64()))),
            )
        elif layout == TABLE_LAYOUT:
            data = self._dictionary_rows()
        else:
            raise ValueError(f"Unknown layout {layout}.")
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        data.write.parquet(f"{path}/data")

    def _dictionary_rows(self) -> DataFrame:
        """All dictionaries as one table; those on the driver make up a single part of it."""
        numbered = list(enumerate(self.model.dictionaries))
        few = [(str(i), d) for i, d in numbered if d.labels is not None]
        data = labels_table(self.sparkSession, "column", few)
        for i, dictionary in numbered:
            if dictionary.labels is None:
                data = data.unionByName(
                    dictionary.stored.select(F.lit(str(i)).alias("column"), "label", "n", "idx")
                )
        return data


class ModelReader(MLReader):
    def __init__(self, model_class: type):
        super().__init__()
        self.model_class = model_class

    def load(self, path: str):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        rows = self._label_rows(self.sparkSession.read.parquet(f"{path}/data"))
        model = self.model_class()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        count = len(model.in_out_columns()[0])
        model.dictionaries = self._dictionaries(rows, count, model.getLocalLabelLimit())
        return model

    @staticmethod
    def _label_rows(data: DataFrame) -> DataFrame:
        """The saved dictionaries as ``(col_name, label, n, idx)``, named by their number."""
        if "label" in data.columns:
            return data.select(F.col("column").alias("col_name"), "label", "n", "idx")
        if "labelsArray" in data.columns:
            counted = "countsArray" in data.columns
            counts = F.get("countsArray", "column") if counted else F.lit(None)
            arrays = data.select("*", F.posexplode("labelsArray").alias("column", "labels"))
            arrays = arrays.select("column", "labels", counts.cast("array<bigint>").alias("counts"))
        elif "labels" in data.columns:
            none = F.lit(None).cast("array<bigint>")
            arrays = data.select(F.lit(0).alias("column"), "labels", none.alias("counts"))
        else:
            raise ValueError(f"No dictionary in columns {data.columns}.")
        labels = arrays.select("column", "counts", F.posexplode("labels").alias("idx", "label"))
        return labels.select(
            F.col("column").cast("string").alias("col_name"),
            "label",
            F.get("counts", "idx").alias("n"),
            F.col("idx").cast("double").alias("idx"),
        )

    @staticmethod
    def _dictionaries(rows: DataFrame, count: int, local_limit: int) -> list[ColumnDictionary]:
        few = glance(rows, [F.asc("idx")], local_limit)
        if few is not None:
            loaded = split_dictionaries(few)
        else:
            found = summarize(rows, given=True)
            local = [c for c in found if found[c]["size"] <= local_limit]
            loaded = stored_dictionaries(rows, {c: found[c] for c in found if c not in local})
            if local:
                loaded |= collect_dictionaries(rows.where(F.col("col_name").isin(local)))
        return [loaded.get(str(i), ColumnDictionary.of_labels([])) for i in range(count)]
