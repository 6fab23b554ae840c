"""Stages for single columns: indices back to labels, and renaming."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from labelloom.functions.keys import require_index_type
from labelloom.functions.names import (
    is_case_sensitive,
    require_absent,
    require_field,
    same_name,
)
from labelloom.operators.inverse import label_column
from labelloom.plans.dictionary import ColumnDictionary
from labelloom.operators.lookup import BROADCAST_BYTES
from labelloom.plans.params import POINTER, InOutParams


class IndexToLabel(Transformer, InOutParams, DefaultParamsReadable, DefaultParamsWritable):
    """Turns a column of indices into the labels they stand for.

    The labels are those given, or else those in the metadata of the index column.
    """

    labels = Param(
        Params._dummy(),
        "labels",
        "The labels in the order of their indices. If there are none, those in the metadata of "
        "the input column are used.",
        typeConverter=TypeConverters.toListString,
    )

    broadcastLimit = Param(
        Params._dummy(),
        "broadcastLimit",
        "A dictionary of at most this many bytes is broadcast; a larger one is joined by a shuffle.",
        typeConverter=TypeConverters.toInt,
    )

    @keyword_only
    def __init__(
        self,
        *,
        inputCol: str | None = None,
        outputCol: str | None = None,
        labels: list[str] | None = None,
        broadcastLimit: int | None = None,
    ):
        super().__init__()
        self._setDefault(broadcastLimit=BROADCAST_BYTES)
        self._set(**self._input_kwargs)

    def setLabels(self, value: list[str]) -> IndexToLabel:
        return self._set(labels=value)

    def getLabels(self) -> list[str]:
        return self.getOrDefault(self.labels)

    def _index_field(self, schema: StructType) -> StructField:
        case_sensitive = is_case_sensitive()
        field = require_field(schema, self.getInputCol(), case_sensitive)
        require_index_type(field.name, field.dataType)
        require_absent(schema, self.getOutputCol(), case_sensitive)
        return field

    def transformSchema(self, schema: StructType) -> StructType:
        self._index_field(schema)
        return StructType([*schema.fields, StructField(self.getOutputCol(), StringType())])

    def _dictionary_for(self, field: StructField, spark: SparkSession) -> tuple[ColumnDictionary, bool]:
        """The dictionary, and whether the index after its last one stands for unknown labels."""
        if self.isDefined(self.labels) and self.getLabels():
            return ColumnDictionary.of_labels(self.getLabels()), False
        values = field.metadata.get("ml_attr", {}).get("vals")
        if values is not None:
            return ColumnDictionary.of_labels(values), False
        told = field.metadata.get(POINTER)
        if told is None:
            raise ValueError(
                f"No labels are set, and the metadata of column {field.name} tells of none."
            )
        return ColumnDictionary.from_folder(spark, told), told["with_unknown"]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        field = self._index_field(dataset.schema)
        dictionary, with_unknown = self._dictionary_for(field, dataset.sparkSession)
        found = label_column(
            dataset,
            field.name,
            dictionary,
            tag="__labelloom",
            with_unknown=with_unknown,
            broadcast_bytes=self.getOrDefault(self.broadcastLimit),
        )
        label = F.expr(found.value).alias(self.getOutputCol())
        return found.table.select("*", label).drop(*found.helpers)


class ColumnRenamer(Transformer, InOutParams, DefaultParamsReadable, DefaultParamsWritable):
    """Renames a column and leaves its position, type and values as they are."""

    @keyword_only
    def __init__(self, *, inputCol: str | None = None, outputCol: str | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _checked_field(self, schema: StructType) -> StructField:
        case_sensitive = is_case_sensitive()
        field = require_field(schema, self.getInputCol(), case_sensitive)
        if not same_name(field.name, self.getOutputCol(), case_sensitive):
            require_absent(schema, self.getOutputCol(), case_sensitive)
        return field

    def transformSchema(self, schema: StructType) -> StructType:
        old = self._checked_field(schema)
        return StructType(
            [
                StructField(self.getOutputCol(), f.dataType, f.nullable, f.metadata)
                if f.name == old.name
                else f
                for f in schema.fields
            ]
        )

    def _transform(self, dataset: DataFrame) -> DataFrame:
        field = self._checked_field(dataset.schema)
        return dataset.withColumnRenamed(field.name, self.getOutputCol())
