"""Label indexing as stages of a ``pyspark.ml.Pipeline``."""

from __future__ import annotations

import logging
import warnings
from collections.abc import Sequence
from functools import reduce

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable, MLReadable, MLWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from labelloom.functions.keys import require_index_type, value_text
from labelloom.functions.names import (
    fields_of,
    is_case_sensitive,
    quote,
    require_absent,
    unquote,
)
from labelloom.operators.inverse import label_column
from labelloom.operators.lookup import (
    ERROR,
    KEEP,
    NULL_MESSAGE,
    UNKNOWN,
    UNSEEN_ADVICE,
    UNSEEN_MESSAGE,
    index_column,
)
from labelloom.plans.dictionary import ColumnDictionary, labels_table, learn_dictionaries
from labelloom.plans.params import POINTER, IndexerParams, nominal_metadata
from labelloom.sources.model_store import ModelReader, ModelWriter

logger = logging.getLogger(__name__)


class LabelIndexer(Estimator, IndexerParams, DefaultParamsReadable, DefaultParamsWritable):
    """Learns a dictionary of labels for one or several string or numeric columns."""

    @keyword_only
    def __init__(
        self,
        *,
        inputCol: str | None = None,
        outputCol: str | None = None,
        inputCols: list[str] | None = None,
        outputCols: list[str] | None = None,
        handleInvalid: str | None = None,
        stringOrderType: str | None = None,
        localLabelLimit: int | None = None,
        metadataLabelLimit: int | None = None,
        broadcastLimit: int | None = None,
        hotValues: str | None = None,
        checkFirst: bool | None = None,
    ):
        super().__init__()
        self._set_defaults()
        self._set(**self._input_kwargs)

    def setStringOrderType(self, value: str) -> LabelIndexer:
        return self._set(stringOrderType=value)

    def transformSchema(self, schema: StructType) -> StructType:
        return self.indexed_schema(schema, allow_missing=False)

    def _fit(self, dataset: DataFrame) -> LabelIndexerModel:
        fields = [field for field, _ in self.check_columns(dataset.schema)]
        learned = learn_dictionaries(
            dataset,
            [field.name for field in fields],
            self.getStringOrderType(),
            self.getLocalLabelLimit(),
        )
        model = LabelIndexerModel([learned[field.name] for field in fields])
        model._resetUid(self.uid)
        return self._copyValues(model)


class LabelIndexerModel(Model, IndexerParams, MLReadable, MLWritable):
    """Replaces labels by indices, with one dictionary per input column.

    An input column that is missing when a table is transformed is left out; if all are
    missing, the table stays as it is.
    """

    def __init__(self, dictionaries: Sequence[ColumnDictionary] = ()):
        super().__init__()
        self._set_defaults()
        self.dictionaries = list(dictionaries)

    @classmethod
    def from_labels(cls, labels: Sequence[str], **settings) -> LabelIndexerModel:
        """A model for one column whose labels are known: position in the list = index."""
        return cls.from_arrays_of_labels([labels], **settings)

    @classmethod
    def from_arrays_of_labels(
        cls, arrays: Sequence[Sequence[str]], uid: str | None = None, **settings
    ) -> LabelIndexerModel:
        """A model for several columns, from one list of labels for each."""
        model = cls([ColumnDictionary.of_labels(labels) for labels in arrays])
        if uid is not None:
            model._resetUid(uid)
        return model._set(**settings)

    def dictionary_table(self) -> DataFrame:
        """All dictionaries as one table ``(col_name, label, n, idx)``."""
        spark = SparkSession.active()
        named = list(zip(map(unquote, self.in_out_columns()[0]), self.dictionaries))
        local = [(name, d) for name, d in named if d.labels is not None]
        tables = [
            d.stored.select(F.lit(name).alias("col_name"), "label", "n", "idx")
            for name, d in named
            if d.labels is None
        ]
        if local or not tables:
            tables.append(labels_table(spark, "col_name", local))
        return reduce(DataFrame.unionByName, tables)

    def num_labels(self) -> list[int]:
        return [dictionary.size for dictionary in self.dictionaries]

    def local_dictionaries(self, limit: int | None = None) -> list[ColumnDictionary]:
        """The dictionaries, with those of at most ``limit`` labels held on the driver."""
        limit = self.getLocalLabelLimit() if limit is None else limit
        found = []
        for name, dictionary in zip(self.in_out_columns()[0], self.dictionaries):
            if dictionary.size > limit:
                raise ValueError(
                    f"Column {name} has {dictionary.size} labels and the limit is {limit}. Raise it, "
                    "or use dictionary_table()."
                )
            found.append(dictionary.on_driver())
        return found

    def labels_array(self, limit: int | None = None) -> list[list[str]]:
        """The labels of each column in the order of their indices, as lists; an error if there are
        more than ``limit``, or than ``localLabelLimit`` if none is given."""
        return [list(dictionary.labels) for dictionary in self.local_dictionaries(limit)]

    @property
    def labelsArray(self) -> list[list[str]]:
        return self.labels_array()

    @property
    def labels(self) -> list[str]:
        """The labels of the only column; deprecated in favour of :meth:`labels_array`."""
        warnings.warn("Use labels_array() instead of labels.", FutureWarning, stacklevel=2)
        if len(self.dictionaries) != 1:
            raise ValueError("This model is for several columns. Use labels_array() instead.")
        return self.labels_array()[0]

    def transformSchema(self, schema: StructType) -> StructType:
        return self.indexed_schema(schema, allow_missing=True)

    def _metadata(self, output: str, i: int) -> dict:
        """Lists the labels, or tells where they are if there are too many to be listed."""
        dictionary = self.dictionaries[i]
        if dictionary.size > self.getMetadataLabelLimit():
            dictionary = self.dictionaries[i] = dictionary.in_folder(SparkSession.active())
            told = dictionary.pointer() | {"with_unknown": self.getHandleInvalid() == KEEP}
            return nominal_metadata(output) | {POINTER: told}
        labels = list(dictionary.on_driver().labels)
        if self.getHandleInvalid() == KEEP:
            if UNKNOWN in labels:
                logger.warning("%s is also one of the labels of %s.", UNKNOWN, output)
            labels.append(UNKNOWN)
        return nominal_metadata(output, labels)

    def in_buckets(self) -> LabelIndexerModel:
        """The same model with its large dictionaries in buckets, as they are after a fit: for one
        that was loaded and will be used many times."""
        spark = SparkSession.active()
        model = self.copy()
        model.dictionaries = [d.in_buckets(spark) for d in self.dictionaries]
        return model

    def for_table(self, table: DataFrame, most_labels: int = 10_000) -> LabelIndexerModel:
        """The same model for this small table alone, such as a batch of a stream.

        The labels of the table are collected first, as hashes. Of a dictionary in buckets only those
        entries are read then, from the buckets they are in, and they are few enough for a broadcast.
        A column with more than ``most_labels`` different labels uses the whole dictionary.
        """
        dictionaries = list(self.dictionaries)
        for i, (field, _) in enumerate(self.check_columns(table.schema, allow_missing=True)):
            large = dictionaries[i].entry_bytes > self.getBroadcastLimit()
            if field is None or not dictionaries[i].buckets or not large:
                continue
            label = value_text(quote(field.name), field.dataType)
            label_hashes = table.selectExpr(f"xxhash64({label}) AS hash", f"octet_length({label}) AS size")
            own = label_hashes.where("size IS NOT NULL").groupBy("hash").agg(F.max("size").alias("size"))
            found = own.limit(most_labels + 1).collect()
            if len(found) <= most_labels:
                sizes = sum(r["size"] for r in found)
                dictionaries[i] = dictionaries[i].only([r["hash"] for r in found], sizes)
        model = self.copy()
        model.dictionaries = dictionaries
        return model

    def _looked_up(self, dataset: DataFrame, pairs: list, checked: bool):
        """The table with all that was looked up, the value of each output by its number, and the
        helper columns."""
        table = dataset
        values, helpers = {}, []
        to_broadcast = self.getBroadcastLimit()
        # small dictionaries first: more of them can be broadcast, and what they drop under 'skip'
        # need not be shuffled for the others
        for i in sorted(range(len(pairs)), key=lambda i: self.dictionaries[i].entry_bytes):
            field, _ = pairs[i]
            if field is None:
                continue
            found = index_column(
                table,
                field,
                self.dictionaries[i],
                self.getHandleInvalid(),
                tag=f"__labelloom_{i}",
                broadcast_bytes=to_broadcast,
                hot_source=self.getHotValues(),
                checked=checked,
            )
            to_broadcast -= found.broadcast_bytes
            table = found.table
            helpers += found.helpers
            values[i] = found.value
        return table, values, helpers

    def _check(self, table: DataFrame, pairs: list, values: dict[int, str]) -> None:
        """Stop if a value of ``table`` was not found."""
        totals = []
        for i, value in values.items():
            name = quote(pairs[i][0].name)
            bad = f"{value} IS NULL"
            totals += [
                F.expr(f"count_if({bad} AND {name} IS NULL)"),
                F.expr(f"min(CASE WHEN {bad} THEN CAST({name} AS STRING) END)"),
            ]
        found = table.agg(*totals).first()
        for nulls, unseen in zip(found[::2], found[1::2], strict=True):
            if unseen is not None:
                raise ValueError(f"{UNSEEN_MESSAGE}{unseen}{UNSEEN_ADVICE}")
            if nulls:
                raise ValueError(NULL_MESSAGE)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        pairs = self.check_columns(dataset.schema, allow_missing=True)
        if len(pairs) != len(self.dictionaries):
            raise ValueError(
                f"The model has dictionaries for {len(self.dictionaries)} columns, "
                f"but {len(pairs)} input columns are set."
            )
        for name, (field, output) in zip(self.in_out_columns()[0], pairs):
            if field is None:
                logger.warning("Column %s does not exist; %s is left out.", name, output)
        checked = self.getHandleInvalid() == ERROR and self.getCheckFirst() and not dataset.isStreaming
        table, values, helpers = self._looked_up(dataset, pairs, checked)
        if not values:
            return dataset
        if checked:
            self._check(table, pairs, values)
        outputs = {
            output: F.expr(values[i]).alias(output, metadata=self._metadata(output, i))
            for i, (_, output) in enumerate(pairs)
            if i in values
        }
        return table.withColumns(outputs).drop(*helpers)

    def inverse_transform(self, dataset: DataFrame, outputs: dict[str, str]) -> DataFrame:
        """Turn index columns made by this model back into labels.

        ``outputs`` names the new column for each index column. Unlike a conversion by the
        metadata of the index column, this works for dictionaries of any size.
        """
        _, index_names = self.in_out_columns()
        fields = fields_of(dataset, list(outputs))
        case_sensitive = is_case_sensitive(dataset.sparkSession)
        table = dataset
        labels, helpers = {}, []
        to_broadcast = self.getBroadcastLimit()
        for i, (field, output) in enumerate(zip(fields, outputs.values())):
            require_index_type(field.name, field.dataType)
            require_absent(dataset.schema, output, case_sensitive)
            if field.name not in index_names:
                raise ValueError(f"{field.name} is not an output column of this model.")
            found = label_column(
                table,
                field.name,
                self.dictionaries[index_names.index(field.name)],
                tag=f"__labelloom_{i}",
                with_unknown=self.getHandleInvalid() == KEEP,
                broadcast_bytes=to_broadcast,
            )
            to_broadcast -= found.broadcast_bytes
            table = found.table
            helpers += found.helpers
            labels[output] = F.expr(found.value)
        return table.withColumns(labels).drop(*helpers)

    def write(self) -> ModelWriter:
        return ModelWriter(self)

    @classmethod
    def read(cls) -> ModelReader:
        return ModelReader(cls)

    def __repr__(self) -> str:
        inputs, outputs = self.in_out_columns()
        columns = [
            f"{name} -> {output} ({dictionary.size} labels)"
            for name, output, dictionary in zip(inputs, outputs, self.dictionaries)
        ]
        return f"LabelIndexerModel({', '.join(columns)}; {self.getHandleInvalid()})"
