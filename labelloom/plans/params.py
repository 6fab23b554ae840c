"""Settings shared by the stages."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasInputCols, HasOutputCol, HasOutputCols
from pyspark.sql.types import DoubleType, StructField, StructType

from labelloom.functions.keys import require_label_type
from labelloom.functions.names import (
    find_field,
    is_case_sensitive,
    require_absent,
    require_field,
)
from labelloom.operators.lookup import (
    BROADCAST_BYTES,
    ERROR,
    FROM_TABLE,
    HOT_SOURCES,
    POLICIES,
)
from labelloom.operators.ranking import FREQUENCY_DESC, ORDERS

#: Beside ``ml_attr`` in the metadata of an index column: where a dictionary too long for it is.
POINTER = "labelloom"


def one_of(choices: Sequence[str]) -> Callable[[str], str]:
    def convert(value: str) -> str:
        value = TypeConverters.toString(value)
        if value not in choices:
            raise ValueError(f"{value} is not one of {', '.join(choices)}.")
        return value

    return convert


class InOutParams(HasInputCol, HasOutputCol):
    def setInputCol(self, value: str):
        return self._set(inputCol=value)

    def setOutputCol(self, value: str):
        return self._set(outputCol=value)


class IndexerParams(InOutParams, HasInputCols, HasOutputCols):
    """Settings of the label indexer and of its model."""

    handleInvalid = Param(
        Params._dummy(),
        "handleInvalid",
        "What to do with null and unseen values: 'skip' drops their rows, 'error' stops the "
        "query, 'keep' gives them the index one past the last label.",
        typeConverter=one_of(POLICIES),
    )
    stringOrderType = Param(
        Params._dummy(),
        "stringOrderType",
        f"How to order the labels; the first one gets index 0: {', '.join(ORDERS)}. "
        "Labels of equal frequency are ordered alphabetically.",
        typeConverter=one_of(ORDERS),
    )
    localLabelLimit = Param(
        Params._dummy(),
        "localLabelLimit",
        "A dictionary of at most this many labels is held on the driver; a larger one stays a "
        "table.",
        typeConverter=TypeConverters.toInt,
    )
    metadataLabelLimit = Param(
        Params._dummy(),
        "metadataLabelLimit",
        "At most this many labels are listed in the metadata of an index column, which every file "
        "written from it repeats; for more labels the metadata names a folder with the dictionary.",
        typeConverter=TypeConverters.toInt,
    )
    broadcastLimit = Param(
        Params._dummy(),
        "broadcastLimit",
        "Dictionaries of at most this many bytes together are broadcast, the smallest first; the "
        "others are joined by a shuffle.",
        typeConverter=TypeConverters.toInt,
    )

    hotValues = Param(
        Params._dummy(),
        "hotValues",
        "How to find values of so many rows that a shuffle would bring too many to one task, for a "
        "dictionary that is not broadcast: 'table' makes a sketch of the column when a table (not a "
        "stream) is transformed; 'counts' asks the counts of the dictionary, if it has any, which "
        "takes no pass but knows of no unseen values; 'none' does neither.",
        typeConverter=one_of(HOT_SOURCES),
    )
    checkFirst = Param(
        Params._dummy(),
        "checkFirst",
        "With the policy 'error': look for null and unseen values in a pass of its own when a table "
        "(not a stream) is transformed, and stop at once. Nothing in the plan can fail then, so "
        "later filters reach the files.",
        typeConverter=TypeConverters.toBoolean,
    )

    def _set_defaults(self) -> None:
        self._setDefault(
            handleInvalid=ERROR,
            stringOrderType=FREQUENCY_DESC,
            localLabelLimit=10_000,
            metadataLabelLimit=1_000,
            broadcastLimit=BROADCAST_BYTES,
            hotValues=FROM_TABLE,
            checkFirst=False,
        )

    def getHandleInvalid(self) -> str:
        return self.getOrDefault(self.handleInvalid)

    def getStringOrderType(self) -> str:
        return self.getOrDefault(self.stringOrderType)

    def getLocalLabelLimit(self) -> int:
        return self.getOrDefault(self.localLabelLimit)

    def getMetadataLabelLimit(self) -> int:
        return self.getOrDefault(self.metadataLabelLimit)

    def getBroadcastLimit(self) -> int:
        return self.getOrDefault(self.broadcastLimit)

    def getHotValues(self) -> str:
        return self.getOrDefault(self.hotValues)

    def getCheckFirst(self) -> bool:
        return self.getOrDefault(self.checkFirst)

    def setHotValues(self, value: str):
        return self._set(hotValues=value)

    def setCheckFirst(self, value: bool):
        return self._set(checkFirst=value)

    def setInputCols(self, value: list[str]):
        return self._set(inputCols=value)

    def setOutputCols(self, value: list[str]):
        return self._set(outputCols=value)

    def setHandleInvalid(self, value: str):
        return self._set(handleInvalid=value)

    def setLocalLabelLimit(self, value: int):
        return self._set(localLabelLimit=value)

    def setMetadataLabelLimit(self, value: int):
        return self._set(metadataLabelLimit=value)

    def setBroadcastLimit(self, value: int):
        return self._set(broadcastLimit=value)

    def in_out_columns(self) -> tuple[list[str], list[str]]:
        """The input and the output columns, pair by pair."""
        single = self.isSet(self.inputCol)
        several = self.isSet(self.inputCols)
        if single == several:
            raise ValueError("Set exactly one of inputCol and inputCols.")
        needed, other = ("outputCol", "outputCols") if single else ("outputCols", "outputCol")
        if not self.isSet(needed) or self.isSet(other):
            given = "inputCol" if single else "inputCols"
            raise ValueError(f"With {given}, set {needed} and not {other}.")
        if single:
            inputs, outputs = [self.getInputCol()], [self.getOutputCol()]
        else:
            inputs, outputs = list(self.getInputCols()), list(self.getOutputCols())
        if len(inputs) != len(outputs):
            raise ValueError(f"{len(inputs)} input columns need as many outputs, not {len(outputs)}.")
        return inputs, outputs

    def check_columns(
        self, schema: StructType, allow_missing: bool = False
    ) -> list[tuple[StructField | None, str]]:
        """Each input column (None if it may be and is missing) with its output name."""
        inputs, outputs = self.in_out_columns()
        case_sensitive = is_case_sensitive()
        compared = outputs if case_sensitive else [o.lower() for o in outputs]
        if len(set(compared)) < len(compared):
            raise ValueError("Two outputs have the same name.")
        pairs = []
        for name, output in zip(inputs, outputs):
            find = find_field if allow_missing else require_field
            field = find(schema, name, case_sensitive)
            if field is not None:
                require_label_type(field.name, field.dataType)
                require_absent(schema, output, case_sensitive)
            pairs.append((field, output))
        return pairs

    def indexed_schema(self, schema: StructType, allow_missing: bool) -> StructType:
        pairs = self.check_columns(schema, allow_missing)
        return StructType(
            schema.fields
            + [
                StructField(out, DoubleType(), metadata=nominal_metadata(out))
                for field, out in pairs
                if field is not None
            ]
        )


def nominal_metadata(name: str, values: Sequence[str] | None = None) -> dict:
    attribute = {"type": "nominal", "name": name}
    if values is not None:
        attribute["vals"] = list(values)
    return {"ml_attr": attribute}
