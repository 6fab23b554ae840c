"""Turning a value into the label it stands for, and matching values to labels.

A label is a string. A numeric value stands for the label its cast to string gives, so
``1`` and ``1.0`` are different labels. Casting each row to a string only to look it up is
slow for numbers, so a lookup compares numbers with numbers instead: each dictionary label
is read back as a number of the column's type, and counts only if that number prints as
exactly this label. Both ways find the same label for every value.

Lookup expressions are SQL text: one call to the JVM for a whole expression keeps the time to
put a query together small for tables of very many columns.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DoubleType,
    FloatType,
    IntegralType,
    NumericType,
    StringType,
)

NEGATIVE_ZERO = "-0.0"


def is_float(data_type: DataType) -> bool:
    return isinstance(data_type, (FloatType, DoubleType))


def require_label_type(name: str, data_type: DataType) -> None:
    if not isinstance(data_type, (StringType, NumericType)):
        raise ValueError(
            f"Column {name} is of type {data_type.simpleString()}; labels are strings or numbers."
        )


def require_index_type(name: str, data_type: DataType) -> None:
    if not isinstance(data_type, NumericType):
        raise ValueError(
            f"Column {name} is of type {data_type.simpleString()}; an index is a number."
        )


def label_text(value: Column, data_type: DataType) -> Column:
    """The label of a value when labels are learned: NaN and null have none."""
    if isinstance(data_type, StringType):
        return value
    if is_float(data_type):
        value = F.when(~F.isnan(value), value)
    return value.cast("string")


def value_text(value: str, data_type: DataType) -> str:
    """How the table value ``value`` prints, which is the label that it is looked up by."""
    return value if isinstance(data_type, StringType) else f"CAST({value} AS STRING)"


def value_keys(value: str, data_type: DataType) -> list[str]:
    """What the table value ``value`` is looked up by; the first key is null for a null value."""
    if isinstance(data_type, IntegralType):
        return [f"CAST({value} AS BIGINT)"]
    if is_float(data_type):
        # Spark's joins hold 0.0 and -0.0 to be equal, but they are two labels
        sign = f"CASE WHEN {value} = 0 THEN CAST({value} AS STRING) = '{NEGATIVE_ZERO}' ELSE false END"
        return [value, sign]
    return [value]


def label_keys(data_type: DataType) -> list[str]:
    """The counterpart of :func:`value_keys`, made from the dictionary column ``label``.

    The first key is null for a label that no value of this type prints as.
    """
    if isinstance(data_type, StringType):
        return ["label"]
    kind = "BIGINT" if isinstance(data_type, IntegralType) else data_type.simpleString()
    number = f"try_cast(label AS {kind})"
    keys = [f"CASE WHEN CAST({number} AS STRING) = label THEN {number} END"]
    if is_float(data_type):
        keys.append(f"label = '{NEGATIVE_ZERO}'")
    return keys


def known_label_keys(labels: Sequence[str], data_type: DataType) -> pa.Array | None:
    """The first of :func:`label_keys` for labels held on the driver.

    None for types whose printed form only Spark knows.
    """
    if isinstance(data_type, StringType):
        return pa.array(labels, pa.string())
    if isinstance(data_type, IntegralType):
        return pa.array([int(lb) if _is_long(lb) else None for lb in labels], pa.int64())
    return None


def _is_long(label: str) -> bool:
    """Whether some ``bigint`` prints as ``label``."""
    try:
        number = int(label)
    except ValueError:
        return False
    return str(number) == label and -(2**63) <= number < 2**63
