"""Width of vector columns."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, NumericType, StructField

from labelloom.functions.names import column, fields_of


def num_features_from_schema(field: StructField) -> int | None:
    """Number of features the metadata of a vector column declares, if it does."""
    if not isinstance(field.dataType, VectorUDT):
        return None
    attributes = field.metadata.get("ml_attr", {})
    if "num_attrs" in attributes:
        return int(attributes["num_attrs"])
    if "attrs" in attributes:
        return sum(len(group) for group in attributes["attrs"].values())
    return None


def num_features(df: DataFrame, vector_col: str, first_row: bool = False) -> int | None:
    """Number of features of a vector or numeric array column.

    Taken from the column's metadata, which needs no job, or else from all rows that are not null,
    which must agree; with ``first_row`` the first of them speaks for all. None if there is no
    such row.
    """
    (field,) = fields_of(df, [vector_col])
    declared = num_features_from_schema(field)
    if declared is not None:
        return declared
    values = column(field.name)
    if isinstance(field.dataType, VectorUDT):
        values = vector_to_array(values)
    elif not (isinstance(field.dataType, ArrayType) and isinstance(field.dataType.elementType, NumericType)):
        raise ValueError(
            f"Column {field.name} must be a vector or an array of numbers, "
            f"but got {field.dataType.simpleString()}."
        )
    widths = df.where(column(field.name).isNotNull()).select(F.size(values).alias("width"))
    if first_row:
        first = widths.head()
        return None if first is None else first["width"]
    least, most = widths.agg(F.min("width"), F.max("width")).first()
    if least != most:
        raise ValueError(f"Column {field.name} holds vectors of {least} to {most} features.")
    return most
