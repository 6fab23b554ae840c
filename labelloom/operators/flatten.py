"""Flattening nested structs."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from labelloom.functions.names import is_case_sensitive, quote


def _leaves(schema: StructType, path: tuple[str, ...] = ()) -> Iterator[tuple[str, ...]]:
    for field in schema.fields:
        here = (*path, field.name)
        if isinstance(field.dataType, StructType):
            yield from _leaves(field.dataType, here)
        else:
            yield here


def flattened_columns(
    schema: StructType, separator: str = ".", case_sensitive: bool = False
) -> list[Column]:
    """One column per field that is not a struct, named by its path.

    Arrays and maps are kept whole.
    """
    paths = list(_leaves(schema))
    names = [separator.join(path) for path in paths]
    compared = names if case_sensitive else [n.lower() for n in names]
    repeated = sorted({n for n, c in zip(names, compared) if compared.count(c) > 1})
    if repeated:
        raise ValueError(f"Flattening gives the same column name more than once: {repeated}.")
    return [
        F.col(".".join(quote(part) for part in path)).alias(name)
        for path, name in zip(paths, names)
    ]


def flatten(df: DataFrame, separator: str = ".") -> DataFrame:
    """``df`` with every struct replaced by its fields, at any depth."""
    case_sensitive = is_case_sensitive(df.sparkSession)
    return df.select(*flattened_columns(df.schema, separator, case_sensitive))
