"""Column names: finding, quoting and unquoting them.

A column may be called ``location.longitude``: one name with a dot in it, not a
field of a struct. Callers may write such a name bare or in backticks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType


def quote(name: str) -> str:
    """``name`` in backticks, so that Spark reads it as one column name."""
    return "`" + name.replace("`", "``") + "`"


def unquote(name: str) -> str:
    """Undo :func:`quote`; a name that is not quoted comes back unchanged."""
    if len(name) > 1 and name[0] == name[-1] == "`":
        return name[1:-1].replace("``", "`")
    return name


def column(name: str) -> Column:
    """The top-level column called exactly ``name``."""
    return F.col(quote(name))


def is_case_sensitive(spark: SparkSession | None = None) -> bool:
    spark = spark or SparkSession.active()
    return spark.conf.get("spark.sql.caseSensitive", "false") == "true"


def same_name(a: str, b: str, case_sensitive: bool) -> bool:
    return a == b if case_sensitive else a.lower() == b.lower()


def find_field(schema: StructType, name: str, case_sensitive: bool = False) -> StructField | None:
    """The field ``name`` refers to, or None.

    The name is tried as it stands and then without its backticks; an exact match wins
    over one that differs in case.
    """
    for wanted in dict.fromkeys([name, unquote(name)]):
        for field in schema.fields:
            if field.name == wanted:
                return field
        if case_sensitive:
            continue
        found = [f for f in schema.fields if f.name.lower() == wanted.lower()]
        if len(found) > 1:
            raise ValueError(f"Column name {name} is ambiguous: {[f.name for f in found]}.")
        if found:
            return found[0]
    return None


def require_field(schema: StructType, name: str, case_sensitive: bool = False) -> StructField:
    field = find_field(schema, name, case_sensitive)
    if field is None:
        raise ValueError(f"Column {unquote(name)} does not exist.")
    return field


def require_absent(schema: StructType, name: str, case_sensitive: bool = False) -> None:
    if any(same_name(f.name, name, case_sensitive) for f in schema.fields):
        raise ValueError(f"Output column {name} already exists.")


def fields_of(df: DataFrame, names: list[str]) -> list[StructField]:
    """The fields of ``df`` behind ``names``, each of which must exist."""
    case_sensitive = is_case_sensitive(df.sparkSession)
    schema = df.schema
    return [require_field(schema, n, case_sensitive) for n in names]
