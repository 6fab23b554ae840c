"""Pieces of SQL text."""

from __future__ import annotations

import json
from collections.abc import Sequence


def text(value: str) -> str:
    """A SQL literal for a string that holds no quotes, backslashes or dollar signs."""
    if set(value) & set("'\\$"):
        raise ValueError(f"Not a plain text: {value}")
    return f"'{value}'"


def array(values: Sequence[str | int | None], kind: str) -> str:
    """A SQL expression for a list; the optimizer turns it into a literal.

    In JSON any character can be written in ASCII, also those that mean something in SQL.
    """
    listed = json.dumps(list(values)).replace("'", "\\u0027").replace("$", "\\u0024")
    return f"from_json(r'{listed}', 'array<{kind}>')"


def fail(message: str, kind: str) -> str:
    """An expression of type ``kind`` that stops the query with ``message`` when a row reaches it.

    The partition id is never negative, so the test always holds; it is there because the
    optimizer keeps later filters above an expression that depends on the partition, and so
    a bad row stops the query even if a later filter would have removed it.
    """
    return f"CASE WHEN spark_partition_id() >= 0 THEN CAST(raise_error({message}) AS {kind}) END"
