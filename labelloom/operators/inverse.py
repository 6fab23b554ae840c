"""From indices back to labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from labelloom.functions import sql
from labelloom.functions.names import quote
from labelloom.operators.lookup import BROADCAST_BYTES, UNKNOWN, Lookup, join_places
from labelloom.plans.dictionary import ColumnDictionary

ARRAY_LABELS = 1_000
ARRAY_BYTES = 256 << 10


def _in_range(index: str, size: int) -> str:
    """Whether an index, cut to a whole number, lies in ``[0, size)``."""
    # NaN compares greater than any number
    return f"{index} > -1 AND {index} < {size}"


def _checked(index: str, size: int, label: str) -> str:
    """``label`` for an index in range; null for null, and an error for any other."""
    error = sql.fail(f"concat('Unseen index: ', CAST({index} AS STRING))", "STRING")
    return f"CASE WHEN {_in_range(index, size)} THEN {label} WHEN {index} IS NOT NULL THEN {error} END"


def _whole(index: str, size: int, kind: str) -> str:
    """The index as a whole number; outside the range the cast would fail or turn around."""
    return f"CAST(CASE WHEN {_in_range(index, size)} THEN {index} END AS {kind})"


def label_from_list(index: str, labels: Sequence[str]) -> str:
    """The label at position ``index`` of a short list, as an expression."""
    listed = sql.array(labels, "string")
    return _checked(index, len(labels), f"get({listed}, {_whole(index, len(labels), 'INT')})")


def label_column(
    table: DataFrame,
    name: str,
    dictionary: ColumnDictionary,
    *,
    tag: str,
    with_unknown: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
    array_labels: int = ARRAY_LABELS,
) -> Lookup:
    """Look up the label of each index; ``with_unknown`` adds a label after the last one."""
    index = f"CAST({quote(name)} AS DOUBLE)"
    if dictionary.is_listed(array_labels, ARRAY_BYTES):
        labels = [*dictionary.labels, UNKNOWN] if with_unknown else dictionary.labels
        return Lookup(table, label_from_list(index, labels))
    found = join_places(
        table,
        _whole(index, dictionary.size, "BIGINT"),
        dictionary,
        tag=tag,
        broadcast_bytes=broadcast_bytes,
    )
    label = f"coalesce({found.value}, {sql.text(UNKNOWN)})" if with_unknown else found.value
    found.value = _checked(index, dictionary.size + with_unknown, label)
    return found
