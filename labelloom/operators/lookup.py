"""Looking values up in a dictionary, which is an equi-join.

How the join is done depends on the size of the dictionary, which is known:

- a handful of labels: an expression, no join at all;
- up to a limit in bytes: the dictionary is broadcast;
- beyond it: values that hold a noticeable share of all rows are few, whatever the data, so
  these are broadcast, if the limit has room for them; the rows they leave open are joined by a
  hash of the label, and compared with the whole label after. A dictionary that is stored in
  buckets by that hash stays where it is. Rows that have nothing to look up are spread over all
  tasks.

Which values are hot is told by a sketch of the table, which also finds frequent values that no
dictionary has; for a stream, by the counts of the dictionary.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructField

from labelloom.functions import sql
from labelloom.functions.keys import (
    is_float,
    known_label_keys,
    label_keys,
    value_keys,
    value_text,
)
from labelloom.functions.names import column, quote
from labelloom.plans.dictionary import (
    ENTRY_BYTES,
    HASH_BYTES,
    ColumnDictionary,
    local_table,
    shuffle_partitions,
)

ERROR = "error"
KEEP = "keep"
SKIP = "skip"
POLICIES = (SKIP, ERROR, KEEP)

UNKNOWN = "__unknown"

# what tells which values are hot
FROM_TABLE = "table"
FROM_COUNTS = "counts"
NOWHERE = "none"
HOT_SOURCES = (FROM_TABLE, FROM_COUNTS, NOWHERE)

INLINE_LABELS = 32
INLINE_BYTES = 16 << 10
BROADCAST_BYTES = 128 << 20
# a label of up to HOT_LABEL_BYTES is hot if it holds at least one row in HOT_SHARE, a longer one
# if it holds as much more as it is longer: so all hot labels together take HOT_SHARE times
# HOT_LABEL_BYTES at most, whatever the data
HOT_SHARE = 10_000
HOT_LABEL_BYTES = 1_024
# a sketch of the table finds values that hold one row in TABLE_SHARE or more
TABLE_SHARE = 1_000
SKETCHED_VALUES = 10_000


@dataclass
class Lookup:
    """A table with looked-up values, given as SQL text.

    The helper columns are to be dropped in the end.
    """

    table: DataFrame
    value: str
    helpers: list[str] = field(default_factory=list)
    broadcast_bytes: int = 0


def _named(prefix: str, count: int) -> list[str]:
    return [*[f"key{i} AS {prefix}_key{i}" for i in range(count)], f"value AS {prefix}_value"]


def _matches(keys: list[str], prefix: str) -> str:
    return " AND ".join(f"{key} = {prefix}_key{i}" for i, key in enumerate(keys))


def join_by_broadcast(
    table: DataFrame, keys: list[str], entries: DataFrame, tag: str, required: bool
) -> Lookup:
    """Join with ``entries``, a table ``(key0, ..., value)`` with distinct keys."""
    right = entries.selectExpr(*_named(tag, len(keys)))
    how = "inner" if required else "left"
    joined = table.join(F.broadcast(right), F.expr(_matches(keys, tag)), how)
    return Lookup(joined, f"{tag}_value", right.columns)


def join_by_shuffle(
    table: DataFrame,
    keys: list[str],
    entries: DataFrame,
    tag: str,
    required: bool,
    entries_bytes: int,
    hot_bytes: int,
) -> Lookup:
    """Join with ``entries``, a table ``(key0, ..., value, hot)`` with distinct keys.

    The hot entries are broadcast, and take ``hot_bytes`` at most; there are none if that is 0.
    """
    hot = entries.where("hot").selectExpr(*_named(f"{tag}_hot", len(keys)))
    # zero for each entry, but not as a literal: the optimizer would take one out of the join keys
    no_spread = f"CAST(hot AS BIGINT) AS {tag}_cold_spread"
    cold = entries.where("NOT hot").selectExpr(*_named(f"{tag}_cold", len(keys)), no_spread)
    if entries_bytes <= HASH_BYTES * shuffle_partitions(table.sparkSession):
        # keys are distinct, so the entries spread evenly and the table need not be sorted
        cold = cold.hint("shuffle_hash")

    spread = _spread(table, keys)
    is_open = f"{keys[0]} IS NOT NULL"
    if hot_bytes:
        table = table.join(F.broadcast(hot), F.expr(_matches(keys, f"{tag}_hot")), "left")
        is_open = f"{tag}_hot_value IS NULL AND {is_open}"
    table = table.selectExpr(
        "*",
        f"CASE WHEN {is_open} THEN {keys[0]} END AS {tag}_open",
        f"CASE WHEN {is_open} THEN 0L ELSE {spread} END AS {tag}_spread",
    )
    condition = _matches([f"{tag}_open", *keys[1:]], f"{tag}_cold")
    condition += f" AND {tag}_spread = {tag}_cold_spread"
    table = table.join(cold, F.expr(condition), "left")
    value = f"{tag}_cold_value"
    helpers = [f"{tag}_open", f"{tag}_spread", *cold.columns]
    if hot_bytes:
        value, helpers = f"coalesce({tag}_hot_value, {value})", [*hot.columns, *helpers]
    if required:
        table = table.where(f"{value} IS NOT NULL")
    return Lookup(table, value, helpers, hot_bytes)


def _spread(table: DataFrame, keys: list[str]) -> str:
    """A number that differs from row to row, for rows that have nothing to look up.

    Made of other columns than the key, so that it is the same whenever it is computed and filters
    can pass it; a table without such a column takes the partition a row comes from.
    """
    own = {quote(f.name) for f in table.schema if quote(f.name) in keys[0]}
    others = [
        quote(f.name)
        for f in table.schema
        if quote(f.name) not in own and not re.search("map<|variant", f.dataType.simpleString())
    ]
    return f"xxhash64({', '.join(others)})" if others else "CAST(spark_partition_id() AS BIGINT)"


@dataclass
class Hot:
    """Values of so many rows that they are looked up before the others are dealt out: a table
    ``(label, value)`` to broadcast, or a few labels and their values. A hot value that the dictionary
    does not have is among them, without a value."""

    table: DataFrame | None = None
    labels: list[str] = field(default_factory=list)
    values: list[float | None] = field(default_factory=list)

    def __bool__(self) -> bool:
        return self.table is not None or bool(self.labels)


def join_by_hash(
    table: DataFrame,
    value: str,
    text: str,
    dictionary: ColumnDictionary,
    hot: Hot,
    tag: str,
    required: bool,
) -> Lookup:
    """Join with a dictionary by the hash of the label ``text`` of the column ``value``, except for
    ``hot`` values. The join moves no label but those that the table has anyway."""
    spark = table.sparkSession
    spread = _spread(table, [value])
    hash_of = "hash" if dictionary.buckets else "xxhash64(label)"
    cold = dictionary.lookup_rows(spark).selectExpr(
        f"{hash_of} AS {tag}_cold_hash", f"label AS {tag}_cold_label", f"idx AS {tag}_cold_value"
    )
    partitions = dictionary.buckets or shuffle_partitions(spark)
    if dictionary.entry_bytes <= HASH_BYTES * partitions:
        # labels are distinct, so the entries spread evenly and the table need not be sorted
        cold = cold.hint("shuffle_hash")
    is_open, helpers, found = f"{text} IS NOT NULL", [], f"{tag}_cold_value"
    if hot.table is not None:
        hot_rows = hot.table.selectExpr(f"label AS {tag}_hot_label", f"value AS {tag}_hot_value")
        table = table.join(F.broadcast(hot_rows), F.expr(f"{text} = {tag}_hot_label"), "left")
        is_open = f"({is_open} AND {tag}_hot_label IS NULL)"
        found, helpers = f"coalesce({tag}_hot_value, {found})", hot_rows.columns
    elif hot.labels:
        place = f"array_position({sql.array(hot.labels, 'string')}, {text})"
        is_open = f"coalesce({place} = 0, false)"
        # place 0 is for values that are not hot
        values = sql.array([None, *hot.values], "double")
        found = f"coalesce(get({values}, CAST({place} AS INT)), {found})"
    table = table.selectExpr(
        "*", f"CASE WHEN {is_open} THEN xxhash64({text}) ELSE {spread} END AS {tag}_open"
    )
    # Two labels may have one hash. The comparison is written so that it is no second key of the join,
    # by which the table would have to be dealt out, too.
    same = f"least({text}, {tag}_cold_label) = greatest({text}, {tag}_cold_label)"
    condition = f"{tag}_open = {tag}_cold_hash AND {is_open} AND {same}"
    table = table.join(cold, F.expr(condition), "left")
    if required:
        table = table.where(f"{found} IS NOT NULL")
    return Lookup(table, found, [f"{tag}_open", *helpers, *cold.columns])


def hot_from_counts(dictionary: ColumnDictionary, spark: SparkSession) -> Hot:
    """The hot values by the counts of the dictionary."""
    each = f"n * {HOT_SHARE * HOT_LABEL_BYTES}D"
    least = f"{dictionary.occurrences}D * greatest(octet_length(label), {HOT_LABEL_BYTES})"
    rows = dictionary.lookup_rows(spark).where(f"{each} >= {least}")
    return Hot(rows.selectExpr("label", "idx AS value"))


def hot_from_table(
    table: DataFrame, text: str, dictionary: ColumnDictionary, may_broadcast: bool
) -> Hot:
    """The hot values of the table, by a sketch of its labels ``text``: all of them if they
    ``may`` be broadcast, else a few of the most frequent ones."""
    spark = table.sparkSession
    labels = table.selectExpr(f"{text} AS label").where("label IS NOT NULL")
    top = f"approx_top_k(label, {TABLE_SHARE}, {SKETCHED_VALUES}) AS top"
    sketch = labels.selectExpr(top, "count(*) AS n").first()
    hot, size = [], 0
    for item in sorted(sketch["top"] or (), key=lambda t: -t["count"]):
        own = len(item["item"].encode())
        if item["count"] * TABLE_SHARE * HOT_LABEL_BYTES < sketch["n"] * max(own, HOT_LABEL_BYTES):
            continue
        if not may_broadcast and (len(hot) == INLINE_LABELS or size + own > INLINE_BYTES):
            break
        hot.append(item["item"])
        size += own
    if not hot:
        return Hot()
    rows = dictionary.lookup_rows(spark)
    if dictionary.buckets:  # only the buckets of these values are read
        values = local_table(spark, label=pa.array(hot, pa.string()))
        hashes = [r["hash"] for r in values.select(F.xxhash64("label").alias("hash")).collect()]
        rows = rows.where(F.col("hash").isin(hashes))
    known = {r["label"]: r["idx"] for r in rows.where(F.col("label").isin(hot)).collect()}
    found = [known.get(label) for label in hot]
    if len(hot) <= INLINE_LABELS and size <= INLINE_BYTES:
        return Hot(labels=hot, values=found)
    columns = {"label": pa.array(hot, pa.string()), "value": pa.array(found, pa.float64())}
    return Hot(local_table(spark, **columns))


def _hot_values(
    table: DataFrame, text: str, dictionary: ColumnDictionary, source: str, broadcast_bytes: int
) -> tuple[Hot, int]:
    """The hot values, and the bytes that are broadcast for them at most."""
    room = HOT_SHARE * (HOT_LABEL_BYTES + ENTRY_BYTES)
    if source == FROM_TABLE and not table.isStreaming:
        hot = hot_from_table(table, text, dictionary, room <= broadcast_bytes)
        return hot, room if hot.table is not None else 0
    room = min(room, dictionary.entry_bytes)
    if source != NOWHERE and dictionary.occurrences and room <= broadcast_bytes:
        return hot_from_counts(dictionary, table.sparkSession), room
    return Hot(), 0


def join_dictionary(
    table: DataFrame,
    value: str,
    data_type: DataType,
    dictionary: ColumnDictionary,
    *,
    tag: str,
    broadcast_bytes: int,
    required: bool = False,
    hot_source: str = FROM_TABLE,
) -> Lookup:
    """Look the labels of the column ``value`` up in the dictionary: its column ``idx`` is wanted.

    Rows without a match get a null value, or are dropped if a match is ``required``.
    """
    spark, needed = table.sparkSession, dictionary.entry_bytes
    if needed <= broadcast_bytes:
        keys = [f"{key} AS key{i}" for i, key in enumerate(label_keys(data_type))]
        entries = dictionary.lookup_rows(spark).selectExpr(*keys, "idx AS value")
        entries = entries.where("key0 IS NOT NULL")
        found = join_by_broadcast(table, value_keys(value, data_type), entries, tag, required)
        found.broadcast_bytes = needed
        return found
    text = value_text(value, data_type)
    hot, hot_bytes = _hot_values(table, text, dictionary, hot_source, broadcast_bytes)
    found = join_by_hash(table, value, text, dictionary, hot, tag, required)
    found.broadcast_bytes = hot_bytes
    return found


def join_places(
    table: DataFrame,
    place: str,
    dictionary: ColumnDictionary,
    *,
    tag: str,
    broadcast_bytes: int,
) -> Lookup:
    """Look the whole numbers ``place`` up in the dictionary: the label of that index is wanted."""
    needed = dictionary.entry_bytes
    by_broadcast = needed <= broadcast_bytes
    columns = ["CAST(idx AS BIGINT) AS key0", "label AS value"]
    most_hot = min(needed, HOT_SHARE * (HOT_LABEL_BYTES + ENTRY_BYTES))
    hot_bytes = most_hot if dictionary.occurrences and most_hot <= broadcast_bytes else 0
    if not by_broadcast:
        frequent = f"n * {HOT_SHARE} >= {max(dictionary.occurrences, 1)}"
        # with no room for hot labels there are none, in a form that is not a literal
        short = f"octet_length(label) BETWEEN 0 AND {HOT_LABEL_BYTES if hot_bytes else -1}"
        columns.append(f"coalesce({frequent} AND {short}, false) AS hot")
    entries = dictionary.rows(table.sparkSession).selectExpr(*columns).where("key0 IS NOT NULL")
    if by_broadcast:
        found = join_by_broadcast(table, [place], entries, tag, False)
        found.broadcast_bytes = needed
        return found
    return join_by_shuffle(table, [place], entries, tag, False, needed, hot_bytes)


def _inline_index(
    table: DataFrame, name: str, known: pa.Array, data_type: DataType, required: bool
) -> Lookup:
    """The position of a value among a few labels, as an expression."""
    # of a key listed twice the later position counts
    positions = {key: i for i, key in enumerate(known.to_pylist())}
    places = [key if positions[key] == i else None for i, key in enumerate(known.to_pylist())]
    kind = "string" if isinstance(data_type, StringType) else "bigint"
    (key,) = value_keys(quote(name), data_type)
    if required:
        # in a form that a file scan can use
        table = table.where(column(name).isin([k for k in places if k is not None]))
    place = f"array_position({sql.array(places, kind)}, {key})"
    return Lookup(table, f"CAST(nullif({place}, 0) - 1 AS DOUBLE)")


def index_column(
    table: DataFrame,
    column_field: StructField,
    dictionary: ColumnDictionary,
    policy: str,
    *,
    tag: str,
    broadcast_bytes: int = BROADCAST_BYTES,
    inline_labels: int = INLINE_LABELS,
    hot_source: str = FROM_TABLE,
    checked: bool = False,
) -> Lookup:
    """Look up the index of each value of a column.

    A null or unseen value is an error, gets the index one past the last label, or loses its
    row, according to ``policy``. If the table was ``checked`` there are no such values.
    """
    name, data_type = column_field.name, column_field.dataType
    value = quote(name)
    if policy == SKIP:
        not_nan = f" AND NOT isnan({value})" if is_float(data_type) else ""
        table = table.where(f"{value} IS NOT NULL{not_nan}")
    known = None
    if dictionary.is_listed(inline_labels, INLINE_BYTES):
        known = known_label_keys(dictionary.labels, data_type)
    if known is not None:
        found = _inline_index(table, name, known, data_type, required=policy == SKIP)
    else:
        found = join_dictionary(
            table,
            value,
            data_type,
            dictionary,
            tag=tag,
            broadcast_bytes=broadcast_bytes,
            required=policy == SKIP,
            hot_source=hot_source,
        )
    if policy == KEEP:
        found.value = f"coalesce({found.value}, {dictionary.size}D)"
    elif policy == ERROR and not checked:
        found.value = f"coalesce({found.value}, {_index_error(value)})"
    return found


NULL_MESSAGE = "A null has no label. Set handleInvalid to skip such rows or to keep them."
UNSEEN_MESSAGE = "Unseen label: "
UNSEEN_ADVICE = ". With handleInvalid set to keep it gets an index of its own."


def _index_error(value: str) -> str:
    unseen = f"concat({sql.text(UNSEEN_MESSAGE)}, CAST({value} AS STRING), {sql.text(UNSEEN_ADVICE)})"
    return sql.fail(f"CASE WHEN {value} IS NULL THEN {sql.text(NULL_MESSAGE)} ELSE {unseen} END", "DOUBLE")
