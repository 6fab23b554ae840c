"""The dictionary of one column: its labels and their indices.

A dictionary is a table ``(label, n, idx)``. What is known of it on the driver is its size.
Only a dictionary of few labels is also held there as a list. A larger one is written in buckets by
the hash of its labels, so that a join deals out the other side alone, each time it is used.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom.operators.counts import label_counts
from labelloom.operators.ranking import rank_by_window, ranked_by_range, sort_keys
from labelloom.session import new_folder, scratch

# bytes of entries a task of a join may hold in a hash table
HASH_BYTES = 64 << 20
# bytes an entry takes besides its label
ENTRY_BYTES = 48

# a model of so few and so short labels is recognized by a look at its first rows
GLANCE_LABELS = 1_000
GLANCE_BYTES = 256


@dataclass(frozen=True)
class ColumnDictionary:
    size: int
    text_bytes: int
    occurrences: int = 0
    labels: tuple[str, ...] | None = None
    counts: tuple[int | None, ...] | None = field(default=None, repr=False)
    stored: DataFrame | None = field(default=None, repr=False)
    # where the dictionary is also found: a folder and the value of ``col_name`` in it
    path: str | None = None
    name: str | None = None
    # whether a label may be listed more than once in a stored dictionary
    repeats: bool = False
    # how many buckets the stored rows are in, by their column ``hash``; 0 if they are in none
    buckets: int = 0
    # what the stored rows take in memory, where they are only those that one table needs
    part_bytes: int | None = None

    @classmethod
    def of_labels(
        cls, labels: Sequence[str], counts: Sequence[int | None] | None = None
    ) -> ColumnDictionary:
        """A dictionary that gives each label its position in the list."""
        if not all(isinstance(label, str) for label in labels):
            raise ValueError("Labels must be strings.")
        # of a label listed twice the later position counts, as in building a map
        return cls(
            size=len(labels),
            text_bytes=sum(len(label.encode()) for label in labels),
            occurrences=sum(n or 0 for n in counts or ()),
            labels=tuple(labels),
            counts=tuple(counts) if counts is not None else None,
        )

    def is_listed(self, most_labels: int, most_bytes: int) -> bool:
        """Whether the driver holds the labels and they are no more than this."""
        few = self.size <= most_labels and self.text_bytes <= most_bytes
        return few and self.labels is not None

    def rows(self, spark: SparkSession) -> DataFrame:
        """The dictionary as ``(label, n, idx)``."""
        if self.labels is None:
            return self.stored
        return local_table(
            spark,
            label=pa.array(self.labels, pa.string()),
            n=pa.array(self.counts or [None] * self.size, pa.int64()),
            idx=pa.array(range(self.size), pa.float64()),
        )

    @property
    def entry_bytes(self) -> int:
        """What the dictionary takes in memory, for looking labels up."""
        if self.part_bytes is not None:
            return self.part_bytes
        return self.text_bytes + self.size * ENTRY_BYTES

    def only(self, hashes: Sequence[int], text_bytes: int) -> ColumnDictionary:
        """Those of the entries whose label has one of these hashes; of the stored buckets only the
        ones they are in are read. The labels looked for have ``text_bytes``."""
        rows = self.stored.where(F.col("hash").isin(list(hashes)))
        return replace(self, stored=rows, part_bytes=text_bytes + len(hashes) * ENTRY_BYTES)

    def in_buckets(self, spark: SparkSession) -> ColumnDictionary:
        """The same dictionary, in buckets if it is a table with each label once."""
        if self.labels is not None or self.repeats or self.buckets:
            return self
        rows = self.stored.select(F.lit("0").alias("col_name"), "label", "n", "idx")
        with scratch(spark) as database:
            stored, path, buckets = write_buckets(rows, self.entry_bytes, database)
        about = {"0": {"size": self.size, "text_bytes": self.text_bytes, "occurrences": self.occurrences}}
        (own,) = stored_dictionaries(stored, about, path, buckets).values()
        return own

    def lookup_rows(self, spark: SparkSession) -> DataFrame:
        """Like :meth:`rows`, with each label once."""
        if self.labels is None:
            if not self.repeats:
                return self.stored
            # as for a list, the later position counts
            return self.stored.groupBy("label").agg(
                F.max("n").alias("n"), F.max("idx").alias("idx")
            )
        if len(set(self.labels)) == self.size:
            return self.rows(spark)
        positions = {label: i for i, label in enumerate(self.labels)}
        return local_table(
            spark,
            label=pa.array(list(positions), pa.string()),
            n=pa.nulls(len(positions), pa.int64()),
            idx=pa.array(list(positions.values()), pa.float64()),
        )

    def on_driver(self) -> ColumnDictionary:
        """The same dictionary as a list; for sizes that were checked."""
        if self.labels is not None:
            return self
        rows = self.stored.select("label", "n", "idx").toArrow().sort_by("idx")
        return ColumnDictionary.of_labels(rows["label"].to_pylist(), rows["n"].to_pylist())

    def in_folder(self, spark: SparkSession) -> ColumnDictionary:
        """The same dictionary with a folder in which others find it."""
        if self.path is not None:
            return self
        path, name = new_folder(spark, "dictionary"), "0"
        self.rows(spark).select(F.lit(name).alias("col_name"), "label", "n", "idx").write.parquet(path)
        return replace(self, path=path, name=name)

    @classmethod
    def from_folder(cls, spark: SparkSession, about: dict) -> ColumnDictionary:
        """The dictionary that ``pointer`` of another one tells of."""
        rows = spark.read.parquet(about["path"])
        (own,) = stored_dictionaries(rows, {about["name"]: about}, about["path"]).values()
        return own

    def pointer(self) -> dict:
        return {
            "path": self.path,
            "name": self.name,
            "size": self.size,
            "text_bytes": self.text_bytes,
            "occurrences": self.occurrences,
        }


def local_table(spark: SparkSession, **columns: pa.Array) -> DataFrame:
    return spark.createDataFrame(pa.table(columns))


def labels_table(
    spark: SparkSession, key: str, named: Sequence[tuple[str, ColumnDictionary]]
) -> DataFrame:
    """The labels of dictionaries on the driver as one table ``(key, label, n, idx)``."""
    return local_table(
        spark,
        **{key: pa.array([name for name, d in named for _ in d.labels], pa.string())},
        label=pa.array([label for _, d in named for label in d.labels], pa.string()),
        n=pa.array([n for _, d in named for n in d.counts or [None] * d.size], pa.int64()),
        idx=pa.array([k for _, d in named for k in range(d.size)], pa.float64()),
    )


def learn_dictionaries(
    df: DataFrame, columns: list[str], order: str, local_limit: int
) -> dict[str, ColumnDictionary]:
    """Learn the dictionary of each column of ``df``, in one pass over ``df``.

    Columns of at most ``local_limit`` labels are numbered by a window and brought to the
    driver. The others are sorted across the cluster and stay in a table in the shared folder.
    """
    spark = df.sparkSession
    with scratch(spark) as database:
        # a lost executor does not mean reading the table again
        label_counts(df, columns).write.saveAsTable(f"{database}.counts")
        counts = spark.table(f"{database}.counts")
        few = glance(counts, sort_keys(order), local_limit)
        if few is not None:
            learned = split_dictionaries(few)
        else:
            found = summarize(counts)
            local = [c for c in found if found[c]["size"] <= local_limit]
            large = {c: found[c] for c in found if c not in local}
            learned = {}
            if local:
                small = counts.where(F.col("col_name").isin(local))
                learned |= collect_dictionaries(rank_by_window(small, order))
            if large:
                many = counts.where(F.col("col_name").isin([*large])) if local else counts
                needed = sum(f["text_bytes"] + f["size"] * ENTRY_BYTES for f in large.values())
                with ranked_by_range(many, order) as ranked:
                    stored, path, buckets = write_buckets(ranked, needed, database)
                learned |= stored_dictionaries(stored, large, path, buckets)
    return {c: learned.get(c, ColumnDictionary.of_labels([])) for c in columns}


def shuffle_partitions(spark: SparkSession) -> int:
    set_to = spark.conf.get("spark.sql.shuffle.partitions")
    return int(set_to) if set_to.isdigit() else 200


def write_buckets(rows: DataFrame, needed: int, database: str) -> tuple[DataFrame, str, int]:
    """``rows``, ``(col_name, label, n, idx)`` of dictionaries that take ``needed`` bytes, written in
    buckets by the hash of the label: the table with that ``hash``, its folder, and how many buckets
    there are.

    A task of a join has one bucket, so there are as many as a shuffle has partitions, and more if a
    hash table would be too large. ``database`` is needed to write them, not to read them.
    """
    spark = rows.sparkSession
    buckets = max(shuffle_partitions(spark), -(-needed // HASH_BYTES))
    path, name = new_folder(spark, "dictionary"), f"{database}.dictionary"
    (
        rows.withColumn("hash", F.xxhash64("label"))
        .repartition(buckets, "hash")
        .write.bucketBy(buckets, "hash")
        .sortBy("col_name")
        .option("path", path)
        .saveAsTable(name)
    )
    return spark.table(name), path, buckets


def summarize(rows: DataFrame, given: bool = False) -> dict[str, dict[str, int]]:
    """Size, text bytes and occurrences of each column of a table ``(col_name, label, n)``; of
    ``given`` labels, which may repeat, also how many different ones there are."""
    summary = rows.groupBy("col_name").agg(
        F.count(F.lit(1)).alias("size"),
        F.sum(F.octet_length("label")).alias("text_bytes"),
        F.sum("n").alias("occurrences"),
        *([F.count_distinct("label").alias("different")] if given else []),
    )
    return {row["col_name"]: row.asDict() for row in summary.collect()}


def glance(rows: DataFrame, order: list[Column], local_limit: int) -> pa.Table | None:
    """All of ``rows``, sorted within each column, or None if they are more than a few.

    Only the first rows in that order are looked for, so this costs little if they are many.
    """
    most = min(GLANCE_LABELS, local_limit)
    if most < 1:
        return None
    short = F.when(F.octet_length("label") <= GLANCE_BYTES, F.col("label"))
    sorted_rows = rows.withColumn("label", short).orderBy("col_name", *order)
    few = sorted_rows.select("col_name", "label", "n").limit(most + 1).toArrow()
    return None if few.num_rows > most or few["label"].null_count else few


def collect_dictionaries(rows: DataFrame) -> dict[str, ColumnDictionary]:
    """Bring dictionaries that are known to be small to the driver."""
    collected = rows.select("col_name", "label", "n", "idx").toArrow()
    return split_dictionaries(collected.sort_by([("col_name", "ascending"), ("idx", "ascending")]))


def split_dictionaries(rows: pa.Table) -> dict[str, ColumnDictionary]:
    """One dictionary per column, of ``rows`` sorted by column and index."""
    grouped: dict[str, tuple[list, list]] = {}
    for row in rows.to_pylist():
        labels, counts = grouped.setdefault(row["col_name"], ([], []))
        labels.append(row["label"])
        counts.append(row["n"])
    return {name: ColumnDictionary.of_labels(*lists) for name, lists in grouped.items()}


def stored_dictionaries(
    rows: DataFrame, sizes: dict[str, dict[str, int]], path: str | None = None, buckets: int = 0
) -> dict[str, ColumnDictionary]:
    """Dictionaries that stay in the table ``rows`` of ``(col_name, label, n, idx)``, which is found
    in the folder ``path`` if that is given; in ``buckets`` it has a column ``hash``, too."""
    columns = ["label", "n", "idx", *(["hash"] if buckets else [])]
    return {
        name: ColumnDictionary(
            size=found["size"],
            text_bytes=found["text_bytes"],
            occurrences=found["occurrences"] or 0,
            stored=rows.where(F.col("col_name") == name).select(*columns),
            path=path,
            name=name if path else None,
            repeats=found.get("different", found["size"]) < found["size"],
            buckets=buckets,
        )
        for name, found in sizes.items()
    }
