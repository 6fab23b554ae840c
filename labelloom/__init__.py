"""Label indexing and column shaping on Spark."""

from labelloom.functions.vectors import num_features, num_features_from_schema
from labelloom.operators.counts import label_counts, label_sets
from labelloom.operators.flatten import flatten, flattened_columns
from labelloom.plans.columns import ColumnRenamer, IndexToLabel
from labelloom.plans.indexer import LabelIndexer, LabelIndexerModel
from labelloom.streaming.transform import transform_stream

__all__ = [
    "ColumnRenamer",
    "IndexToLabel",
    "LabelIndexer",
    "LabelIndexerModel",
    "flatten",
    "flattened_columns",
    "label_counts",
    "label_sets",
    "num_features",
    "num_features_from_schema",
    "transform_stream",
]
