"""Operators for building training corpora: filtering, deduplication, scanning, scoring, encoding."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value, so that no copy of it is needed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
