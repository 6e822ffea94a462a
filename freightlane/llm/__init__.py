"""Operators of a training-data pipeline: extraction, scans, quality, duplicates, mixing, sharding, chat."""

import sys

from pyspark import cloudpickle

# Functions of this package go to the tasks by value: the executors need no copy of it on their paths.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
