"""Operators of a training-data pipeline: scoring, selection, deduplication.

Functions that run in Python workers are shipped by value, so the workers of a
cluster need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
