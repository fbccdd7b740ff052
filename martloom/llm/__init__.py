"""Operators of a training-data pipeline; nothing else in the library imports them.

Python functions of this package travel to the executors by value, so executors
need no copy of it."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
