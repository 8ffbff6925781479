"""Operators that prepare training text: counting, cleaning, joining, mixing and sharding."""

import sys

from pyspark import cloudpickle

# Functions of this package go to the executors by value: workers need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
