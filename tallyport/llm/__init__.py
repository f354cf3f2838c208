"""Operators of a training-data pipeline; nothing else in the library imports this package.

Functions that run in Python workers travel with their plans, so executors do not need
this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
