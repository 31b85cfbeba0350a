"""Operators of a training-data pipeline; nothing else in the package imports this one."""

import sys

from pyspark import cloudpickle

# Task code travels with its job, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
