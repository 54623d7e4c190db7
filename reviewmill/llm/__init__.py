"""Operators for preparing training data; nothing else in the library imports this package."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# Functions of this package travel to the executors with the jobs, so the
# package needn't be installed there.
register_pickle_by_value(sys.modules[__name__])
