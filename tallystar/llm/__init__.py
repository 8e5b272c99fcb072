"""Operators of a training-data pipeline over text, pages and vectors."""

import sys

from pyspark import cloudpickle

# Functions that run on executors travel whole, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
