"""Checks, repairs, reconciles and compares ordered stop tables with Spark."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# Functions that run inside tasks travel with the job; executors need no copy of the package.
register_pickle_by_value(sys.modules[__name__])
