"""Operators of a training-data pipeline. Nothing outside this package imports it; the entry file adds its queries."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with the job, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
