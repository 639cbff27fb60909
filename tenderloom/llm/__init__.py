"""Operators of a training-data pipeline.  Nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Task code travels with the job, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
