"""Operators of a training-data pipeline. Nothing else in the library imports this package."""

from pyspark import cloudpickle

import trip_star.llm as _self

# Functions that run on the executors are shipped by value, so the package need not be installed there.
cloudpickle.register_pickle_by_value(_self)
