"""Operators for training-data pipelines. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Functions and models travel to the executors with their code, so a job needs no installed copy of this package there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
