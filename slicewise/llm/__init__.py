"""Operators of a training-data pipeline. Nothing else in the package imports this folder."""

import sys

from pyspark import cloudpickle

# Functions of this folder travel to the executors with the job, which need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
