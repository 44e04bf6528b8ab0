"""Operators for preparing training text. Nothing else in the package imports this folder."""

import sys

from pyspark import cloudpickle

# Functions of this folder that run on executors travel with the job, so that workers need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
