"""Operators for training-data pipelines; nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Code of Arrow steps travels with the task: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
