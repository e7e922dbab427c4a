"""Spark jobs for building and judging corpora of Python functions."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions travel inside their tasks, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
