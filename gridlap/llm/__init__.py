"""Operators for preparing training text at scale; nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Tasks carry these functions by value, so executors need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
