"""Operators for large training corpora; nothing else in the library imports this subpackage."""

from pyspark import cloudpickle

import docketry

# Functions travel to the executors by value, so nothing has to be installed there.
cloudpickle.register_pickle_by_value(docketry)
