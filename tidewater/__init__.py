"""A PySpark-native analytics library."""

import sys

from pyspark import cloudpickle

# Functions that go to Python workers take their code along, so executors need no copy of the library on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
