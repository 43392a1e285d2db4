"""Spark-native analytics over public-procurement notices and their documents."""

import sys

from pyspark import cloudpickle

# Functions sent to tasks travel with their code, so executors need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
