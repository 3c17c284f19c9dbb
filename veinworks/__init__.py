"""Data mining and web-text analytics as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

# Functions for Python workers travel with their task, so executors need not
# have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
