"""Operators for preparing training corpora. Nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# functions that run in Python workers travel by value: executors need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
