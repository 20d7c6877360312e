"""Operators for preparing training data from a corpus of documents."""

import sys

from pyspark import cloudpickle

# The functions that run in tasks travel with them, so that executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
