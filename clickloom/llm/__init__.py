"""Operators that prepare text corpora for training language models.

Nothing else in the library imports this package. Its functions are sent to Python
workers by value, so executors need not have the library installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
