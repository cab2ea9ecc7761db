"""Operators for text corpora.

Functions that run in Python workers are sent whole, so that executors need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
