"""Operators for preparing training data; nothing else in the library imports this.

Functions of this package travel to the executors by value, so the workers need
no copy of the repository, only the installed libraries.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
