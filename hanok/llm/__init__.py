"""Operators for preparing training text, one module per operator.

Functions of this package run inside tasks. They are sent to the workers by value, so the workers need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
