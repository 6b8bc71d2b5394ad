"""Operators for preparing training text. Nothing outside this subpackage imports it.

Functions that run inside tasks are sent to the executors by value, so a cluster needs no
copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
