"""Operators for preparing text corpora; see registry.py for the queries.

Their functions are sent to the executors by value, so a cluster needs no copy
of this package on its workers.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
