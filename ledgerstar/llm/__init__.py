"""Operators of a training-data pipeline over ``documents``, ``pages`` and
``benchmark``. Nothing else in the library imports this subpackage.

Functions that run in Spark's Python workers travel with their closure, so
the executors need no installed copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
