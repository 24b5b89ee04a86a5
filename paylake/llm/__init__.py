"""Operators for large-scale training-data preparation.

Nothing else in the library imports this subpackage; the entry module adds
its queries only when it can be imported.  Functions that run in Python
workers are shipped by value, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
