"""Operators for preparing large text corpora (deduplication, filters, mixing, packing).

Nothing outside this subpackage imports it.  Python functions that run in
tasks are pickled by value, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
