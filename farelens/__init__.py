"""farelens: trip-record analytics on Spark.

Raw trip parquet -> derived features -> NULL-aware quality gate -> 23-column
fact -> reporting views, dashboard tiles and report analyses.  Every step is a
DataFrame transformation so Catalyst sees one plan per action.  Functions that
run in tasks are pickled by value, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

from farelens.session import build_session, storage_root

cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["build_session", "storage_root"]
