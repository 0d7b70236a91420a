"""fieldbook: analytics on flat tables, written as Spark DataFrame jobs.

Every operator takes DataFrames and column names and returns a DataFrame, so
plans stay lazy and Catalyst sees the whole query.
"""

import sys

from pyspark import cloudpickle

from fieldbook.config import JobConfig

# Functions sent to Python workers travel whole, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["JobConfig"]
