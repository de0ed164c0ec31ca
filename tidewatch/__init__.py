"""tidewatch — early-warning analytics on Spark DataFrames.

Every operator is a function ``DataFrame -> DataFrame`` built from Spark
SQL expressions, joins, aggregations and windows, so Catalyst plans it and
the work is partitioned across the cluster.

Functions that run inside tasks are pickled by value, so executors need only
Spark's own Python libraries and not this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["session"]
