"""Rating-matrix factorization and operational-metric analytics on PySpark."""

import sys

from pyspark import cloudpickle

# Python workers receive the kernels by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
