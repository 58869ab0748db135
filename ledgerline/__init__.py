"""ledgerline: company-finance analytics as plain Spark DataFrame functions.

Every operator has the shape ``f(df..., params) -> DataFrame`` and stays lazy.
"""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
