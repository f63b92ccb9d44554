"""tablewright: preparing text tables for machine learning on Spark.

Every operator takes DataFrames and returns a lazy DataFrame; column roles
(text, key, group, target ...) are parameters.
"""

__version__ = "0.1.0"

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# the few Python functions travel to the workers by value, so executors need no copy of the package
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
