"""pixelframe: satellite-patch pixel analytics on PySpark DataFrames."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions that run in tasks travel with the job, so executors need no copy of
# this package and do not import the parts that only the driver uses.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
