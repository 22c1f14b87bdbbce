"""rivulet: batch and stream data operators on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Functions and processors of this package travel to the Python workers by
# value, so executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
