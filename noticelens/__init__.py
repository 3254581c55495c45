"""noticelens: labelling large tables of short notice texts with Spark DataFrames."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Task functions travel whole, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
