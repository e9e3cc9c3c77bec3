"""Filtered hybrid retrieval and corpus processing as Spark DataFrame plans."""

import sys

from pyspark import cloudpickle

# Functions travel with the job: executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
