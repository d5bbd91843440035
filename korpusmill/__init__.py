"""korpusmill: retrieval corpora from web pages and positioned document lines, on Spark."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the job; executors need no installation.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
