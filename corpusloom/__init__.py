"""Corpus ingestion and retrieval jobs on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Ship the small Arrow helpers of this package inside the task closure, so that
# executors need no copy of the package on their own module path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
