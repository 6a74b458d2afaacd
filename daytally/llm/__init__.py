"""Operators that prepare training corpora for language models, each on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Functions used inside tasks travel with the task, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
