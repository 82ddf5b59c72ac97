"""Speech-token dataset building and training-data preparation on Spark."""

import sys

from pyspark import cloudpickle

# Functions of this package go to executors with their code, so a cluster needs no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
