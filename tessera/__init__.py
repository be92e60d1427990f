"""Retrieval analytics as Spark jobs over tables and streams."""

import sys

from pyspark import cloudpickle

# Executors get the small task functions by value, so a cluster needs no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
