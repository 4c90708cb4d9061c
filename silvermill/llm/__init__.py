"""Operators of a training-data pipeline over documents, pages and vectors."""

import sys

from pyspark import cloudpickle

# Executors then need only the libraries, not this package, on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
