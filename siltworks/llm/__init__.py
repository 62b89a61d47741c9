"""Operations of a training-data pipeline over tables of documents and vectors."""

import sys

from pyspark import cloudpickle

# Executors get the functions of this package by value, so they need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
