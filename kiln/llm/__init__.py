"""Operators of a training-data pipeline.

Functions that run on executors are pickled by value, so workers need numpy,
pyarrow and the libraries an operator names, but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
