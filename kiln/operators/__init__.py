"""kiln.operators.

Functions that run on executors are pickled by value, so workers need numpy, pandas and
pyarrow, but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
