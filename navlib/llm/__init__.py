"""Operators of a training-data pipeline.  Nothing else in the library imports this package.

Task functions are pickled by value, so executors need numpy and pyarrow but
no installed copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
