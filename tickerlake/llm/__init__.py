"""Operators for training-data pipelines over a table of documents.

Functions of this subpackage run in Spark's Python workers. They are sent by
value, so workers need the third-party libraries but not this repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
