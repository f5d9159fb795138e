"""Operators of a large-scale training-data pipeline.

Each module holds one operator with a general interface; ``queries.py`` holds the thin
registered queries.  Nothing else in the library imports this package.

Functions that run in Python workers are sent by value, so executors need no copy of the
repository on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
