"""Operators for training-data pipelines: scans, filters, deduplication, packing, mixing, search.

Each module holds one operator with its own interface; ``queries`` applies every operator to
its whole table with production parameters.  Nothing outside this subpackage imports it.
"""

import sys

from pyspark import cloudpickle

# Task code travels with the tasks, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
