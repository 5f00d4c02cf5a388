"""Operators for preparing text corpora: scoring, counting, deduplicating, formatting and mixing.

Nothing else in the library imports this package. Functions that run inside tasks are
pickled by value, so executors need numpy and pyarrow but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
