"""Operators of a training-data pipeline over documents, benchmark, labels and conversations.

Functions that run in Python tasks are shipped with the job, so workers need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
