"""Operators for preparing language-model training data.

Functions of this package that run in Python workers are shipped with the job, so executors
need no copy of it on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
