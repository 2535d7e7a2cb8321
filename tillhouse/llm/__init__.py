"""Operators for preparing training text. Nothing outside this package imports it."""

import sys

from pyspark import cloudpickle

# Functions sent to executors carry their code, so that workers need no copy of the repository on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
