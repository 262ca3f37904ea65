"""Operators of a training-data pipeline; ``queries`` registers one query per operator.

Nothing outside this subpackage imports it. Its functions travel to the Python workers by value, so that
executors need the libraries but not this repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
