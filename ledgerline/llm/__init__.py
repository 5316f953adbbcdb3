"""Operators for building training data; nothing outside this subpackage imports it.

Functions that run inside tasks travel with the job, so executors need not
have this package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
