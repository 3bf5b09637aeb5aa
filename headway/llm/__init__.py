"""Operators for preparing training text; nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Functions sent to executors carry this subpackage's code, so it need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
