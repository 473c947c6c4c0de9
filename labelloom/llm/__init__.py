"""Operators for preparing training corpora at scale; nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel whole, so that workers need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
