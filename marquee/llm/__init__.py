"""Operators for preparing training text; nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
