"""Operators for preparing language-model training data. Nothing else here imports them."""

import sys

from pyspark import cloudpickle

# Workers get these functions by value, so they need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
