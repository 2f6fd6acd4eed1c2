"""Operators for building training corpora, one module per operator.

Functions of this package travel to the Python workers by value, so the workers need the
libraries they use but not this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
