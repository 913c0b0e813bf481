"""Operators for preparing language-model training text, and the corpus pipeline's stages."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value: they need no installed copy there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
