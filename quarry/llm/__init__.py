"""Operators for building a language-model training corpus, each a plain function on DataFrames.

Nothing else in the library imports this subpackage. ``queries.py`` registers one query per operator.
Functions that run inside Python workers are shipped by value, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
