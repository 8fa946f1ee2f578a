"""quarry: full-text search and facets as Spark DataFrame jobs.

Each operator is a plain function DataFrame -> DataFrame (or Index -> DataFrame); see
``quarry.operators`` (index build, match, rank, filters, order, group, results),
``quarry.sources`` (scans, links, delta, docsets, index files), ``quarry.streaming`` and
``quarry.plans`` (the ``search()`` fold, SQL surface). Functions that run in Python workers (the stemmers)
are shipped by value, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
