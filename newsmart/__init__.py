"""Spark-native news intelligence: ingest, scoring, de-duplication, enrichment, exports and reports."""

import sys

from pyspark import cloudpickle

# Functions travel to the Python workers by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
