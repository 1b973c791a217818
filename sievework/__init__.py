"""Catalogue enrichment and corpus preparation as Spark DataFrame operators."""

import sys

from pyspark.cloudpickle import cloudpickle

# Functions that run in tasks travel with their code, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
