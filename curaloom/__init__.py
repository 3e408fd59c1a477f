"""Spark-native curation engine for text and code datasets.

Functions that run in Python workers are shipped with their code, so executors need not have this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
