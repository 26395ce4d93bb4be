"""Tabular analytics and linear models as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

# Functions run in Python workers travel with the job, so executors need not have the
# package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
