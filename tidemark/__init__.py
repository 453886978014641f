"""Retail lakehouse jobs on Spark: landing files, clean tables, star schema, marts and reports."""

import sys

from pyspark.cloudpickle.cloudpickle import register_pickle_by_value

# The few Python functions that run in tasks are sent as code, so executors do
# not need this package installed.
register_pickle_by_value(sys.modules[__name__])
