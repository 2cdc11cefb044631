"""Keyed record logs as Spark tables and streams."""

import sys

from pyspark import cloudpickle

# The few Python functions travel with the tasks that use them, so executors
# need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
