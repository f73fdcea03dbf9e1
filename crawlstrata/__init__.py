"""Web-archive analytics as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# Functions run inside Python workers travel with the plan, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
