"""Feature building, validation and drift watching as Spark jobs."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# The few Python functions used in tasks travel with the job, so that executors need no copy
# of this package.
register_pickle_by_value(sys.modules[__name__])
