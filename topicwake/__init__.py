"""Topic and drift analytics over text corpora, expressed as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# The few Python functions that run inside tasks travel with the job, so that executors need not have
# this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
